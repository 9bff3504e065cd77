"""The models of order 2 and 3 against plain ones, and against themselves: probabilities add up to one."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskline.llm.hashing import mix, seeded, unmix
from deskline.llm.ngram_lm import _narrow, discounts, ranges_for, score_texts, train_ngram_model
from deskline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", text), "</s>"]


class Plain:
    def __init__(self, texts, order=2):
        self.words, self.pairs, self.triples = Counter(), Counter(), Counter()
        for t in texts:
            line = tokens(t)
            self.words.update(line)
            self.pairs.update(zip(["<s>", *line], line))
            if order == 3:
                self.triples.update(zip(["<s>", *line], line, line[1:]))
        if order == 3:
            wider = Counter((v, w) for _, v, w in self.triples)
            self.pairs = Counter({p: c if p[0] == "<s>" else wider[p] for p, c in self.pairs.items()})
        self.after3, self.total3 = defaultdict(Counter), Counter()
        for (u, v, _), c in self.triples.items():
            self.after3[u, v][min(c, 3)] += 1
            self.total3[u, v] += c
        count_of = Counter(self.triples.values())
        self.d3 = discounts([count_of[i] for i in range(1, 5)])
        self.after, self.before, self.total = defaultdict(Counter), Counter(), Counter()
        for (u, w), c in self.pairs.items():
            self.after[u][min(c, 3)] += 1
            self.total[u] += c
            self.before[w] += 1
        count_of = Counter(self.pairs.values())
        self.d = discounts([count_of[i] for i in range(1, 5)])
        count_of = Counter(self.before.values())
        self.lower_d = discounts([count_of[i] for i in range(1, 5)])
        self.all = sum(self.words.values())
        self.freed = sum(self.lower_d[min(c, 3) - 1] for c in self.before.values()) / max(len(self.pairs), 1)

    def lower(self, w):
        if not self.pairs:
            return 1 / (len(self.words) + 1)
        c = self.before[w]
        return (max(c - self.lower_d[min(c, 3) - 1], 0) if c else 0) / len(self.pairs) + self.freed / (len(self.words) + 1)

    def chance(self, u, w):
        if not self.total[u]:
            return self.lower(w)
        c = self.pairs[u, w]
        freed = sum(self.d[i - 1] * n for i, n in self.after[u].items()) / self.total[u]
        return (max(c - self.d[min(c, 3) - 1], 0) if c else 0) / self.total[u] + freed * self.lower(w)

    def chance3(self, t, u, w):
        if not self.total3[t, u]:
            return self.chance(u, w)
        c = self.triples[t, u, w]
        freed = sum(self.d3[i - 1] * n for i, n in self.after3[t, u].items())
        return ((max(c - self.d3[min(c, 3) - 1], 0) if c else 0) + freed * self.chance(u, w)) / self.total3[t, u]

    def score(self, text):
        line = tokens(text)
        base = sum(math.log10((self.words[w] + 0.1) / (self.all + 0.1 * (len(self.words) + 1))) for w in line)
        return len(line), sum(self.words[w] > 0 for w in line), base, sum(
            math.log10(self.chance3(t, u, w)) for t, u, w in zip(["", "<s>", *line], ["<s>", *line], line)
        )


def check(rows, plain):
    for row in rows:
        n, known, base, score = plain.score(row["text"])
        assert (row["n_tokens"], row["n_known"]) == (n, known)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(score, rel=1e-9)


def test_query_equals_plain_model(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op6_lm_scoring"](spark, SF).join(documents, "doc_id").collect()
    assert len(rows) == documents.count()
    texts = {r.doc_id: r.text for r in documents.collect()}
    held_out = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    assert {r.doc_id for r in rows if r.held_out} == held_out
    plain = Plain(t for i, t in texts.items() if i not in held_out)
    assert {r.train_tokens for r in rows} == {plain.all}
    check([r.asDict() for r in rows], plain)
    # Better than the counts alone on texts it has not seen.
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize("order", [2, 3])
def test_documents_equal_plain_model(spark, order):
    """Learnt in ranges and scored in many tasks, of either order."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(5)
    model = train_ngram_model(documents.where(F.col("doc_id") % 3 != 0), order=order)
    texts = {r.doc_id: r.text for r in documents.collect()}
    plain = Plain((t for i, t in texts.items() if i % 3), order)
    rows = score_texts(documents, model).collect()
    assert len(rows) == len(texts)
    check([{**r.asDict(), "text": texts[r.id]} for r in rows], plain)


def test_orders(spark):
    with pytest.raises(ValueError):
        train_ngram_model(spark.createDataFrame([("a",)], "text string"), order=4)
    values = seeded(1000, 5)
    assert (unmix(mix(values)) == values).all() and (mix(unmix(values)) == values).all()


def test_probabilities_add_up():
    plain = Plain(["a b a c", "b a b", "a b c d e a b", "c d"], 3)
    for t, u in [("<s>", "a"), ("a", "b"), ("c", "d"), ("b", "zzz"), ("zzz", "a")]:
        total = sum(plain.chance3(t, u, w) for w in plain.words) + plain.chance3(t, u, "not a word")
        assert total == pytest.approx(1)
    plain = Plain(["a b a c", "b a b", "a b c d e a b", "c d"])
    for u in ["<s>", "a", "d", "zzz"]:
        total = sum(plain.chance(u, w) for w in plain.words) + plain.chance(u, "not a word")
        assert total == pytest.approx(1)


HARD = [
    (1, None, "x"),
    (2, "", "x"),
    (3, "  \t\n ", "x"),
    (4, "one two one two one", None),
    (4, "one two one two one", None),
    (None, "ONE two Ünï", "x"),
    (5, "long " * 300_000 + "x" * 3_000_000 + " end", "x"),
]


@pytest.mark.parametrize("order", [2, 3])
def test_hard_rows(spark, order):
    docs = spark.createDataFrame(HARD, "key long, body string, score string")
    model = train_ngram_model(docs, "body", order)
    plain = Plain((t for _, t, _ in HARD), order)
    assert (model.train_tokens, model.vocabulary) == (plain.all, len(plain.words))
    rows = score_texts(docs, model, "key", "body").collect()
    assert len(rows) == len(HARD)
    by_id = {k: t for k, t, _ in HARD}
    check([{**r.asDict(), "text": by_id[r.id]} for r in rows], plain)


@pytest.mark.parametrize("order", [2, 3])
def test_nothing_to_learn_from(spark, order):
    docs = spark.createDataFrame(HARD[:4], "key long, body string, score string")
    model = train_ngram_model(docs.where("false"), "body", order)
    rows = score_texts(docs, model, "key", "body").collect()
    assert [(r.n_known, r.score) for r in rows] == [(0, 0.0)] * 4
    assert score_texts(docs.where("false"), model, "key", "body").collect() == []
    assert train_ngram_model(docs.where(F.col("key") == 1), "body", order).train_tokens == 1
    empty = train_ngram_model(docs.where(F.col("key") < 4), "body", order)
    plain = Plain((t for _, t, _ in HARD[:3]), order)
    check([{**r.asDict(), "text": dict((k, t) for k, t, _ in HARD)[r.id]} for r in score_texts(docs, empty, "key", "body").collect()], plain)


def test_counts_and_ranges_of_huge_corpora():
    assert _narrow(np.array([1, 2**32 - 1])).dtype == np.uint32
    wide = _narrow(np.array([1, 2**32, 2**40]))
    assert wide.tolist() == [1, 2**32, 2**40]
    assert ranges_for(0, 1) == 1 and ranges_for(1000, 12) == 16
    # A hundred terabytes in ranges of 64 megabytes, whatever the partitions.
    assert ranges_for(10**14, 12) == 1 << 21
