"""Exact deduplication, the Jaccard join and components against plain versions."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from deskline.llm.components import connected_components
from deskline.llm.exact_dedup import drop_copies, exact_dedup
from deskline.llm.ngram_jaccard import drop_near_copies, ngram_jaccard_join, schemes
from deskline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

HARD = [
    (1, None, "a"),
    (2, "", None),
    (3, " \t\n", "a"),
    (4, "one two three four five six seven", "a"),
    (4, "one two three four five six seven", "b"),
    (5, "One  two\nthree FOUR five six seven", "a"),
    (6, "short", "a"),
    (7, "SHORT", "a"),
    (None, "one two three four five six seven", "a"),
    (None, "nothing like it", "a"),
    (8, "word " * 200_000 + "x" * 1_000_000, "a"),
    (9, "word " * 200_000 + "x" * 1_000_000, "a"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(HARD, "key long, body string, component_id string").cache()


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_join(docs, words, percent):
    sets = {}
    for i, text in docs:
        line = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(line[k : k + words]) for k in range(max(1, len(line) - words + 1))} if line else set()
    holders, pairs = defaultdict(list), []
    for i in sorted(sets):
        common = defaultdict(int)
        for gram in sets[i]:
            for j in holders[gram]:
                common[j] += 1
            holders[gram].append(i)
        pairs += [(i, j) for j, n in common.items() if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)]
    found = components(pairs, sets)
    return {i: (len(sets[i]), found[i]) for i in sets}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(300)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(links)
    table = spark.createDataFrame([*links, (7, 7), (None, 3), (5, None)], "a long, b long")
    found = {r.node: r.component for r in connected_components(table).collect()}
    linked = [p for p in links if p[0] != p[1]]
    assert found == components(linked, {n for p in linked for n in p})
    assert connected_components(table.where("false")).collect() == []


def test_hard_rows_exact(hard):
    rows = exact_dedup(hard, "key", "body", keep="smallest").collect()
    assert len(rows) == len(HARD)
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in rows} == {
        (1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True), (4, 4, 3, True), (5, 5, 1, True), (6, 6, 1, True),
        (7, 7, 1, True), (None, 4, 3, False), (None, None, 1, True), (8, 8, 2, True), (9, 8, 2, False),
    }
    kept = drop_copies(hard, "key", "body", keep="largest")
    assert kept.columns == hard.columns
    assert sorted((r.key or 0) for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 7, 9]
    assert exact_dedup(hard.where("false"), "key", "body").collect() == []
    assert drop_copies(hard.where("false"), "key", "body").collect() == []


def test_hash_collision_is_told_apart(spark, monkeypatch):
    from deskline.llm import exact_dedup as module

    monkeypatch.setattr(module, "_content_hash", lambda text: F.unhex(F.lit("00")))
    rows = exact_dedup(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in rows) == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


def test_hard_rows_near(hard):
    rows = ngram_jaccard_join(hard, "key", "body", words=3, percent=90).collect()
    assert len(rows) == len(HARD)
    # Ends of the long texts: "word word word", "word word x", one set for 8 and 9.
    assert {(r.id, r.n_shingles, r.component_id) for r in rows} == {
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 5, 4), (5, 5, 4), (6, 1, 6), (7, 1, 6), (None, 5, 4), (None, 1, None),
        (8, 2, 8), (9, 2, 8),
    }
    kept = drop_near_copies(hard, "key", "body")
    assert kept.columns == hard.columns
    assert sorted((r.key or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert drop_near_copies(hard.where("false"), "key", "body").collect() == []


def test_schemes_meet():
    """Any two sizes that may link have a scheme in common, with parts enough."""
    for percent in (80, 90):
        for a in [*range(1, 200), 777, 5000]:
            mine = {(s.band, s.parts) for s in schemes(a, percent)}
            for b in range(a, a * 100 // percent + 1):
                both = mine & {(s.band, s.parts) for s in schemes(b, percent)}
                assert both and all(parts > (a + b) * (100 - percent) // (100 + percent) for _, parts in both)


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_crowded_groups(spark, words, percent):
    """Groups of near copies, of which some link, some only through others, some not."""
    rng = random.Random(words)
    texts = []
    for size in (700, 60, 5):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([40, 120]))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    texts += [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    rows = ngram_jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), words=words, percent=percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in rows} == plain_join(docs, words, percent)


def test_query_equals_plain_join(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op10_ngram_jaccard"](spark, SF).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(docs)
    assert found == plain_join(docs, 3, 90)
