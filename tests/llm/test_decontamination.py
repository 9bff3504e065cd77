"""Passages against a search of every item in every document, and recall under edits."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from deskline.llm.decontamination import (
    _passages,
    drop_contaminated,
    find_benchmark_passages,
    item_index,
    passage_distance,
)
from deskline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[a-z0-9\x80-\U0010ffff]+", text)


def numbered(lists):
    names = {}
    return [np.array([names.setdefault(w, len(names)) for w in line], np.int64) for line in lists]


def brute_force(docs, items, percent=80):
    lines = numbered([words(t) for _, t in docs] + [words(t) for _, t in items])
    texts, wanted = lines[: len(docs)], lines[len(docs) :]
    found = {}
    for (doc_id, _), text in zip(docs, texts):
        for (item_id, _), item in zip(items, wanted):
            if len(item) and len(np.intersect1d(item, text)):
                distance = passage_distance(item, text)
                if distance <= len(item) * (100 - percent) // 100:
                    found[doc_id, item_id] = distance
    return found


def test_passage_distance():
    item = np.array([1, 2, 3, 4])
    assert passage_distance(item, np.array([9, 1, 2, 3, 4, 9])) == 0
    assert passage_distance(item, np.array([9, 1, 3, 4, 9])) == 1
    assert passage_distance(item, np.array([1, 2, 7, 7, 3, 4])) == 2
    assert passage_distance(item, np.array([5])) == 4
    assert passage_distance(item, np.array([], int)) == 4


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op1_decontamination"](spark, SF).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in rows}
    assert len(found) == len(rows) > 0
    assert found == brute_force(docs, items)


@pytest.mark.parametrize("rate, least", [(0, 1), (0.05, 0.99), (0.1, 0.98), (0.19, 0.9)])
def test_recall_under_edits(rate, least):
    rng = random.Random(5)
    common = ["the", "of", "and", "to", "in"]

    def word():
        return rng.choice(common) if rng.random() < 0.3 else f"w{rng.randrange(20000)}"

    items = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(300)]
    index = item_index(list(range(300)), [" ".join(i) for i in items], 80)
    texts = []
    for item in items:
        edited = list(item)
        for _ in range(int(rate * len(item))):
            at = rng.randrange(len(edited))
            kind = rng.randrange(3)
            edited[at : at + (kind != 0)] = [word()] if kind != 1 else []
        texts.append(" ".join([word() for _ in range(200)] + edited + [word() for _ in range(200)]))
    found = {(row, item) for row, item, _, _ in _passages(pa.array(texts), index)}
    assert sum((i, i) in found for i in range(300)) >= least * 300
    assert all(row == item for row, item in found)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 6, 7, 10, 15, 20, 31, 32, 36, 48, 64, 100])
def test_recall_of_each_size(size):
    """Passages amid other words, as they are and with all the edits that 80 % allow."""
    rng = random.Random(size)

    def run(n):
        return [f"w{rng.randrange(20000)}" for _ in range(n)]

    items = [run(size) for _ in range(100)]
    index = item_index(list(range(100)), [" ".join(i) for i in items], 80)
    for edits in (0, size // 5):
        texts = []
        for item in items:
            edited = list(item)
            for _ in range(edits):
                at, kind = rng.randrange(len(edited)), rng.randrange(3)
                edited[at : at + (kind != 0)] = run(1) if kind != 1 else []
            texts.append(" ".join(run(50) + edited + run(50)))
        found = {(row, item) for row, item, _, _ in _passages(pa.array(texts), index)}
        # Of short items none is lost; the walks may lose a few of the most edited.
        assert sum((i, i) in found for i in range(100)) >= (100 if size < 32 or not edits else 97)


ITEM = "One two three four five six seven eight nine ten eleven twelve"


def test_hard_rows(spark):
    docs = spark.createDataFrame(
        [
            (1, None, "x", 0),
            (2, "", "x", 0),
            (None, f"before {ITEM.upper()}, after", None, 0),
            (3, ITEM, "x", None),
            (3, ITEM, "x", None),
            (4, "one  two three\nfour, five six (seven) eight nine ten", "x", 0),
            (5, "one two three four five six seven eight", "x", 0),
            (6, "far " * 400_000 + ITEM.replace("six ", "") + " end" * 1000, "x", 0),
            (7, "clean text", "x", 0),
        ],
        "key long, body string, item_id string, passages int",
    )
    items = spark.createDataFrame(
        [(1, ITEM), (2, None), (3, ""), (4, "..."), (None, "clean text of five words")], "name long, words string"
    )
    rows = find_benchmark_passages(docs, items, "key", "body", "name", "words").collect()
    found = sorted((r.id or 0, r.item_id, r.distance) for r in rows)
    assert found == [(0, 1, 0), (3, 1, 0), (3, 1, 0), (4, 1, 2), (6, 1, 1)]
    kept = drop_contaminated(docs, items, "body", "words")
    assert kept.columns == docs.columns
    assert sorted(r.key for r in kept.collect()) == [1, 2, 5, 7]
    none = docs.where("false")
    assert find_benchmark_passages(none, items, "key", "body", "name", "words").collect() == []
    assert find_benchmark_passages(docs, items.where("false"), "key", "body", "name", "words").collect() == []
    assert drop_contaminated(docs, items.where("false"), "body", "words").count() == docs.count()
