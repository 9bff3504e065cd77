"""How many pairs the n-gram join takes on: no more than its groups have documents."""

import random

import pytest
from test_dedup_and_join import plain_join

from deskline.llm import ngram_jaccard as module


@pytest.fixture
def made(monkeypatch):
    """Rows of the candidate pairs and of the pairs across groups, as they are made."""
    counts = {"_within_bound": [], "_across": []}

    def counted(name):
        run = getattr(module, name)

        def wrapper(first, *rest, **named):
            out = run(first, *rest, **named)
            counts[name].append((first if name == "_within_bound" else out).count())
            return out

        monkeypatch.setattr(module, name, wrapper)

    for name in counts:
        counted(name)
    return counts


def join(spark, texts, words, percent):
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = module.ngram_jaccard_join(table, words=words, percent=percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in rows} == plain_join(docs, words, percent)


def test_shared_passage_makes_no_pairs(spark, made):
    """Documents with a long passage in common and a third of their own."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(80)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(400)]
    join(spark, texts, 5, 80)
    assert made["_within_bound"] == [0]


def test_pairs_of_a_group_do_not_grow_with_its_square(spark, made):
    """Near copies of which some link and some are just below the threshold."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for _ in range(400):
        own = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    join(spark, texts, 5, 80)
    assert max(made["_across"]) < 10 * len(texts)
