"""Token counts after edits against encoding the whole new text."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from deskline.llm.queries import BYTE_RANKS, QUERIES, edited_documents
from deskline.llm.token_counts import TokenTree, _Counter, apply_edits, build_token_trees, gather_edits

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def rules():
    with open(BYTE_RANKS, "rb") as file:
        return file.read(), PATTERN


@pytest.fixture(scope="module")
def count(rules):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rules[0].splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(encoding.encode_ordinary(text))


def plain_edit(text, edits):
    out, old = [], 0
    for start, stop, insert in sorted(edits, key=lambda e: e[:2]):
        start, stop = (min(max(x, 0), len(text)) for x in (start, max(start, stop)))
        out += [text[old:start], insert or ""]
        old = stop
    return "".join(out) + text[old:]


def check_tree(tree, text, count):
    assert tree.tokens[1] == count(text)
    assert tree.chars[1] == len(text)
    for node in range(1, tree.leaves):
        assert tree.chars[node] == tree.chars[2 * node] + tree.chars[2 * node + 1]
        assert tree.tokens[node] == tree.tokens[2 * node] + tree.tokens[2 * node + 1]


def test_random_edits(rules, count):
    rng = random.Random(3)
    counter = _Counter(rules)
    letters = "ab  \n'sé1.\t　"
    for _ in range(300):
        text = "".join(rng.choice(letters) * rng.choice([1, 1, 1, 5]) for _ in range(rng.choice([0, 1, 5, 200, 3000])))
        tree = TokenTree.of(text, counter)
        check_tree(tree, text, count)
        for _ in range(3):
            places = sorted(rng.randrange(len(text) + 2) for _ in range(2 * rng.randrange(6)))
            edits = [
                (a, b, "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 400]))))
                for a, b in zip(places[::2], places[1::2])
            ]
            wanted = plain_edit(text, edits)
            text = tree.edit(text, edits, counter)
            assert text == wanted
            check_tree(tree, text, count)


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60), start=st.integers(0, 70), size=st.integers(0, 20), insert=st.text(max_size=20))
def test_any_text(rules, count, text, start, size, insert):
    counter = _Counter(rules)
    tree = TokenTree.of(text, counter)
    new = tree.edit(text, [(start, start + size, insert)], counter)
    assert new == plain_edit(text, [(start, start + size, insert)])
    check_tree(tree, new, count)


def test_query_equals_whole_encoding(spark, count):
    rows = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, SF).collect()}
    docs = edited_documents(spark, SF).select("doc_id", "text", "edits").collect()
    assert len(rows) == len(docs)
    for d in docs:
        new = plain_edit(d.text, [tuple(e) for e in d.edits])
        assert (rows[d.doc_id].tokens_before, rows[d.doc_id].tokens_after) == (count(d.text), count(new))
    # Long texts are not encoded again as a whole.
    long = [r for r in rows.values() if r.leaves >= 64]
    assert long and all(r.leaves_touched <= 12 for r in long)


def test_hard_rows(spark, count):
    docs = [(1, None, "x"), (2, "", "x"), (None, "some words", "x"), (3, "twice", None), (3, "twice", None), (4, "long word " * 30_000 + "x" * 20_000, "")]
    docs = spark.createDataFrame(docs, "key long, body string, tokens string")
    edits = [(1, 0, 5, "new"), (2, 3, 9, None), (4, 299_990, 300_010, " cut "), (4, 5, 5, None), (4, 7, 2, "b"), (3, 5, 5, " again")]
    edits = spark.createDataFrame(edits, "doc_id long, start int, stop int, insert string")
    trees = build_token_trees(docs, BYTE_RANKS, PATTERN, "key", "body")
    edited = apply_edits(trees.join(gather_edits(edits), "id", "left"), BYTE_RANKS, PATTERN)
    rows = edited.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.tokens_after == count(r.text)
    by_id = {r.id: r.text for r in rows}
    assert (by_id[1], by_id[2], by_id[None], by_id[3]) == ("new", "", "some words", "twice again")
    assert "wobrd" in by_id[4] and " cut " in by_id[4]
    assert build_token_trees(docs.where("false"), BYTE_RANKS, PATTERN, "key", "body").collect() == []
    overlap = edits.where("false").union(spark.createDataFrame([(4, 1, 9, "a"), (4, 5, 6, "b")], edits.schema))
    old = {r.id: r.text for r in trees.select("id", "text").collect()}[4]
    [row] = apply_edits(trees.join(gather_edits(overlap), "id"), BYTE_RANKS, PATTERN).collect()
    assert row.text == old[:1] + "ab" + old[9:] and row.tokens_after == count(row.text)
    longer = edits.where("false").union(spark.createDataFrame([(4, 5, 12, "b"), (4, 1, 9, "a"), (4, 20, 21, "")], edits.schema))
    [row] = apply_edits(trees.join(gather_edits(longer), "id"), BYTE_RANKS, PATTERN).collect()
    assert row.text == old[:1] + "ab" + old[12:20] + old[21:] and row.tokens_after == count(row.text)
