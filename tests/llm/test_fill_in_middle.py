"""Fill-in-the-middle: cuts against plain slicing, exact restoration, hard rows."""

import hashlib
import random
import re

import numpy as np
import pytest

from deskline.llm.fill_in_middle import BlockTree, fill_in_middle, restored_text

HARD = [
    (1, None, "a"),
    (2, "", None),
    (3, "x", "a"),
    (4, "holds <S> itself", "a"),
    (None, "no id, ünd <P", "a"),
    (5, "é" * 100_001 + "𝔘\n<" * 5_000, "a"),
    (5, "é" * 100_001 + "𝔘\n<" * 5_000, "a"),
    (6, " leading  white\tspace\n\n", "a"),
    (7, "<" * 3_000, "a"),
]
PLAIN_UNITS = {
    "characters": lambda t: list(t),
    "words": lambda t: re.findall(r"^[ \t\n\r\v\f]*[^ \t\n\r\v\f]*[ \t\n\r\v\f]*|[^ \t\n\r\v\f]+[ \t\n\r\v\f]*", t) if t else [],
    "lines": lambda t: t.splitlines(keepends=True) if "\n" in t else [t] * bool(t),
}


def plain_version(row_id, text, unit, seed):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if row_id is None else row_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = PLAIN_UNITS[unit](text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", ["characters", "words", "lines"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_slicing(spark, unit, seed):
    docs = spark.createDataFrame(HARD, "key long, body string, form string")
    made = fill_in_middle(docs, "key", "body", unit, seed)
    rows = made.select("*", restored_text("output", "form").alias("restored")).collect()
    assert len(rows) == len(HARD)
    got = sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows), key=repr)
    want = sorted(((i, *plain_version(i, t, unit, seed)) for i, t, _ in HARD), key=repr)
    assert got == want
    assert sorted(((r.id, r.restored) for r in rows), key=repr) == sorted(((i, t or "") for i, t, _ in HARD), key=repr)


@pytest.mark.parametrize("unit", ["characters", "words", "lines"])
def test_every_cut_of_a_tree(unit):
    rnd = random.Random(3)
    for _ in range(40):
        text = "".join(rnd.choice("ab é𝔘\n ") for _ in range(rnd.randint(0, 200)))
        data = np.frombuffer(text.encode(), np.uint8)
        tree = BlockTree(data, unit, block=rnd.choice([1, 2, 7, 64]))
        units = PLAIN_UNITS[unit](text)
        assert (tree.units, tree.characters) == (len(units), len(text))
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert tree.cut(k) == (len(before.encode()), len(before))


def test_other_markers_and_empty_table(spark):
    docs = spark.createDataFrame([(i, f"text number {i}, <P> and | more") for i in range(60)], "doc_id long, text string")
    markers = ("|pre.", "#suf\\E(", "~mid")
    made = fill_in_middle(docs, markers=markers, percent=100, suffix_first_percent=50)
    rows = made.select("id", "form", restored_text("output", "form", markers).alias("t")).collect()
    assert {r.form for r in rows} == {"psm", "spm"}
    assert {r.id: r.t for r in rows} == {i: f"text number {i}, <P> and | more" for i in range(60)}
    assert fill_in_middle(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fill_in_middle(docs, markers=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fill_in_middle(docs, unit="tokens")
