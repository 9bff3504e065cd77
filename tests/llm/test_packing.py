"""Packing against whole encodings, plain best fit, and its own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskline.llm.packing import decide, pack, packed_sequences, tokenized_pieces
from deskline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def plain_best_fit(lengths, capacity):
    gaps, count = np.zeros(capacity + 1, int), 0
    for length in sorted(lengths, reverse=True):
        fits = np.flatnonzero(gaps[length:])
        size = length + fits[0] if len(fits) else capacity
        gaps[size] -= bool(len(fits))
        count += not len(fits)
        gaps[size - length] += 1
    return count


def check_places(rows, capacity):
    """Every sequence is filled from 0 on without a gap; returns their number."""
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for places in inside.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(inside)


def test_query(spark, encode):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op9_best_fit_packing"](spark, SF).collect()
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    seen = 0
    for doc_id, text in docs.items():
        ids = encode(text)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4")
            r = pieces[doc_id, piece]
            assert (r.start, r.length, r.ids_crc32) == (start, len(part), zlib.crc32(part.tobytes()))
            seen += 1
    assert seen == len(rows)
    assert check_places(rows, 2048) <= plain_best_fit([r.length for r in rows], 2048)


@pytest.mark.parametrize("capacity, draw", [
    (2048, lambda r: min(2048, int(r.lognormvariate(6, 1.2)) + 1)),
    (100, lambda r: r.randrange(1, 101)),
    (100, lambda r: r.choice([34, 33, 51])),
    (64, lambda r: 1),
    (10, lambda r: 10),
])
def test_as_few_sequences_as_best_fit(capacity, draw):
    rng = random.Random(2)
    lengths = [draw(rng) for _ in range(20_000)]
    sizes = {n: lengths.count(n) for n in set(lengths)}
    length, first, sequence, offset = decide(sizes, capacity)
    filled = defaultdict(list)
    for n in sizes:
        own = np.flatnonzero(length == n)
        assert first[own[0]] == 0
        ends = [*first[own[1:]], sizes[n]]
        for i, end in zip(own, ends):
            for k in range(end - first[i]):
                filled[sequence[i] + k].append((offset[i], n))
    assert sum(map(len, filled.values())) == len(lengths)
    for places in filled.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    assert len(filled) <= plain_best_fit(lengths, capacity) * 1.002


def test_what_rounds_hold_does_not_grow_with_rows():
    sizes = {n: 1 + n * 7919 % 50 for n in range(1, 2049)}
    small, large = (decide({n: c * k for n, c in sizes.items()}, 2048) for k in (1, 10_000))
    assert len(large[0]) < 2 * len(small[0]) + 10_000


HARD = [
    (1, None, "x"),
    (2, "", "x"),
    (3, "Ünï <|endoftext|>b\tc d e\x1cf'll  don't ́x", "x"),
    (4, "same text", None),
    (4, "same text", None),
    (None, "no id", "x"),
    (5, "many words " * 20_000 + "z" * 20_000, "x"),
]


def test_hard_rows(spark, encode):
    docs = spark.createDataFrame(HARD, "key long, body string, offset string")
    pieces = tokenized_pieces(docs, PATH, 64, 0, "key", "body")
    rows = pack(pieces, 64).collect()
    assert check_places(rows, 64) <= plain_best_fit([r.length for r in rows], 64)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for key, text, _ in HARD:
        found = [ids for _, ids in sorted(by_id[key])]
        whole = [i for ids in found for i in ids]
        assert whole == encode(text) * (2 if key == 4 else 1)
    assert pack(tokenized_pieces(docs.where("false"), PATH, 64, 0, "key", "body"), 64).collect() == []
    again = pack(pieces.withColumns({"Offset": F.lit(7), "offset_": F.lit(8)}), 64)
    assert again.columns == [*pieces.columns, "Offset__", "offset_", "sequence_id", "offset"]
    assert {(r["Offset__"], r["offset_"]) for r in again.collect()} == {(7, 8)}
    assert sorted((r.offset, r.length) for r in again.collect()) == sorted((r.offset, r.length) for r in rows)


def test_sequences_hold_their_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = pack(tokenized_pieces(docs, PATH)).cache()
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packed_sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
