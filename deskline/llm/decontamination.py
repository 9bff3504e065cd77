"""Benchmark passages in documents, up to edits of words.

The CGK embedding (Chakraborty, Goldenberg and Koucky 2016) reads a string by a random
walk: at each step it writes the symbol it stands on, and a random bit of that symbol
and step says whether it moves on. Two strings at a small edit distance give outputs at
a small Hamming distance, as the walks meet again after an edit. Bit-sampling LSH then
takes a few steps of the output as a key. Here symbols are words. Every walk writes its
first word at step 0, which all keys sample: so only windows of a document that begin
with a word which an item's window begins with are walked, and the others are known not
to collide.

A walk ends where the item ends, and the walk of a document after as many words: so the
zeros that a walk writes outside its window fall on the same steps of both. Steps are
scaled to the words that are left. Each item is walked from several of its words with
several seeds, which gives the recall.

Short items leave a walk too little to read. They are cut into one piece more than edits
are allowed, so that every passage holds one piece as it is (pigeonhole), and the pieces
are looked up as n-grams: of short items none is lost.

Each collision is then verified by the exact edit distance of the whole item.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import fresh
from deskline.llm.hashing import WordHasher, mix, seeded

# Walks start at so many words of an item, one in each of as many equal parts of it.
_STARTS = 6
# Seeds of the walk.
_SEEDS = 6
# Steps of a walk, one for each bit of a hash, and steps that a key samples besides 0.
_STEPS, _SAMPLED = 32, 3
# Words that a walk has left at least, and words below which an item is short.
_LEFT, _SHORT = 4, 32
# Items that are looked for at once.
_ITEMS = 20_000
_FILTER_BITS = 20


@dataclass(frozen=True)
class ItemIndex:
    """A block of items, and the keys of their walks. Bounded by the block."""

    ids: list
    words: list[np.ndarray]
    first_words: np.ndarray  # a table of hash bits: may a walk or piece begin here
    opening: np.ndarray  # first words of walks, sorted, once for each number of words left
    left: np.ndarray  # of each opening
    sizes: list[int]  # of pieces, ascending
    keys: np.ndarray  # of walks and pieces, sorted
    item: np.ndarray  # of each key
    start: np.ndarray  # word of the item where the walk or piece began
    percent: int


def find_benchmark_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    percent: int = 80,
) -> DataFrame:
    """``id``, ``item_id``, ``distance``, ``item_words``, ``similarity`` and ``start``
    (first word of the passage's neighbourhood) for each document and benchmark item of
    which it holds a passage.

    A passage is a run of words whose edit distance to the whole item, in words, is at
    most (100 - ``percent``) % of the item's words. Words are runs of ASCII letters,
    digits and non-ASCII characters, with A-Z folded. Of several passages the closest
    one, and then the first, is given. Items are looked for in blocks of 20,000 rows,
    each small enough to be broadcast; documents are never shuffled.

    Null and empty texts hold nothing, and items without words are never found. A null id
    stays null. Repeated documents and items give a row each.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_kind, item_kind = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()
    schema = f"id {id_kind}, item_id {item_kind}, distance int, item_words int, similarity double, start long"
    found = None
    for index in _blocks(benchmark, item_id_col, item_text_col, percent):
        held = docs.sparkSession.sparkContext.broadcast(index)
        part = rows.mapInArrow(_finder(held, item_kind_of(benchmark, item_id_col)), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all columns."""
    for index in _blocks(benchmark, None, item_text_col, percent):
        held = docs.sparkSession.sparkContext.broadcast(index)
        name = fresh(docs, "passages")
        docs = docs.withColumn(name, _counter(held)(F.coalesce(F.col(text_col), F.lit("")))).where(F.col(name) == 0).drop(name)
    return docs


def item_kind_of(benchmark: DataFrame, item_id_col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(benchmark.schema[item_id_col].dataType)


def _finder(held, item_kind: pa.DataType) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for row, item, distance, start in _passages(batch.column("text"), index):
                size = len(index.words[item])
                for column, value in zip(out, (row, index.ids[item], distance, size, 1 - distance / size, start)):
                    column.append(value)
            kinds = (item_kind, pa.int32(), pa.int32(), pa.float64(), pa.int64())
            columns = [batch.column("id").take(pa.array(out[0], pa.int64()))]
            columns += [pa.array(c, kind) for c, kind in zip(out[1:], kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "item_id", "distance", "item_words", "similarity", "start"])

    return find


def _counter(held) -> Callable:
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            counts = np.zeros(len(column), np.int64)
            for row, *_ in _passages(column, held.value):
                counts[row] += 1
            yield pa.array(counts)

    return F.arrow_udf(count, "long")


# -- the index -----------------------------------------------------------------


def _blocks(benchmark: DataFrame, item_id_col: str | None, item_text_col: str, percent: int) -> Iterator[ItemIndex]:
    """The items in blocks of bounded size."""
    item_id = F.lit(None) if item_id_col is None else F.col(item_id_col)
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(item_id.alias("id"), F.col(item_text_col).alias("text"))
    blocks = -(-items.count() // _ITEMS)
    block = F.pmod(F.xxhash64("text"), F.lit(max(blocks, 1)))
    for i in range(blocks):
        rows = items.where(block == i).collect()
        yield item_index([r.id for r in rows], [r.text for r in rows], percent)


def item_index(ids: list, texts: list[str], percent: int) -> ItemIndex:
    words = []
    for _, hashes, first in WordHasher(letters_only=True).texts(pa.array(texts, pa.string())):
        words += [hashes[s:e].copy() for s, e in zip(first[:-1], first[1:])]
    flat = np.concatenate([*words, np.zeros(0, np.uint64)])
    # Walk from the word of each part that the fewest items have: few other texts will.
    known, counts = np.unique(flat, return_counts=True)
    walks, pieces = [], []
    for item, own in enumerate(words):
        if len(own) < _SHORT:
            edges = np.linspace(0, len(own), min(_allowed(own, percent) + 1, len(own)) + 1).astype(int)
            pieces += [(item, s, e - s) for s, e in zip(edges[:-1], edges[1:])]
            continue
        common = counts[np.searchsorted(known, own)]
        edges = np.unique(np.linspace(0, len(own) - _LEFT + 1, _STARTS + 1).astype(int))
        for s, e in zip(edges[:-1], edges[1:]):
            start = s + int(np.argmin(common[s:e]))
            walks.append((item, start, min(len(own) - start, _STEPS)))
    begin = np.cumsum([0, *(len(w) for w in words)])
    item, start, left = np.array(walks, np.int64).reshape(-1, 3).T
    at = begin[item] + start
    keys = [_keys(flat, at, at + left, left, seed) for seed in range(_SEEDS)]
    items, starts = [item] * _SEEDS, [start] * _SEEDS
    piece_of, piece_at, size = np.array(pieces, np.int64).reshape(-1, 3).T
    places = begin[piece_of] + piece_at
    for n, grams in _grams(flat, places, np.unique(size).tolist(), begin[piece_of] + piece_at + size):
        keys.append(grams[size == n])
        items.append(piece_of[size == n])
        starts.append(piece_at[size == n])
    flat_keys = np.concatenate(keys)
    order = np.argsort(flat_keys)
    first_words = np.zeros(1 << _FILTER_BITS, bool)
    first_words[(flat[np.concatenate([at, places])] >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    openings = np.unique(np.stack([flat[at], left.astype(np.uint64)], 1), axis=0)
    return ItemIndex(
        ids,
        words,
        first_words,
        openings[:, 0].copy(),
        openings[:, 1].astype(np.int64),
        np.unique(size).tolist(),
        flat_keys[order],
        np.concatenate(items)[order],
        np.concatenate(starts)[order],
        percent,
    )


def _allowed(own: np.ndarray, percent: int) -> int:
    """Edits that a passage of the item may have."""
    return len(own) * (100 - percent) // 100


def _keys(words: np.ndarray, at: np.ndarray, end: np.ndarray, left: np.ndarray, seed: int) -> np.ndarray:
    """The sampled outputs of the walks that begin at ``at`` in a run of words, hashed. A
    walk that leaves its window, ``left`` words or up to ``end``, writes zeros."""
    if not len(at):
        return np.zeros(0, np.uint64)
    salt = seeded(seed + 1, 57)[seed]
    bits = mix(words ^ salt)
    steps = np.sort(np.random.default_rng(1000 + seed).choice(np.arange(2, _STEPS), _SAMPLED, replace=False))
    # A walk moves at every other step or so: over half as many words as it has steps.
    scale = np.minimum(left, _STEPS // 2)
    sampled = [np.maximum(step * scale // (_STEPS // 2), 1) for step in steps]
    outputs = [np.zeros(len(at), np.uint64) for _ in sampled]
    place, last = at.copy(), np.minimum(end, at + left) - 1
    for step in range(int(steps[-1]) + 1):
        inside = np.minimum(place, last)
        written = np.where(place <= last, words[inside], np.uint64(0))
        for output, of in zip(outputs, sampled):
            np.copyto(output, written, where=of == step)
        place += ((bits[inside] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    key = words[at] * np.uint64(2 * seed + 3) + left.astype(np.uint64)
    for output in outputs:
        key = mix(key) + output
    return mix(key ^ salt)


def _grams(words: np.ndarray, at: np.ndarray, sizes: list[int], end: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each size, and the hash of so many words from each of ``at``; 0 where ``end`` is
    before."""
    if not len(at):
        return
    key = np.zeros(len(at), np.uint64)
    for n in range(1, max(sizes, default=0) + 1):
        key = mix(key + np.uint64(n)) + words[np.minimum(at + n - 1, len(words) - 1)]
        if n in sizes:
            yield n, np.where(at + n <= end, mix(key), np.uint64(0))


# -- the search ----------------------------------------------------------------


def _passages(column: pa.Array, index: ItemIndex) -> Iterator[tuple[int, int, int, int]]:
    """``(row, item, distance, start)`` of each passage of the texts."""
    if not len(index.keys):
        return
    for row, words, first in WordHasher(letters_only=True).texts(column):
        at = np.flatnonzero(index.first_words[(words >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at):
            continue
        line = np.searchsorted(first, at, "right") - 1
        # Each place is walked once for each number of words that is left to an item there.
        low, high = np.searchsorted(index.opening, words[at], "left"), np.searchsorted(index.opening, words[at], "right")
        walk, opening = _spread(low, high)
        found = [_hits(index, _keys(words, at[walk], first[line[walk] + 1], index.left[opening], seed), at[walk], line[walk]) for seed in range(_SEEDS)]
        found += [_hits(index, grams, at, line) for _, grams in _grams(words, at, index.sizes, first[line + 1])]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for text, item, origin in np.unique(np.concatenate(found), axis=0).tolist():
            if best.get((text, item), (1, 0))[0] == 0:
                continue
            own, begin_of, end_of = index.words[item], int(first[text]), int(first[text + 1])
            allowed = _allowed(own, index.percent)
            low, high = max(begin_of, origin - allowed), min(end_of, origin + len(own) + allowed)
            distance = passage_distance(own, words[low:high])
            if distance <= allowed and (distance, low - begin_of) < best.get((text, item), (allowed + 1, 0)):
                best[text, item] = (distance, low - begin_of)
        for (text, item), (distance, start) in best.items():
            yield row + text, item, distance, start


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number from ``low`` up to ``high``: its row, and itself."""
    count = high - low
    row = np.repeat(np.arange(len(low)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]


def _hits(index: ItemIndex, keys: np.ndarray, at: np.ndarray, line: np.ndarray) -> np.ndarray:
    """``text, item, origin`` for each key of the index that one of ``keys`` meets."""
    hit, k = _spread(np.searchsorted(index.keys, keys, "left"), np.searchsorted(index.keys, keys, "right"))
    return np.stack([line[hit], index.item[k], at[hit] - index.start[k]], 1)


def passage_distance(item: np.ndarray, words: np.ndarray) -> int:
    """The smallest edit distance of ``item`` to any run of ``words`` (Sellers 1980)."""
    ramp = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())
