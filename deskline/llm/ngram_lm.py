"""Interpolated modified Kneser-Ney model of order 2 or 3 (Chen and Goodman 1999),
counted in Spark and kept as sorted hash arrays that workers memory-map.

Words are 64-bit hashes. The sorted hashes of all words are cut into ranges, one file
each; a word's place in them is its number. A bigram is its two numbers in 64 bits,
mixed by a bijection, so bigrams never collide; its sorted keys are cut into ranges too.

A trigram is a 64-bit hash of its bigram and its last word, ranged by itself and not by
its bigram, so a bigram that many trigrams begin with fills no range. What trigrams add
to the bigrams they begin and end with travels as sums of each range. A bigram's own
count is then the number of words before it, or how often it begins a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import saved
from deskline.llm.hashing import WordHasher, mix, seeded, unmix
from deskline.llm.shared_arrays import SharedArrays, write_array
from deskline.sources.shared import shared_folder

# Tokens that a task counts, or scores, at a time.
_TOKENS = 2_000_000
# Text that a range stands for, at most.
_RANGE_BYTES = 64 << 20
START, END = (int(x) for x in seeded(2, 77))
_STATS = np.dtype([("total", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4"), ("before", "<u4")])
_CONTEXT = np.dtype([("key", "<u8"), *_STATS.descr])
_TRIGRAM = np.dtype([("key", "<u8"), ("word", "<u4"), ("n", "<u4")])
# Arrays beside those of bigrams and trigrams.
_BIGRAM_COLUMNS = {2: ("bigram-counts",), 3: ("adjusted", "context-total", "context-n1", "context-n2", "context-n3")}


@dataclass(frozen=True)
class NgramModel:
    """Where the arrays are, and the totals that do not grow with the corpus."""

    folder: str
    ranges: int  # files of words, and of bigrams
    offsets: tuple[int, ...]  # number of the first word of each range
    train_tokens: int
    vocabulary: int
    discounts: tuple[float, float, float]  # of bigrams seen 1, 2, 3 and more times
    lower_discounts: tuple[float, float, float]  # of words with so many words before
    bigrams: int
    lower_backoff: float
    order: int = 2
    trigram_discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)


def train_ngram_model(texts: DataFrame, text_col: str = "text", order: int = 2) -> NgramModel:
    """Count all texts, each a line of its words and one end. ``order`` is 2 or 3.

    Words are runs of anything but ASCII white space, with A-Z folded. A null text is
    empty: only its end is counted. Without rows, every token gets 1 / (0 + 1).

    Each task counts and sorts its own tokens before the shuffle, so a frequent word or
    bigram is one entry of each task. Ranges are of hashes, hence even; their number
    follows the bytes of all texts, and is that of ``spark.sql.shuffle.partitions`` at
    least. The driver sees a few numbers a range.
    """
    if order not in _BIGRAM_COLUMNS:
        raise ValueError("order must be 2 or 3")
    spark = texts.sparkSession
    folder = shared_folder(spark, "ngram-model")
    lines = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = lines.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = ranges_for(size * (order - 1), int(spark.conf.get("spark.sql.shuffle.partitions")))

    counted = lines.mapInArrow(lambda b: _word_blobs(b, ranges), "part int, data binary")
    words = saved(
        counted.groupBy("part").applyInArrow(lambda t: _write_words(t, folder), "part int, words long, known long, tokens long")
    ).collect()
    sizes = {r.part: r.words for r in words}
    starts = np.concatenate([[0], np.cumsum([sizes.get(i, 0) for i in range(ranges)])])
    if starts[-1] >= 2**32:
        raise ValueError("more than 2^32 distinct words")
    numbers = WordNumbers(folder, ranges, tuple(int(x) for x in starts))

    pairs = lines.mapInArrow(lambda b: _bigram_blobs(b, numbers, ranges), "part int, data binary")
    schema = "part int, data binary, bigrams long, counts array<long>"
    trigram_counts = (0, 0, 0, 0)
    if order == 2:
        merged = saved(pairs.groupBy("part").applyInArrow(lambda t: _write_bigrams(t, folder, numbers), schema))
    else:
        written = saved(pairs.groupBy("part").applyInArrow(lambda t: _write_bigram_counts(t, folder), "part int, data binary"))
        triples = lines.mapInArrow(lambda b: _trigram_blobs(b, numbers, ranges), "part int, data binary")
        added = saved(triples.groupBy("part").applyInArrow(lambda t: _write_trigrams(t, folder, ranges), "part int, data binary, counts array<long>"))
        trigram_counts = added.agg(*[F.sum(F.col("counts")[i]) for i in range(4)]).first()
        begins = _place_of(START, numbers)
        merged = saved(
            added.where("data is not null")
            .select("part", "data")
            .union(written)
            .groupBy("part")
            .applyInArrow(lambda t: _write_adjusted(t, folder, numbers, begins), schema)
        )
    totals = merged.agg(
        F.sum("bigrams").alias("bigrams"), *[F.sum(F.col("counts")[i]).alias(f"n{i + 1}") for i in range(4)]
    ).first()
    lower = saved(
        merged.where("data is not null")
        .groupBy("part")
        .applyInArrow(lambda t: _write_stats(t, folder, numbers), "part int, counts array<long>")
    )
    lower_totals = lower.agg(*[F.sum(F.col("counts")[i]).alias(f"n{i + 1}") for i in range(5)]).first()

    bigrams = totals.bigrams or 0
    lower_discounts = discounts(lower_totals[:4])
    n1, n2, _, _, more = (x or 0 for x in lower_totals)
    # Words with one, two and more words before them.
    freed = lower_discounts[0] * n1 + lower_discounts[1] * n2 + lower_discounts[2] * more
    return NgramModel(
        folder,
        ranges,
        numbers.offsets,
        sum(r.tokens for r in words),
        sum(r.known for r in words),
        discounts(totals[1:]),
        lower_discounts,
        bigrams,
        freed / bigrams if bigrams else 1.0,
        order,
        discounts(trigram_counts),
    )


def score_texts(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_tokens``, ``n_known`` (tokens seen in training), ``base_score`` (log10
    by word counts with 0.1 added), ``score`` (log10 probability of the text under the
    model) and ``perplexity`` for each row of ``docs``. Null texts are empty: one end."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return rows.mapInArrow(lambda b: _score(b, model), schema)


def discounts(counts) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of entries seen 1, 2, 3 and 4
    times; the usual defaults where a corpus is too small to tell."""
    n1, n2, n3, n4 = (float(x or 0) for x in counts)
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def ranges_for(size: int, partitions: int) -> int:
    """How many ranges, a power of two: one for each partition and each
    ``_RANGE_BYTES`` of text at least, so that a task can hold one whatever the settings."""
    return 1 << max(0, max(partitions, -(-size // _RANGE_BYTES)) - 1).bit_length()


# -- counting ------------------------------------------------------------------


def lines_of(batches: Iterator[pa.RecordBatch], hasher: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(tokens, first)`` for runs of texts: line ``i`` is START, its words and END, at
    ``tokens[first[i]:first[i + 1]]``."""
    for batch in batches:
        for _, hashes, first in hasher.texts(batch.column("text")):
            rows = len(first) - 1
            counts = np.diff(first)
            edges = np.concatenate([[0], np.cumsum(counts + 2)])
            tokens = np.empty(edges[-1], np.uint64)
            tokens[edges[:-1]] = START
            tokens[edges[1:] - 1] = END
            tokens[np.arange(len(hashes)) + np.repeat(2 * np.arange(rows) + 1, counts)] = hashes
            yield tokens, edges


def _gathered(lines) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    held, size = [], 0
    for line in lines:
        held.append(line)
        size += len(line[0])
        if size >= _TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences and counts, byte plane by byte plane, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.concatenate(
        [steps.view(np.uint8).reshape(-1, 8).T.ravel(), counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()]
    )
    return len(keys).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=size * 12, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes[: size * 8].reshape(8, size).T).view("<u8").ravel()
    counts = np.ascontiguousarray(planes[size * 8 :].reshape(4, size).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _blob_batch(parts: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "data"])


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    bits = ranges.bit_length() - 1
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _word_blobs(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    for held in _gathered(lines_of(batches, WordHasher())):
        words, counts = np.unique(np.concatenate([tokens for tokens, _ in held]), return_counts=True)
        counts[words == START] = 0  # a context only, never a token
        edges = np.searchsorted(_range_of(words, ranges), np.arange(ranges + 1))
        filled = np.flatnonzero(np.diff(edges))
        blobs = [_pack(words[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]]) for i in filled]
        yield _blob_batch(filled.tolist(), blobs)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as many bytes as the largest needs, up to 8."""
    most = int(counts.max()) if len(counts) else 0
    return counts.astype(next(kind for kind in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(kind).max))


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    found = [_unpack(x.as_py()) for x in table.column("data")]
    return _summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))


def _write_words(table: pa.Table, folder: str) -> pa.Table:
    part = table.column("part")[0].as_py()
    words, counts = _merged(table)
    write_array(folder, f"words-{part}", words)
    write_array(folder, f"counts-{part}", counts)
    row = {"part": [part], "words": [len(words)], "known": [int((counts > 0).sum())], "tokens": [int(counts.sum())]}
    return pa.table(row, pa.schema([("part", pa.int32()), *((c, pa.int64()) for c in ("words", "known", "tokens"))]))


class WordNumbers:
    """The number of a word: its place in the sorted hashes of all ranges."""

    def __init__(self, folder: str, ranges: int, offsets: tuple[int, ...]):
        self.arrays, self.ranges, self.offsets = SharedArrays(folder), ranges, offsets

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted hashes, -1 for unknown words."""
        numbers = np.full(len(hashes), -1, np.int64)
        edges = np.searchsorted(_range_of(hashes, self.ranges), np.arange(self.ranges + 1))
        for i in np.flatnonzero(np.diff(edges)):
            if self.offsets[i + 1] == self.offsets[i]:
                continue
            known, wanted = self.arrays[f"words-{i}"], hashes[edges[i] : edges[i + 1]]
            place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            numbers[edges[i] : edges[i + 1]] = np.where(known[place] == wanted, place + self.offsets[i], -1)
        return numbers

    def take(self, name: str, numbers: np.ndarray, kind: np.dtype | str) -> np.ndarray:
        """Entries of the arrays ``name-<range>`` for sorted numbers; zeros for -1."""
        found = np.zeros(len(numbers), kind)
        edges = np.searchsorted(numbers, self.offsets)
        for i in np.flatnonzero(np.diff(edges)):
            at = slice(edges[i], edges[i + 1])
            found[at] = self.arrays[f"{name}-{i}"][numbers[at] - self.offsets[i]]
        return found


def _bigram_blobs(batches: Iterator[pa.RecordBatch], numbers: WordNumbers, ranges: int) -> Iterator[pa.RecordBatch]:
    for held in _gathered(lines_of(batches, WordHasher())):
        tokens = np.concatenate([t for t, _ in held])
        words, which = np.unique(tokens, return_inverse=True)
        number = numbers.look_up(words).astype(np.uint64)[which]
        pairs = (number[:-1] << np.uint64(32)) | number[1:]
        pairs, counts = np.unique(pairs[tokens[1:] != START], return_counts=True)
        part = _range_of(mix(pairs), ranges)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(ranges + 1))
        for i in np.flatnonzero(np.diff(edges)):
            own = order[edges[i] : edges[i + 1]]
            yield _blob_batch([int(i)], [_pack(pairs[own], counts[own])])


def _write_bigrams(table: pa.Table, folder: str, numbers: WordNumbers) -> pa.Table:
    """Write a range of bigrams, and return what they add to the words' statistics."""
    part, pairs, counts = _bigrams_of(table, folder)
    return _added_to_words(part, pairs, counts, numbers)


def _write_bigram_counts(table: pa.Table, folder: str) -> pa.Table:
    """Write a range of bigrams, and return its number without data."""
    part, _, _ = _bigrams_of(table, folder)
    return pa.Table.from_batches([_blob_batch([part], [None])])


def _bigrams_of(table: pa.Table, folder: str) -> tuple[int, np.ndarray, np.ndarray]:
    part = table.column("part")[0].as_py()
    pairs, counts = _merged(table)
    keys = mix(pairs)
    order = np.argsort(keys)
    write_array(folder, f"bigrams-{part}", keys[order])
    write_array(folder, f"bigram-counts-{part}", _narrow(counts[order]))
    return part, pairs, counts


def _added_to_words(part: int, pairs: np.ndarray, counts: np.ndarray, numbers: WordNumbers) -> pa.Table:
    """What bigrams with these counts add to the words' statistics: a blob for each
    range of words, and a row with the number of bigrams and of the rare ones."""
    before, after = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    added = []
    for word, columns in (
        (before, {"total": counts, "n1": counts == 1, "n2": counts == 2, "n3": counts > 2}),
        (after, {"before": np.ones(len(after), np.int64)}),
    ):
        order = np.argsort(word, kind="stable")
        word = word[order]
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        rows = np.zeros(len(first), [("word", "<u4"), *_STATS.descr])
        rows["word"] = word[first]
        for name, values in columns.items():
            rows[name] = np.add.reduceat(np.asarray(values, np.int64)[order], first)
        added.append(rows)
    out: dict[str, list] = {"part": [], "data": [], "bigrams": [], "counts": []}
    for rows in added:
        edges = np.searchsorted(rows["word"].astype(np.int64), numbers.offsets)
        for i in np.flatnonzero(np.diff(edges)):
            own = rows[edges[i] : edges[i + 1]].copy()
            own["word"] -= numbers.offsets[i]
            data = np.frombuffer(own.tobytes(), np.uint8).reshape(len(own), -1).T.tobytes()
            out["part"].append(int(i))
            out["data"].append(len(own).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True))
            out["bigrams"].append(0)
            out["counts"].append([0, 0, 0, 0])
    out["part"].append(part)
    out["data"].append(None)
    out["bigrams"].append(len(pairs))
    out["counts"].append([int((counts == n).sum()) for n in range(1, 5)])
    kinds = (pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
    return pa.table(out, pa.schema(list(zip(out, kinds))))


def _packed_rows(rows: np.ndarray) -> bytes:
    """Rows sorted by their first column, ``key``, byte plane by byte plane, compressed."""
    rows = rows.copy()
    rows["key"] = np.diff(rows["key"], prepend=np.uint64(0))
    planes = np.frombuffer(rows.tobytes(), np.uint8).reshape(len(rows), -1).T.tobytes()
    return len(rows).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked_rows(data: bytes, kind: np.dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], decompressed_size=size * kind.itemsize, codec="zstd", asbytes=True)
    rows = np.frombuffer(np.frombuffer(planes, np.uint8).reshape(-1, size).T.tobytes(), kind).copy()
    rows["key"] = np.cumsum(rows["key"], dtype=np.uint64)
    return rows


def _place_of(word: int, numbers: WordNumbers) -> int:
    return int(numbers.look_up(np.array([word], np.uint64))[0])


def _trigram_keys(pairs: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(mix(pairs) + last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _summed_trigrams(pairs: np.ndarray, last: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct trigrams, sorted by bigram and last word, with the sums of their counts."""
    if not len(pairs):
        return pairs, last, counts
    order = np.lexsort((last, pairs))
    pairs, last, counts = pairs[order], last[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (last[1:] != last[:-1])]))
    return pairs[first], last[first], np.add.reduceat(counts, first)


def _trigram_blobs(batches: Iterator[pa.RecordBatch], numbers: WordNumbers, ranges: int) -> Iterator[pa.RecordBatch]:
    for held in _gathered(lines_of(batches, WordHasher())):
        tokens = np.concatenate([t for t, _ in held])
        words, which = np.unique(tokens, return_inverse=True)
        number = numbers.look_up(words).astype(np.uint64)[which]
        at = np.flatnonzero((tokens[2:] != START) & (tokens[1:-1] != START))
        pairs = (number[at] << np.uint64(32)) | number[at + 1]
        pairs, last, counts = _summed_trigrams(pairs, number[at + 2], np.ones(len(at), np.int64))
        part = _range_of(_trigram_keys(pairs, last), ranges)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(ranges + 1))
        for i in np.flatnonzero(np.diff(edges)):
            own = order[edges[i] : edges[i + 1]]
            rows = np.empty(len(own), _TRIGRAM)
            rows["key"], rows["word"], rows["n"] = pairs[own], last[own], counts[own]
            yield _blob_batch([int(i)], [_packed_rows(rows)])


def _write_trigrams(table: pa.Table, folder: str, ranges: int) -> pa.Table:
    """Write a range of trigrams, and return what they add to bigrams: a blob for each
    range of those they begin with, and of those they end with."""
    part = table.column("part")[0].as_py()
    rows = np.concatenate([_unpacked_rows(x.as_py(), _TRIGRAM) for x in table.column("data")])
    pairs, last, counts = _summed_trigrams(rows["key"], rows["word"], rows["n"].astype(np.int64))
    del rows
    keys = _trigram_keys(pairs, last)
    order = np.argsort(keys)
    write_array(folder, f"trigrams-{part}", keys[order])
    write_array(folder, f"trigram-counts-{part}", _narrow(counts[order]))

    out: dict[str, list] = {"part": [part], "data": [None], "counts": [[int((counts == n).sum()) for n in range(1, 5)]]}
    ends = (pairs << np.uint64(32)) | last.astype(np.uint64)
    for bigrams, columns in (
        (pairs, {"total": counts, "n1": counts == 1, "n2": counts == 2, "n3": counts > 2}),
        (ends, {"before": np.ones(len(ends), np.int64)}),
    ):
        order = np.argsort(bigrams, kind="stable")
        bigrams = bigrams[order]
        first = np.flatnonzero(np.concatenate([[True], bigrams[1:] != bigrams[:-1]]))
        added = np.zeros(len(first), _CONTEXT)
        added["key"] = bigrams[first]
        for name, values in columns.items():
            added[name] = np.add.reduceat(np.asarray(values, np.int64)[order], first)
        place = _range_of(mix(added["key"]), ranges)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(ranges + 1))
        for i in np.flatnonzero(np.diff(edges)):
            out["part"].append(int(i))
            out["data"].append(_packed_rows(added[order[edges[i] : edges[i + 1]]]))
            out["counts"].append([0, 0, 0, 0])
    kinds = (pa.int32(), pa.binary(), pa.list_(pa.int64()))
    return pa.table(out, pa.schema(list(zip(out, kinds))))


def _write_adjusted(table: pa.Table, folder: str, numbers: WordNumbers, begins: int) -> pa.Table:
    """What trigrams say of a range of bigrams: as contexts, and their own counts. The
    latter are what they add to the words' statistics, which is returned."""
    part = table.column("part")[0].as_py()
    arrays = SharedArrays(folder)
    keys = np.asarray(arrays[f"bigrams-{part}"])
    stats = np.zeros(len(keys), _STATS)
    for blob in table.column("data"):
        if blob.is_valid:
            rows = _unpacked_rows(blob.as_py(), _CONTEXT)
            place = np.searchsorted(keys, mix(rows["key"]))
            for name in _STATS.names:
                stats[name][place] += rows[name]  # a bigram is once in a blob
    for name in ("total", "n1", "n2", "n3"):
        write_array(folder, f"context-{name}-{part}", _narrow(stats[name]))
    pairs = unmix(keys)
    begun = (pairs >> np.uint64(32)).astype(np.int64) == begins
    counts = np.where(begun, np.asarray(arrays[f"bigram-counts-{part}"]).astype(np.int64), stats["before"].astype(np.int64))
    write_array(folder, f"adjusted-{part}", _narrow(counts))
    return _added_to_words(part, pairs, counts, numbers)


def _write_stats(table: pa.Table, folder: str, numbers: WordNumbers) -> pa.Table:
    part = table.column("part")[0].as_py()
    kind = np.dtype([("word", "<u4"), *_STATS.descr])
    stats = np.zeros(numbers.offsets[part + 1] - numbers.offsets[part], _STATS)
    for blob in table.column("data"):
        blob = blob.as_py()
        size = int.from_bytes(blob[:8], "little")
        data = pa.decompress(blob[8:], decompressed_size=size * kind.itemsize, codec="zstd", asbytes=True)
        rows = np.frombuffer(np.frombuffer(data, np.uint8).reshape(-1, size).T.tobytes(), kind)
        for name in _STATS.names:
            stats[name][rows["word"]] += rows[name]  # a word is once in a blob
    write_array(folder, f"stats-{part}", stats)
    before = stats["before"]
    counts = [int((before == n).sum()) for n in range(1, 5)] + [int((before > 2).sum())]
    return pa.table({"part": [part], "counts": [counts]}, pa.schema([("part", pa.int32()), ("counts", pa.list_(pa.int64()))]))


# -- scoring -------------------------------------------------------------------


def _score(batches: Iterator[pa.RecordBatch], model: NgramModel) -> Iterator[pa.RecordBatch]:
    numbers = WordNumbers(model.folder, model.ranges, model.offsets)
    hasher = WordHasher()
    for batch in batches:
        held, scored = [], []
        for line in lines_of([batch], hasher):
            held.append(line)
            if sum(len(t) for t, _ in held) >= _TOKENS:
                scored.append(_score_lines(held, model, numbers))
                held = []
        if held:
            scored.append(_score_lines(held, model, numbers))
        n_tokens, n_known, base, score = (
            np.concatenate(c) if scored else np.empty(0) for c in (zip(*scored) if scored else [[]] * 4)
        )
        columns = [
            batch.column("id"),
            pa.array(n_tokens, pa.int64()),
            pa.array(n_known, pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(score, pa.float64()),
            pa.array(10 ** (-score / np.maximum(n_tokens, 1)), pa.float64()),
        ]
        names = ["id", "n_tokens", "n_known", "base_score", "score", "perplexity"]
        yield pa.RecordBatch.from_arrays(columns, names)


def _score_lines(held, model: NgramModel, numbers: WordNumbers):
    tokens = np.concatenate([t for t, _ in held])
    lengths = np.concatenate([np.diff(e) for _, e in held])
    line = np.repeat(np.arange(len(lengths)), lengths)[1:]
    real = tokens[1:] != START

    words, which = np.unique(tokens, return_inverse=True)
    number = numbers.look_up(words)
    order = np.argsort(number, kind="stable")
    counts, stats = np.empty(len(words)), np.empty(len(words), _STATS)
    counts[order] = numbers.take("counts", number[order], "<i8")
    stats[order] = numbers.take("stats", number[order], _STATS) if model.bigrams else np.zeros(len(words), _STATS)

    base = np.log10((counts + 0.1) / (model.train_tokens + 0.1 * (model.vocabulary + 1)))
    lower = np.full(len(words), model.lower_backoff / (model.vocabulary + 1))
    if model.bigrams:
        lower += _discounted(stats["before"].astype(np.int64), model.lower_discounts) / model.bigrams
    total = stats["total"].astype(np.float64)
    freed = sum(d * stats[n] for d, n in zip(model.discounts, ("n1", "n2", "n3")))
    backoff = np.where(total > 0, freed / np.maximum(total, 1), 1.0)

    u, w = which[:-1], which[1:]
    u_number, w_number = number[u], number[w]
    known = np.flatnonzero((u_number >= 0) & (w_number >= 0) & real) if model.bigrams else np.empty(0, np.int64)
    pairs = (u_number.astype(np.uint64) << np.uint64(32)) | w_number.astype(np.uint64)
    columns = _found(mix(pairs[known]), "bigrams", _BIGRAM_COLUMNS[model.order], model, numbers)
    seen = np.zeros(len(u), np.int64)
    seen[known] = columns[0]
    chance = _discounted(seen, model.discounts) / np.maximum(total[u], 1) + backoff[u] * lower[w]
    if model.order == 3:
        # Of places whose two words before are a known bigram.
        context = np.zeros((4, len(u)))
        context[:, known] = columns[1:]
        total, *rare = context[:, :-1]
        at = np.flatnonzero((total > 0) & real[1:])
        seen = np.zeros(len(at), np.int64)
        last = w_number[at + 1]
        whole = np.flatnonzero(last >= 0)
        seen[whole] = _found(_trigram_keys(pairs[at[whole]], last[whole]), "trigrams", ("trigram-counts",), model, numbers)[0]
        freed = sum(d * n[at] for d, n in zip(model.trigram_discounts, rare))
        chance[at + 1] = (_discounted(seen, model.trigram_discounts) + freed * chance[at + 1]) / total[at]

    def per_line(values: np.ndarray) -> np.ndarray:
        return np.bincount(line[real], values[real], minlength=len(lengths))

    return (
        per_line(np.ones(len(w))).astype(np.int64),
        per_line((counts[w] > 0).astype(float)).astype(np.int64),
        per_line(base[w]),
        per_line(np.log10(chance)),
    )


def _discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0.0)


def _found(keys: np.ndarray, name: str, columns: tuple[str, ...], model: NgramModel, numbers: WordNumbers) -> list[np.ndarray]:
    """Entries of the arrays ``columns`` for keys of the sorted arrays ``name``; zeros
    for those that are not there."""
    keys, which = np.unique(keys, return_inverse=True)
    edges = np.searchsorted(_range_of(keys, model.ranges), np.arange(model.ranges + 1))
    found = [np.zeros(len(keys), np.int64) for _ in columns]
    for i in np.flatnonzero(np.diff(edges)):
        own = slice(edges[i], edges[i + 1])
        try:
            known = numbers.arrays[f"{name}-{i}"]
        except FileNotFoundError:  # none in this range
            continue
        place = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
        there = known[place] == keys[own]
        for values, column in zip(found, columns):
            values[own] = np.where(there, numbers.arrays[f"{column}-{i}"][place].astype(np.int64), 0)
    return [values[which] for values in found]
