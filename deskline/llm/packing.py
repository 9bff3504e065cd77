"""Packing of documents into training sequences by bulk-synchronous best fit.

Documents and gaps are kept in the order of their sizes. In a round, a sweep matches the
largest documents left with their successors, the smallest gaps that hold them; of
documents with the same successor the first ranks win and the others go on to the next
larger gap; the gaps are updated, and the next round begins.

Sizes are whole numbers up to the capacity. A sorted order of any length is therefore a
run for each size, and a sweep over runs decides for all documents of a size at once: it
says which ranks go to which sequences. Ranks are given, and decisions applied, in
parallel to all rows; what the rounds hold is bounded by the capacity, not by the rows.
"""

from __future__ import annotations

import re
import sys
import types
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskline.llm.common import fresh, set_aside, table_of

# Distinct words whose ids a worker remembers: those that it meets first.
_KNOWN_WORDS = 500_000
# Texts whose new words are encoded together.
_TOGETHER = 256


def tokenized_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned
    32-bit numbers) for each piece of each document.

    A document is the ids of its whole text and then ``end_id``. Only one with more than
    ``capacity`` ids is cut, into pieces of ``capacity`` and a last one. Null texts are
    empty: the end alone. The tokenizer is a file of the tokenizers library, read by the
    driver; it must never make a token across white space, since the words between are
    encoded by themselves and remembered.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        rules = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids binary"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _word_encoder(rules.value)
        end, step = end_id.to_bytes(4, "little"), 4 * capacity
        for batch in batches:
            for start in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(start, _TOGETHER)
                out: list[list] = [[], [], [], []]
                owner = []
                for row, ids in enumerate(encode(part.column("text").to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), step)):
                        held = ids[at : at + step]
                        owner.append(row)
                        for column, value in zip(out, (piece, at // 4, len(held) // 4, held)):
                            column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                columns = [part.column("id").take(pa.array(owner, pa.int64()))]
                columns += [pa.array(c, kind) for c, kind in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])

    return rows.mapInArrow(pieces, schema)


def _word_encoder(rules: str):
    """Ids of texts as bytes. The tokenizer and the words it has met first are shared by
    the tasks that one worker runs.

    If the tokenizer folds case and tells letters from stops, words are looked up without
    the stops behind them, and where a text holds no marks that would compose with a letter, no special token and
    no separator that only Python takes for a space, its A-Z are folded first, as the
    tokenizer does, so a word is met in one form.
    """
    shared = sys.modules.setdefault("_deskline_word_ids", types.ModuleType("_deskline_word_ids"))
    if getattr(shared, "rules", None) != rules:
        from tokenizers import Tokenizer

        shared.rules, shared.tokenizer, shared.known = rules, Tokenizer.from_str(rules), {}
    tokenizer, known = shared.tokenizer, shared.known
    special = re.compile("[\u0300-\u036f\x1c-\x1f]|<\\|").search
    split = re.compile("[^ \t\r\n]+").findall
    # New words are encoded together, with a word between them whose id no other has.
    between = "\x01"
    mark = tokenizer.encode(between, add_special_tokens=False).ids
    same = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("Word,. a", "word ,. a")]
    folds = same[0] == same[1]  # folds letters, and tells them from stops

    def words_of(text: str) -> list[str]:
        if not folds or special(text):
            return split(text)
        return (text.lower() if text.isascii() else text.encode().lower().decode()).split()

    def encode_new(new: list[str]) -> dict[str, bytes]:
        plain = [w for w in new if between not in w and not special(w)] if len(mark) == 1 else []
        joined = np.array(tokenizer.encode_batch_fast([f" {between} ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(joined == mark[0]).tolist() if plain else []
        found = {}
        if plain and len(ends) == len(plain) - 1:
            for word, start, end in zip(plain, [0, *(e + 1 for e in ends)], [*ends, len(joined)]):
                found[word] = joined[start:end].tobytes()
        rest = [w for w in new if w not in found]
        for word, ids in zip(rest, tokenizer.encode_batch(rest, add_special_tokens=False)):
            found[word] = np.array(ids.ids, "<u4").tobytes()
        return found

    def parts_of(word: str) -> tuple[str, ...]:
        """The word and the stops behind it: no token holds a letter and a stop."""
        core = word.rstrip(".,")
        return (core, word[len(core) :]) if core != word and core[-1:].isalnum() else (word,)

    def encode(texts: list[str]) -> Iterator[bytes]:
        lines = [words_of(t) for t in texts]
        ids = [list(map(known.get, words)) for words in lines]
        missing = {w for words, own in zip(lines, ids) if None in own for w, x in zip(words, own) if x is None}
        pieces = {w: parts_of(w) for w in missing} if folds else {w: (w,) for w in missing}
        new = {p for parts in pieces.values() for p in parts if p not in known}
        met = encode_new(sorted(new)) if new else {}
        found = {w: b"".join([met[p] if p in met else known[p] for p in parts]) for w, parts in pieces.items()}
        if len(known) < _KNOWN_WORDS:
            known.update(met)
        if len(known) < _KNOWN_WORDS // 2:
            known.update(found)
        for words, own in zip(lines, ids):
            if None in own:
                own = [found[w] if x is None else x for w, x in zip(words, own)]
            yield b"".join(own)

    return encode


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each piece's place in a sequence
    of at most ``capacity`` tokens, gapless from 0.

    ``pieces`` has ``id``, ``piece`` and ``length`` (1 to ``capacity``; anything else
    fails); other columns are kept, one that is named ``sequence_id`` or ``offset`` under
    that name with ``_`` behind it. Pieces equal in id and number (rows that were there
    twice) are each placed. An empty table gives no rows.
    """
    pieces = table_of(set_aside(pieces, ("sequence_id", "offset")), "pieces")
    slices = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, rank, before = (fresh(pieces, c) for c in ("part", "rank", "before"))

    # Ranks within a length: a length that most pieces have is numbered in slices.
    sliced = pieces.withColumn(part, F.pmod(F.xxhash64("id", "piece"), F.lit(slices)).cast("int"))
    counts = sliced.groupBy("length", part).agg(F.count(F.lit(1)).alias(rank))
    earlier = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", part, F.coalesce(F.sum(rank).over(earlier), F.lit(0)).alias(before))
    own = Window.partitionBy("length", part).orderBy("id", "piece")
    ranked = (
        sliced.join(starts, ["length", part])
        .withColumn(rank, F.col(before) + F.row_number().over(own) - 1)
        .select(*pieces.columns, rank)
    )

    sizes = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    decided = pieces.sparkSession.sparkContext.broadcast(decide(sizes, capacity))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, offset = decided.value
        order = (length << 40) | first
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(order, (lengths << 40) | ranks, "right") - 1
            columns = batch.columns[:-1] + [pa.array(sequence[at] + ranks - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def decide(sizes: dict[int, int], capacity: int) -> tuple[np.ndarray, ...]:
    """The rounds. ``sizes``: number of documents of each length.

    Returns ``length``, ``first``, ``sequence`` and ``offset``, sorted by the first two:
    documents of a length with ranks from ``first`` up to the next entry go to the
    sequences from ``sequence`` on, one each, at ``offset``.
    """
    if any(not 0 < length <= capacity for length in sizes):
        raise ValueError(f"lengths must be 1 to {capacity}")
    left, done = dict(sizes), dict.fromkeys(sizes, 0)
    gaps: list[deque] = [deque() for _ in range(capacity + 1)]  # runs (first sequence, how many) by size
    decided: list[tuple[int, int, int, int]] = []
    sequences = 0

    def put(length: int, first: int, many: int, offset: int) -> None:
        decided.append((length, done[length], first, offset))
        done[length] += many
        left[length] -= many

    while any(left.values()):
        largest = max(length for length, n in left.items() if n)
        octave = [length for length in range(largest, largest // 2, -1) if left.get(length)]
        updated = _sweep(octave, left, gaps, capacity, put)
        for size, run in updated:
            gaps[size].append(run)
        if updated:
            continue
        # No gap holds any of them: the largest open new sequences, filled with copies.
        copies = capacity // largest
        for many, each in ((left[largest] // copies, copies), (1, left[largest] % copies)):
            if many and each:
                for i in range(each):
                    put(largest, sequences, many, i * largest)
                gaps[capacity - each * largest].append((sequences, many))
                sequences += many
    table = np.array(sorted(decided), np.int64).reshape(-1, 4)
    return tuple(np.ascontiguousarray(c) for c in table.T)


def _sweep(octave: list[int], left: dict, gaps: list[deque], capacity: int, put) -> list[tuple[int, tuple[int, int]]]:
    """Match documents, largest first, with the smallest gaps of this round that hold
    them. Returns the gaps that remain of those, for the next round."""
    above = list(range(capacity + 2))  # the next size with gaps, compressed on the way

    def successor(size: int) -> int:
        path = []
        while size <= capacity and not gaps[size]:
            path.append(size)
            size = above[size] if above[size] > size else size + 1
        for x in path:
            above[x] = size
        return size

    updated = []
    for length in octave:
        while left[length] and (size := successor(length)) <= capacity:
            first, many = gaps[size].popleft()
            taken = min(many, left[length])
            if taken < many:
                gaps[size].appendleft((first + taken, many - taken))
            put(length, first, taken, capacity - size)
            updated.append((size - length, (first, taken)))
    return updated


def packed_sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` (binary) of every sequence, from the
    result of :func:`pack` on pieces with their ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(inside, F.lit(b""), lambda held, x: F.concat(held, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
