"""Fill-in-the-middle transformation of documents, cut at random units.

A text is cut into blocks of a fixed number of bytes, and a Fenwick tree over the blocks
holds how many units begin in each, and how many code points. A cut after k units is
found by binary-lifting descent of the tree, which gives the block and the counts before
it, and then by a look at that block alone. So a text is looked over once, whatever the
number of cuts, and no list of its units is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.llm.hashing import text_bytes

BLOCK_BYTES = 1024
# Bytes of results that are handed on together.
_OUT_BYTES = 1 << 23

_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _characters(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray) -> np.ndarray:
    white = _WHITE[data]
    first = ~white
    first[1:] &= white[:-1]
    if len(data):
        first[np.argmax(first)] = False  # white space at the front goes with the first word
        first[0] = True
    return first


def _lines(data: np.ndarray) -> np.ndarray:
    first = np.ones(len(data), bool)
    first[1:] = data[:-1] == 10
    return first


#: Where units begin: code points; words with the ASCII white space behind them (and that
#: in front of the first); lines with their line feed.
UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"characters": _characters, "words": _words, "lines": _lines}


class BlockTree:
    """Fenwick tree over the blocks of one text, with the units and the code points that
    begin in each."""

    def __init__(self, data: np.ndarray, unit: str = "characters", block: int = BLOCK_BYTES):
        self.block, self.length = block, len(data)
        self.starts = UNITS[unit](data)
        self.points = self.starts if unit == "characters" else _characters(data)
        blocks = -(-len(data) // block)
        self.size = 1 << max(blocks - 1, 0).bit_length()
        self.tree = np.zeros((self.size + 1, 2), np.int64)
        if blocks:
            edges = np.arange(0, len(data), block)
            for column, marks in enumerate((self.starts, self.points)):
                self.tree[1 : blocks + 1, column] = np.add.reduceat(marks, edges, dtype=np.int64)
        step = 1
        while step < self.size:
            self.tree[2 * step :: 2 * step] += self.tree[step :: 2 * step]
            step *= 2
        self.units, self.characters = self.tree[self.size].tolist()

    def cut(self, units: int) -> tuple[int, int]:
        """The byte and the number of code points where ``units`` units (0 up to all) end."""
        if units >= self.units:
            return self.length, self.characters
        at, before, passed, step = 0, 0, 0, self.size
        while step:
            if at + step <= self.size:
                here, points = self.tree[at + step].tolist()
                if before + here <= units:
                    at, before, passed = at + step, before + here, passed + points
            step //= 2
        start = at * self.block
        inside = int(np.flatnonzero(self.starts[start : start + self.block])[units - before])
        return start + inside, passed + int(np.count_nonzero(self.points[start : start + inside]))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "characters",
    seed: int = 1,
    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
    percent: int = 90,
    suffix_first_percent: int = 20,
) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``n`` (units of the text), ``form``,
    ``prefix_chars`` and ``middle_chars`` (code points, null if plain) and ``output``.

    ``unit`` is one of :data:`UNITS`. The first four groups of eight hex digits of the
    SHA-256 of "``seed``:id" are h1 to h4. The prefix ends after the smaller of
    h1 % (n + 1) and h2 % (n + 1) units and the middle after the larger. The form is
    "plain" if the text is empty or holds a marker, or if h3 % 100 is ``percent`` or more;
    else "spm" if h4 % 100 is below ``suffix_first_percent``, else "psm". Output: plain,
    the text; psm, markers for prefix, suffix and middle, each before its part; spm, the
    suffix first. :func:`restored_text` gives the text back.

    Null texts count as empty. A null id counts as an empty one. Rows that are there
    twice are both transformed, alike. Other columns are not read, whatever their names.
    An empty table gives no rows. Markers must be three different texts that begin with a
    character that is nowhere else in them, so none appears across a seam.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    firsts = {m[:1] for m in markers}
    if len(set(markers)) != 3 or any(not m or first in m[1:] for m in markers for first in firsts):
        raise ValueError("markers must differ, and none may hold the first character of one behind its own first")
    if any(a != b and a.startswith(b) for a in markers for b in markers):
        raise ValueError("no marker may begin with another")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.array(*draws).alias("draws")
    )
    signs = [m.encode() for m in markers]
    for_prefix, for_suffix, for_middle = signs

    def transform(text: bytes, data: np.ndarray, draws: np.ndarray) -> tuple[int, str, int | None, int | None, bytes]:
        tree = BlockTree(data, unit)
        if not text or any(sign in text for sign in signs) or draws[2] % 100 >= percent:
            return tree.units, "plain", None, None, text
        first, last = sorted(int(h) % (tree.units + 1) for h in draws[:2])
        (a, before), (b, after) = tree.cut(first), tree.cut(last)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if draws[3] % 100 < suffix_first_percent:
            form, parts = "spm", (for_suffix, suffix, for_prefix, prefix, for_middle, middle)
        else:
            form, parts = "psm", (for_prefix, prefix, for_suffix, suffix, for_middle, middle)
        return tree.units, form, before, after - before, b"".join(parts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            draws = batch.column("draws").flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
            begin, held, out = 0, 0, []
            for i, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = data[start:end]
                out.append(transform(own.tobytes(), own, draws[i]))
                held += len(out[-1][-1])
                if held >= _OUT_BYTES or i + 1 == batch.num_rows:
                    yield _rows(batch.column("id").slice(begin, len(out)), out)
                    begin, held, out = i + 1, 0, []

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(each, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def _rows(ids: pa.Array, out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
    columns[-1] = columns[-1].cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, *columns], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])


def restored_text(output: str | Column, form: str | Column, markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` of, exactly."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join("\\Q" + m.replace("\\E", "\\E\\\\E\\Q") + "\\E" for m in markers), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
