"""CSV files whose cells may hold line feeds, each read by many tasks.

Spark's text reader cuts a file into ranges of whole lines. Whether a line begins a row
or goes on with a quoted cell hangs on all lines before it, so it takes three passes:

1. Each range says how it ends if it begins outside of a cell, and how if inside.
2. A prefix pass over the ranges of each file, a row each, tells how every range begins.
   Of ranges that begin inside a cell, the lines up to the end of that row are read: the
   rest of the row that an earlier range began.
3. Each range puts its rows together, the last one with the rest it needs.

Only rows cut by an end of a range travel. The functions are shipped by value: executors
need pyarrow but not this package.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskline.sources.shared import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Ranges, and bytes of the rests of rows, that are broadcast; beyond, joins shuffle.
_BROADCAST_RANGES = 1_000_000
_BROADCAST_BYTES = 32 << 20
# Bytes of rows that are handed on together.
_OUT_BYTES = 4 << 20

# From the start of a cell: whole cells, then one whose quote is open at the end.
_LEFT_OPEN = re.compile(r'(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?,)*+"(?:[^"]++|"")*+\Z')
# From inside a quoted cell: up to the comma behind it, group 1 if its quote closes.
_INSIDE = re.compile(r'(?:[^"]++|"")*+("[^,]*+)?+')


def left_open(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell. A quote opens a cell at its beginning
    only; elsewhere it is a character like any other."""
    at = 0
    if inside:
        cell = _INSIDE.match(line)
        if cell[1] is None:
            return True
        at = cell.end() + 1  # behind the comma
        if at > len(line):
            return False
    return _LEFT_OPEN.match(line, at) is not None


class _Run(NamedTuple):
    """Lines of one batch that lie in the same range, and which of them hold a quote."""

    file: int
    start: int
    inside: bool
    lines: pa.Array
    quoted: np.ndarray


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Run]:
    last = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, line = (batch.column(c).to_numpy() for c in ("file", "start", "line"))
        if line[0] <= last or (np.diff(line) <= 0).any():
            raise RuntimeError("lines of a file came out of order")
        last = line[-1]
        quoted = np.asarray(pc.match_substring(batch.column("value"), '"'))
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            inside = bool(batch.column("inside")[a].as_py()) if "inside" in batch.schema.names else False
            yield _Run(int(file[a]), int(start[a]), inside, batch.column("value").slice(a, b - a), quoted[a:b])


def _endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each range ends: begun outside of a cell, and begun inside."""
    found: dict[tuple[int, int], tuple[bool, bool]] = {}
    for run in _runs(batches):
        outside, inside = found.get((run.file, run.start), (False, True))
        for line in run.lines.filter(pa.array(run.quoted)).to_pylist():
            same = outside == inside
            outside = left_open(line, outside)
            inside = outside if same else left_open(line, inside)
        found[run.file, run.start] = outside, inside
    if found:
        keys, ends = list(found), list(found.values())
        columns = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
        columns += [pa.array([e[i] for e in ends], pa.bool_()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "if_outside", "if_inside"])


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range, which begins inside a cell, the lines up to the end of that row, and
    whether it ends there."""
    found: dict[tuple[int, int], list] = {}
    for run in _runs(batches):
        state = found.setdefault((run.file, run.start), [[], False])
        if state[1]:
            continue
        for line, quoted in zip(run.lines.to_pylist(), run.quoted.tolist()):
            state[0].append(line)
            if quoted and not left_open(line, True):
                state[1] = True
                break
    if found:
        columns = [pa.array([k[i] for k in found], pa.int64()) for i in (0, 1)]
        columns += [pa.array(["\n".join(lines) for lines, _ in found.values()], pa.string())]
        columns += [pa.array([closed for _, closed in found.values()], pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "head", "closes"])


def _rows(batches: Iterator[pa.RecordBatch], header: bool) -> Iterator[pa.RecordBatch]:
    """The rows that begin in each range. ``unfinished``: the last one goes on after it."""
    out: list[tuple[int, int, str, bool]] = []
    size, place, part, inside, skip = 0, None, [], False, False

    def batch() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "record", "unfinished"])

    def finish() -> None:
        if place is not None and part and not skip:
            out.append((*place, "\n".join(part), True))

    passing = False  # the row that an earlier range began
    for run in _runs(batches):
        if (run.file, run.start) != place:
            finish()
            place, part, inside, passing = (run.file, run.start), [], run.inside, run.inside
            skip = header and run.start == 0
        for line, quoted in zip(run.lines.to_pylist(), run.quoted.tolist()):
            if quoted:
                inside = left_open(line, inside)
            if passing:
                passing = inside
                continue
            if inside:
                part.append(line)
                continue
            record = line if not part else "\n".join([*part, line])
            part = []
            if record.endswith("\r"):
                record = record[:-1]
            if skip or not record:
                skip = skip and not record
                continue
            out.append((*place, record, False))
            size += len(record)
            if size >= _OUT_BYTES:
                yield batch()
                out, size = [], 0
    finish()
    if out:
        yield batch()


def read_csv_ranges(spark: SparkSession, path: str | list[str], schema: str, options: dict) -> DataFrame:
    """Rows of CSV files (RFC 4180, UTF-8, lines that end in LF or CRLF), in no order.

    Files are cut as Spark cuts text files, by ``spark.sql.files.maxPartitionBytes``,
    which must be the same when the result is computed as when this is called: the first
    two passes run at once. A cell may span any number of ranges. Empty lines are no
    rows. A quote that is never closed makes the rest of its file one row.
    """
    header = str(options.get("header", False)).lower() == "true"
    lines = spark.read.text(path, lineSep="\n").select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )

    def written(df: DataFrame, name: str) -> DataFrame:
        folder = shared_folder(spark, name)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    endings = lines.mapInArrow(_endings, "file long, start long, if_outside boolean, if_inside boolean")
    ranges = written(_beginnings(endings), "csv-ranges")
    begun_inside = ranges.filter("inside").select("file", "start")
    few = begun_inside.count() <= _BROADCAST_RANGES

    def marked(how: str) -> DataFrame:
        """Lines with whether their range begins inside a cell, still in order."""
        inside = begun_inside.withColumn("inside", F.lit(True))
        if few:
            return lines.join(F.broadcast(inside), ["file", "start"], how)
        found = lines.join(inside, ["file", "start"], how)
        return found.repartition("file", "start").sortWithinPartitions("line")

    heads = marked("inner").mapInArrow(_heads, "file long, start long, head string, closes boolean")
    rests = written(_rests(ranges, heads), "csv-rests")
    rows = marked("left").mapInArrow(
        lambda batches: _rows(batches, header), "file long, start long, record string, unfinished boolean"
    )
    size = rests.agg(F.sum(F.octet_length("rest") + 32)).first()[0] or 0
    rests = rests.withColumn("unfinished", F.lit(True))
    if size <= _BROADCAST_BYTES:
        rests = F.broadcast(rests)
    else:
        # Finished rows meet nothing: spread them over the tasks of the join.
        rows = rows.withColumn("start", F.when(F.col("unfinished"), F.col("start")).otherwise(F.xxhash64("record")))
    whole = rows.join(rests, ["file", "start", "unfinished"], "left").select(
        F.when(F.col("rest").isNotNull(), F.concat_ws("\n", "record", "rest")).otherwise(F.col("record")).alias("record")
    )
    return whole.select(F.from_csv("record", F.lit(schema), {**{k: str(v) for k, v in options.items() if k != "header"}, "multiLine": "true"}).alias("row")).select("row.*")


def _beginnings(endings: DataFrame) -> DataFrame:
    """``inside``: whether a range begins inside a cell. A range either ends the same way
    however it begins, or passes on how it begins, or turns it over; so what counts is
    the last range of the first kind, and how many of the third came after it."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    fixed = F.col("if_outside") == F.col("if_inside")
    turns = F.sum(F.when(~fixed & F.col("if_outside"), 1).otherwise(0)).over(upto)
    counted = endings.select("*", fixed.alias("fixed"), turns.alias("turns"))
    # How things stood after the last range of the first kind, less the turns up to it.
    stood = F.when(F.col("fixed"), F.pmod(F.col("if_outside").cast("long") - F.col("turns"), F.lit(2)))
    last = F.coalesce(F.last(stood, ignorenulls=True).over(before), F.lit(0))
    passed = F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("start")), F.lit(0))
    return counted.select("file", "start", (F.pmod(last + passed, F.lit(2)) == 1).alias("inside"))


def _rests(ranges: DataFrame, heads: DataFrame) -> DataFrame:
    """``rest`` of the last row that a range begins, where it is cut: the heads of the
    ranges after it, up to the first in which the row ends."""
    known = ranges.join(heads, ["file", "start"], "left")
    order = Window.partitionBy("file").orderBy("start")
    # A range that lies in one cell as a whole begins no row.
    begins = F.when(~F.col("inside") | F.coalesce("closes", F.lit(False)), F.col("start"))
    owner = F.last(begins, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    owned = known.select("file", "start", "head", owner.alias("owner")).filter(F.col("head").isNotNull())
    parts = F.array_sort(F.collect_list(F.struct("start", "head")))
    text = F.array_join(F.transform(parts, lambda part: part["head"]), "\n")
    # The line end of the row, which is none of a cell's.
    return owned.groupBy("file", F.col("owner").alias("start")).agg(F.regexp_replace(text, "\r\\z", "").alias("rest"))
