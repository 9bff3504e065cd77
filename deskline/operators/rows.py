"""Rows: stacking, keep-first deduplication and seeded shuffling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskline.functions.names import unused

# Copies of a row that one task writes out in a row.
_COPIES_PER_TASK = 100_000


def stack(*frames: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row for each key: the first by ``order``, and among equals the one with the
    smallest other columns.

    The first row of a key is an aggregate, so all but one of its copies are gone
    before the shuffle, however many there are. The smallest struct is no hash
    aggregate: rows are sorted by key once before and once after the shuffle.
    """
    # One struct, ordered from its first field on, with each column in it once.
    ranked = [c for c in order if isinstance(c, str) and c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    fields = [F.col(f"`{c}`") if isinstance(c, str) else c for c in [*order, *rest]]
    place = {c: f"f{i}" for i, c in enumerate([*order, *rest]) if isinstance(c, str)}
    first = F.min(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)]))
    by = [F.col(f"`{c}`") for c in keys]
    hashed, found = unused("hash", df), unused("first", df)
    # Sorting by a hash first spares most comparisons of long texts.
    grouped = df.groupBy(F.xxhash64(*by).alias(hashed), *by).agg(first.alias(found))
    return grouped.select(
        *[F.col(f"`{c}`") if c in keys else F.col(found).getField(place[c]).alias(c) for c in df.columns]
    )


def seeded_shuffle(df: DataFrame, seed: int = 42, key: Sequence[str] | None = None) -> DataFrame:
    """All rows in an order that depends on the seed and the rows only, not on how
    they are partitioned: that of the MD5 of the seed and a row.

    Hashes are spread evenly, so partition ``i`` takes those that begin in the ``i``-th
    of equal parts of their range and sorts them: one shuffle, without the job that
    samples the rows for a range-partitioned sort, and the same order for any number
    of partitions.

    With ``key``, columns that tell the rows apart, those are hashed. Without, all
    columns are; copies of a row are counted, numbered and written out again, so that
    they are spread like any other rows.
    """
    if key:
        return _in_order(df, seed, key)
    columns = [F.col(f"`{c}`") for c in df.columns]
    copies, chunk, copy = (unused(name, df) for name in ("copies", "chunk", "copy"))
    per_task = F.lit(_COPIES_PER_TASK)
    last_chunk = F.expr(f"({copies} - 1) div {_COPIES_PER_TASK}")
    chunks = (
        df.groupBy(*columns)
        .agg(F.count("*").alias(copies))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)).alias(chunk))
    )
    # Only chunks of often repeated rows have to be moved apart; a fixed number of
    # partitions, since a chunk is small until it is written out.
    partitions = _partitions(df)
    often = chunks.filter(F.col(copies) > per_task).repartition(partitions, *columns, chunk)
    chunks = chunks.filter(F.col(copies) <= per_task).union(often)
    first = F.col(chunk) * per_task + 1
    last = F.least(F.col(copies), first + per_task - 1)
    rows = chunks.select(*columns, F.explode(F.sequence(first, last)).alias(copy))
    return _in_order(rows, seed, [*df.columns, copy]).drop(copy)


def shuffled_positions(df: DataFrame, key: Sequence[str], seed: int = 42, out_col: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in the order of :func:`seeded_shuffle` by
    ``key``. Parts of the range of hashes are counted, and places are given in each."""
    part, before, draw = (unused(name, df, besides=[out_col]) for name in ("part", "before", "draw"))
    drawn = df.withColumn(draw, _draw(seed, key))
    drawn = drawn.withColumn(part, _part(F.col(draw), _partitions(df)))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # A row for each part, as many as partitions: one task adds them up.
    starts = drawn.groupBy(part).agg(F.count("*").alias(before))
    starts = starts.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(part).orderBy(draw, *[F.col(f"`{c}`") for c in key])
    place = F.row_number().over(inside) - 1 + F.col(before)
    kept = [F.col(f"`{c}`") for c in df.columns if c != out_col]
    return drawn.join(F.broadcast(starts), part).select(*kept, place.alias(out_col))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _draw(seed: int, columns: Sequence[str]) -> Column:
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *texts))


def _part(draw: Column, partitions: int) -> Column:
    """Which of equal parts of the range of hashes this one lies in."""
    begin = F.conv(F.substring(draw, 1, 8), 16, 10).cast("long")
    return F.shiftright(begin * partitions, 32).cast("int")


def _in_order(df: DataFrame, seed: int, columns: Sequence[str]) -> DataFrame:
    draw, partitions = unused("draw", df), _partitions(df)
    spread = df.withColumn(draw, _draw(seed, columns)).repartitionById(partitions, _part(F.col(draw), partitions))
    return spread.sortWithinPartitions(draw, *[F.col(f"`{c}`") for c in columns]).drop(draw)
