"""Profiles of labelled text tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskline.functions.names import unused
from deskline.functions.text import count_words

# Keys of samples that are broadcast; more are joined by shuffle.
_BROADCAST_KEYS = 100_000


def with_word_count(df: DataFrame, text_col: str = "text", out_col: str = "words") -> DataFrame:
    """Add the number of words of each text; null for null."""
    return df.withColumn(out_col, count_words(F.col(f"`{text_col}`")))


def word_stats(df: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Mean, smallest and largest number of words per message, for the table or for
    each group; null texts are skipped."""
    words = unused("words", df)
    return with_word_count(df, text_col, words).groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.avg(words).alias("avg_words"),
        F.min(words).alias("min_words"),
        F.max(words).alias("max_words"),
    )


def samples_per_label(
    df: DataFrame,
    order: Sequence[str],
    labels: Sequence[str] | None = None,
    size: int = 3,
    label_col: str = "intent",
    out_col: str = "position",
) -> DataFrame:
    """The first ``size`` rows of each label by the ``order`` columns, with their
    place as ``out_col``, which must be a new name; labels without rows are left out.
    Rows equal in label and order follow each other by their other columns.

    The label and order columns alone tell which rows are wanted; every task cuts its
    rows down to the first of each label before they are shuffled. These few keys are
    then broadcast, if there are no more than 100,000, and matched on label and order,
    so a label that holds most rows is not gathered and no text moves before the cut.
    """
    if out_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out_col} is already there")
    label = F.col(f"`{label_col}`")
    rows = df.filter(label.isNotNull()) if labels is None else df.filter(label.isin(list(labels)))
    ordering = [F.col(f"`{c}`") for c in order]
    place = unused("place", df, besides=[out_col])
    names = [unused(f"key{i}", df) for i in range(len(order) + 1)]

    def first(of: DataFrame, by: Column, *columns: Column) -> DataFrame:
        return of.withColumn(place, F.row_number().over(Window.partitionBy(by).orderBy(*columns))).filter(F.col(place) <= size)

    keys = first(rows.select(label, *ordering).toDF(*names), F.col(names[0]), *[F.col(n) for n in names[1:]])
    keys = keys.select(*names).distinct()
    count = len(labels) if labels is not None else rows.agg(F.count_distinct(label)).first()[0]
    if count * size <= _BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = [c.eqNullSafe(F.col(n)) for c, n in zip([label, *ordering], names)]
    near = rows.join(keys, reduce(and_, same), "left_semi")
    rest = [F.col(f"`{c}`") for c in df.columns if c != label_col and c not in order and _sortable(df.schema[c].dataType)]
    return first(near, label, *ordering, *rest).withColumnRenamed(place, out_col)


def _sortable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def funnel(counts: DataFrame, steps: Sequence[str]) -> DataFrame:
    """A one-row table of counts as rows ``step, rows``, numbered in step order."""
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(s).alias("step"), F.col(s).cast("long").alias("rows"))
            for i, s in enumerate(steps)
        ]
    )
    return counts.select(F.inline(pairs))
