"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.sources.shared import shared_folder


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns of these names: one that has such a name keeps its values
    under a fresh one (the name with ``_`` behind it), in the same place."""
    wanted = {n.lower() for n in names}
    taken = wanted | {c.lower() for c in df.columns}
    renamed = []
    for c in df.columns:
        name = c
        while name.lower() in wanted or (name != c and name.lower() in taken):
            name += "_"
        taken.add(name.lower())
        renamed.append(name)
    return df.toDF(*renamed)


def fold(doc_id: str | Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string")) % folds


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and what
    follows does not depend on the executors that made it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint()


def table_of(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like :func:`saved`, for tables
    that are read several times with few of their columns."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
