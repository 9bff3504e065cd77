"""Exact deduplication by content hash, with the bytes compared inside each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import fresh


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``,
    ``content_hash`` (128 bits, hex) and ``text_sha256`` (hex).

    Rows are grouped by the MD5 of their text. The grouping key holds the text as well,
    so equal bytes are compared exactly and a hash collision splits into its real
    groups; each task folds its copies before the shuffle, so a group of copies of any
    size is a few rows. Only hashes and ids are shuffled after that, and a group that
    holds most rows is split by the adaptive skew join.

    ``keep`` names the id that stays: "smallest" or "largest". A null text counts as
    empty, an empty text is a text like any other. Null ids stay only in groups without
    another id. Rows equal in id and text are the same document: each of them is marked
    ``kept`` (:func:`drop_copies` returns one). Other columns are not read, whatever
    their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    chosen = {"smallest": F.min, "largest": F.max}[keep]
    by_text = rows.groupBy(_content_hash("text").alias("content_hash"), "text").agg(
        chosen("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = by_text.select(
        "content_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    hashed = rows.select("id", _content_hash("text").alias("content_hash"), F.sha2("text", 256).alias("text_sha256"))
    # Texts that share the MD5 but not their bytes are told apart by their SHA-256.
    return hashed.join(groups, ["content_hash", "text_sha256"]).select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("content_hash")).alias("content_hash"),
        "text_sha256",
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, one for each text, with all
    their columns. Of rows equal in id and text any one stays.

    One grouping by hash and text: each task keeps one row of the copies it has met, and
    a text is shuffled once, with the row that stays."""
    text, name = F.coalesce(F.col(text_col), F.lit("")), fresh(docs, "row")
    others = [c for c in docs.columns if c != text_col]
    held = F.struct(F.col(text_col).isNull().alias("f"), *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(others)])
    chosen = {"smallest": F.min_by, "largest": F.max_by}[keep]
    # Rows without an id count only where no other has one.
    row = F.coalesce(chosen(held, F.col(id_col)), F.first(held))
    rows = docs.groupBy(F.unhex(F.md5(text)).alias(fresh(docs, "hash")), text.alias(fresh(docs, "whole_text"))).agg(row.alias(name))
    places = {c: F.col(name)[f"f{i}"] for i, c in enumerate(others)}
    places[text_col] = F.when(~F.col(name)["f"], F.col(fresh(docs, "whole_text")))
    return rows.select(*[places[c].alias(c) for c in docs.columns])


def _content_hash(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))
