"""Labels: renaming, selection, counts and coverage.

A mapping or taxonomy is a Python collection or a table, of any size: a collection
becomes a local table, whose size Spark knows, so it is broadcast below Spark's threshold
and shuffled above it. Labelled tables may be of any size and any one label may hold most
of their rows: every count is aggregated before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions.names import unused

# The thirteen intents of the training table (fixed values).
INTENTS = (
    "get_rate_quote",
    "track_shipment",
    "get_eta",
    "report_damage",
    "report_lost_shipment",
    "schedule_pickup",
    "cancel_shipment",
    "update_delivery_address",
    "request_invoice",
    "check_freight_class",
    "file_claim",
    "escalate_to_agent",
    "general_inquiry",
)

# From the labels of the public customer-support corpus to intents (fixed values).
SUPPORT_LABELS = {
    "track_order": "track_shipment",
    "delivery_period": "get_eta",
    "cancel_order": "cancel_shipment",
    "complaint": "file_claim",
    "check_invoice": "request_invoice",
    "get_invoice": "request_invoice",
    "change_shipping_address": "update_delivery_address",
    "contact_human_agent": "escalate_to_agent",
}

# Class id of out-of-scope messages, and the intent they stand for (fixed values).
OUT_OF_SCOPE_CLASS = 42
OUT_OF_SCOPE_INTENT = "general_inquiry"

NO_MATCH = "NO MATCH"


def _checked(labels: Iterable[str]) -> list[str]:
    labels = list(dict.fromkeys(labels))
    if not labels:
        raise ValueError("at least one label is needed")
    return labels


def mapping_table(spark: SparkSession, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """A label mapping as a table ``from_label, to_label``. A mapping that is a table has
    these columns, and each ``from_label`` once."""
    if isinstance(mapping, DataFrame):
        return mapping.select("from_label", "to_label")
    labels = _checked(mapping)
    return spark.createDataFrame(
        pa.table({"from_label": labels, "to_label": [mapping[label] for label in labels]})
    )


def taxonomy_table(spark: SparkSession, intents: Iterable[str] | DataFrame = INTENTS) -> DataFrame:
    """A taxonomy as a table ``intent``. A taxonomy that is a table has this column."""
    if isinstance(intents, DataFrame):
        return intents.select("intent").distinct()
    return spark.createDataFrame(pa.table({"intent": _checked(intents)}))


def _mapped(df: DataFrame, mapping: Mapping[str, str] | DataFrame, label_col: str, how: str) -> DataFrame:
    """``df`` with its labels renamed; the names of the mapping's columns are not in it."""
    old, new = unused("from_label", df), unused("to_label", df)
    table = mapping_table(df.sparkSession, mapping).toDF(old, new)
    joined = df.join(table, F.col(f"`{label_col}`") == F.col(old), how)
    return joined.withColumn(label_col, F.col(new)).drop(old, new)


def _among(df: DataFrame, labels: Iterable[str] | DataFrame, label_col: str) -> DataFrame:
    """The rows whose label is in a collection, a filter that reaches the scan. For a
    table all rows: it is joined later."""
    if isinstance(labels, DataFrame):
        return df
    return df.filter(F.col(f"`{label_col}`").isin(list(labels)))


def relabel(
    df: DataFrame, mapping: Mapping[str, str] | DataFrame, source: str, label_col: str = "intent"
) -> DataFrame:
    """Keep the rows whose label is in the mapping, rename the label and note the
    source."""
    kept = _among(df, mapping, label_col)
    return _mapped(kept, mapping, label_col, "inner").withColumn("source", F.lit(source))


def rename_labels(df: DataFrame, mapping: Mapping[str, str] | DataFrame, label_col: str = "intent") -> DataFrame:
    """Rename labels and keep all rows; a label that is not in the mapping becomes
    null."""
    return _mapped(df, mapping, label_col, "left")


def extract_out_of_scope(
    df: DataFrame,
    source: str,
    class_id: int = OUT_OF_SCOPE_CLASS,
    to_label: str = OUT_OF_SCOPE_INTENT,
    label_col: str = "intent",
) -> DataFrame:
    """Keep the rows of one integer class, under a label of their own."""
    return (
        df.filter(F.col(f"`{label_col}`") == class_id)
        .withColumn(label_col, F.lit(to_label))
        .withColumn("source", F.lit(source))
    )


def label_counts(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """Rows per label, sorted by label; missing labels are not counted."""
    label = F.col(f"`{label_col}`")
    return df.filter(label.isNotNull()).groupBy(label).agg(F.count("*").alias("rows")).orderBy(label)


def distinct_labels(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """The labels that occur, sorted; one row each, without null."""
    label = F.col(f"`{label_col}`")
    return df.filter(label.isNotNull()).select(label).distinct().orderBy(label)


def count_distinct_labels(df: DataFrame, label_col: str = "intent") -> DataFrame:
    """One row: total rows and number of different labels, null not counted."""
    return df.agg(
        F.count("*").alias("rows"), F.count_distinct(F.col(f"`{label_col}`")).alias("labels")
    )


def taxonomy_coverage(
    df: DataFrame, intents: Iterable[str] | DataFrame = INTENTS, label_col: str = "intent"
) -> DataFrame:
    """Rows per intent of the taxonomy, 0 for those that have none; other labels are
    left out."""
    if not isinstance(intents, DataFrame):
        intents = _checked(intents)
    counts = (
        _among(df, intents, label_col)
        .groupBy(F.col(f"`{label_col}`").alias("intent"))
        .agg(F.count("*").alias("rows"))
    )
    return (
        taxonomy_table(df.sparkSession, intents)
        .join(counts, "intent", "left")
        .select("intent", F.coalesce("rows", F.lit(0)).alias("rows"))
    )


def missing_intents(
    df: DataFrame, intents: Iterable[str] | DataFrame = INTENTS, label_col: str = "intent"
) -> DataFrame:
    """The intents of the taxonomy that have no row at all."""
    return taxonomy_coverage(df, intents, label_col).filter(F.col("rows") == 0).select("intent")


def histogram_bar(rows: Column, rows_per_block: int) -> Column:
    """One block for every ``rows_per_block`` rows."""
    return F.repeat(F.lit("█"), F.floor(rows / rows_per_block).cast("int"))


def label_histogram(df: DataFrame, rows_per_block: int, label_col: str = "intent") -> DataFrame:
    """Rows per label with a text bar."""
    return label_counts(df, label_col).withColumn("bar", histogram_bar(F.col("rows"), rows_per_block))


def mapping_preview(
    df: DataFrame,
    mapping: Mapping[str, str] | DataFrame,
    intents: Iterable[str] | DataFrame = INTENTS,
    out_of_scope: str = OUT_OF_SCOPE_INTENT,
    label_col: str = "intent",
) -> DataFrame:
    """For each intent the source labels that map to it, joined by ``" + "``, or a
    note, and the rows those labels hold in ``df``."""
    spark = df.sparkSession
    counts = (
        _among(df, mapping, label_col)
        .groupBy(F.col(f"`{label_col}`").alias("from_label"))
        .agg(F.count("*").alias("label_rows"))
    )
    # From here on, no more rows than the mapping has.
    sources = (
        mapping_table(spark, mapping)
        .join(counts, "from_label", "left")
        .groupBy(F.col("to_label").alias("intent"))
        .agg(
            F.array_join(F.array_sort(F.collect_list("from_label")), " + ").alias("labels"),
            F.coalesce(F.sum("label_rows"), F.lit(0)).alias("label_rows"),
        )
    )
    note = F.when(
        F.col("intent") == out_of_scope, F.lit(f"{NO_MATCH} - use out-of-scope rows")
    ).otherwise(F.lit(f"{NO_MATCH} - need synthetic data"))
    return (
        taxonomy_table(spark, intents)
        .join(sources, "intent", "left")
        .select(
            "intent",
            F.coalesce("labels", note).alias("labels"),
            F.coalesce("label_rows", F.lit(0)).alias("rows"),
        )
    )
