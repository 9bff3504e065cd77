"""The training table: relabelled and synthetic rows, merged, cleaned and checked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.functions import patterns as p
from deskline.functions.names import unused
from deskline.functions.text import strip
from deskline.operators.labels import (
    INTENTS,
    OUT_OF_SCOPE_CLASS,
    OUT_OF_SCOPE_INTENT,
    SUPPORT_LABELS,
    extract_out_of_scope,
    histogram_bar,
    relabel,
    taxonomy_coverage,
)
from deskline.operators.profile import funnel
from deskline.operators.rows import keep_first, seeded_shuffle, stack

COLUMNS = ("text", "intent", "source")
SEED = 42


def build_relabelled_table(
    support: DataFrame,
    scoped: DataFrame,
    mapping: Mapping[str, str] | DataFrame = SUPPORT_LABELS,
    sources: tuple[str, str] = ("support", "scope"),
    class_id: int = OUT_OF_SCOPE_CLASS,
    to_label: str = OUT_OF_SCOPE_INTENT,
    seed: int = SEED,
    key: Sequence[str] = (),
) -> DataFrame:
    """Relabelled support rows and out-of-scope rows, shuffled.

    ``support`` has ``text`` and a string ``intent``; ``scoped`` has ``text`` and an
    integer ``intent``. Copies of a row are kept. ``key``, columns of both tables that
    tell the rows of a table apart, saves counting the copies.
    """
    combined = stack(
        relabel(support, mapping, sources[0]),
        extract_out_of_scope(scoped, sources[1], class_id, to_label),
    )
    if key:
        rows = combined.select(*COLUMNS, *key)
        return seeded_shuffle(rows, seed, key=["source", *key]).select(*COLUMNS)
    return seeded_shuffle(combined.select(*COLUMNS), seed)


def relabel_funnel(
    support: DataFrame, scoped: DataFrame, mapping: Mapping[str, str] | DataFrame = SUPPORT_LABELS, class_id: int = OUT_OF_SCOPE_CLASS
) -> DataFrame:
    """Rows before and after each step of the relabelling, from one pass over each
    table."""
    if isinstance(mapping, DataFrame):
        # Counts of labels are few rows to join.
        counts = support.groupBy("intent").agg(F.count("*").alias("n")).join(
            mapping.select(F.col("from_label").alias("intent"), F.lit(True).alias("known")), "intent", "left"
        )
        total = lambda column: F.coalesce(F.sum(column), F.lit(0))
        of_support = counts.agg(total("n").alias("support"), total(F.when(F.col("known"), F.col("n"))).alias("support_kept"))
    else:
        kept = F.count_if(F.col("intent").isin(list(mapping)))
        of_support = support.agg(F.count("*").alias("support"), kept.alias("support_kept"))
    out_of_scope = F.count_if(F.col("intent") == class_id)
    of_scoped = scoped.agg(F.count("*").alias("scoped"), out_of_scope.alias("scoped_kept"))
    sides = stack(of_support, of_scoped).agg(
        *[F.sum(c).alias(c) for c in ("support", "support_kept", "scoped", "scoped_kept")]
    )
    counts = sides.withColumn("combined", F.col("support_kept") + F.col("scoped_kept"))
    return funnel(counts, ["support", "support_kept", "scoped", "scoped_kept", "combined"])


def _stacked(relabelled: DataFrame, synthetic: DataFrame) -> tuple[DataFrame, str]:
    """Both tables, and the name of the column that is 0 for the first and 1 for the
    other."""
    side = unused("side", relabelled, synthetic)
    return stack(relabelled.withColumn(side, F.lit(0)), synthetic.withColumn(side, F.lit(1))), side


def _usable() -> Column:
    """Neither text nor intent is missing, and stripping leaves some text."""
    return F.col("text").isNotNull() & F.col("intent").isNotNull() & F.col("text").rlike(p.HAS_TEXT)


def build_training_table(
    relabelled: DataFrame, synthetic: DataFrame, order: Sequence[str] = (), seed: int = SEED
) -> DataFrame:
    """Both tables stacked, stripped, without rows that miss text or intent, one row
    for each text, shuffled.

    Of several rows with the same text the first is kept: relabelled rows come before
    synthetic ones, and within a table ``order``, columns both have, decides. Without
    it the smallest intent and source win, since a table has no order of its own.
    """
    stacked, side = _stacked(relabelled, synthetic)
    usable = stacked.filter(_usable()).withColumn("text", strip(F.col("text")))
    ranked = usable.select(*COLUMNS, side, *[F.col(f"`{c}`") for c in order if c not in COLUMNS])
    unique = keep_first(ranked, ["text"], [side, *order, *[c for c in ("intent", "source") if c not in order]])
    return seeded_shuffle(unique.select(*COLUMNS), seed, key=["text"])


def training_funnel(relabelled: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Rows before and after each step of the merge.

    Texts are counted per side first, so copies collapse before the shuffle, and told
    apart by hash and length, so no text is shuffled.
    """
    stacked, side = _stacked(relabelled, synthetic)
    usable = F.when(_usable(), strip(F.col("text")))
    texts = (
        stacked.select(F.sha2(usable, 256).alias("text"), F.length(usable).alias("size"), side)
        .groupBy("text", "size")
        .agg(
            F.count_if(F.col(side) == 0).alias("relabelled"),
            F.count_if(F.col(side) == 1).alias("synthetic"),
        )
    )
    both = F.col("relabelled") + F.col("synthetic")
    is_text = F.col("text").isNotNull()
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    counts = texts.agg(
        total("relabelled").alias("relabelled"),
        total("synthetic").alias("synthetic"),
        total(both).alias("combined"),
        total(F.when(is_text, both)).alias("usable"),
        total(F.when(is_text, both - 1)).alias("duplicates"),
        F.count("text").alias("final"),
    )
    return funnel(counts, ["relabelled", "synthetic", "combined", "usable", "duplicates", "final"])


def training_report(
    training: DataFrame, intents: Iterable[str] | DataFrame = INTENTS, rows_per_block: int = 50
) -> DataFrame:
    """Rows of each intent of the taxonomy with a text bar, and whether it is missing."""
    rows = F.col("rows")
    return taxonomy_coverage(training, intents).select(
        "intent", "rows", histogram_bar(rows, rows_per_block).alias("bar"), (rows == 0).alias("missing")
    )
