"""A training corpus from the ``documents`` table, stage by stage.

Every stage but the last returns the columns of ``documents``, for the rows that it
keeps; the last one packs them into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskline.llm.common import table_of
from deskline.llm.decontamination import drop_contaminated
from deskline.llm.exact_dedup import drop_copies
from deskline.llm.ngram_jaccard import drop_near_copies
from deskline.llm.packing import pack
from deskline.llm.queries import pieces, table, toxicity_model
from deskline.llm.toxicity import drop_toxic


def ordinary_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model is learnt from the labelled ones."""
    return drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, that with the smallest id stays."""
    return drop_copies(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id: five
    words, a similarity of 0.8."""
    return drop_near_copies(docs)


def unseen_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return pack(pieces(docs)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", ordinary_texts),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard", distinct_content),
    ("decontamination", unseen_benchmark),
    ("best_fit_packing", sequences),
]

# Toxicity, near copies, passages and packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each result but the last is
    written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table_of(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
