"""One query for each operator, over whole tables. Thin: the rows come from the
operators, and only digest columns are derived here."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.llm.common import fold
from deskline.llm.decontamination import find_benchmark_passages
from deskline.llm.exact_dedup import exact_dedup
from deskline.llm.fill_in_middle import fill_in_middle, restored_text
from deskline.llm.license_scan import license_scan, notice_templates
from deskline.llm.ngram_jaccard import ngram_jaccard_join
from deskline.llm.ngram_lm import score_texts, train_ngram_model
from deskline.llm.packing import pack, tokenized_pieces
from deskline.llm.personal_data import KINDS, find_personal_data
from deskline.llm.secret_scan import secret_scan, seed_findings, train_secret_forest
from deskline.llm.token_counts import apply_edits, build_token_trees
from deskline.llm.url_filter import UrlRule, filter_urls, seed_urls, train_url_filter
from deskline.llm.toxicity import toxicity, train_toxicity
from deskline.llm.whitening import fit_whitening, whiten

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark, d):
    found = find_benchmark_passages(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


URL_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


@query
def op2_url_filter(spark, d):
    trained = train_url_filter(seed_urls(spark))
    return filter_urls(table(spark, d, "pages").select("page_id", "url"), trained, URL_RULES).drop("url")


def toxicity_model(documents, labels):
    """Words are learnt from folds 0 and 1, the curve from fold 3; fold 2 is held out."""
    learn_from, tune_on = fold("doc_id", 4).isin(0, 1), fold("doc_id", 4) == 3
    return train_toxicity(documents, labels, learn_from, tune_on)


@query
def op3_toxicity(spark, d):
    documents = table(spark, d, "documents")
    scored = toxicity(documents, toxicity_model(documents, table(spark, d, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (fold("id", 4) == 2).alias("held_out"), "score", "predicted", "mean", "peak")


@query
def op4_license_scan(spark, d):
    found = license_scan(table(spark, d, "documents"), notice_templates(spark))
    return found.withColumnRenamed("id", "doc_id")


BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Edits of a document: its language in front, its source instead of some characters in
# the middle, and the last ones gone.
EDITS = """
array(
    struct(0L AS start, 0L AS stop, concat(lang, ' ') AS insert),
    struct(least(greatest(n - 5, 0), n div 2) AS start, least(greatest(n - 5, 0), n div 2 + 7) AS stop, source AS insert),
    struct(greatest(n - 5, 0) AS start, n AS stop, '' AS insert)
)
"""


def edited_documents(spark, d):
    """The documents with the edits that ``op5_token_counts`` applies."""
    sized = table(spark, d, "documents").withColumn("n", F.length(F.coalesce("text", F.lit(""))).cast("long"))
    return sized.withColumn("edits", F.expr(EDITS))


@query
def op5_token_counts(spark, d):
    edited = edited_documents(spark, d).select(F.struct("doc_id", "edits").alias("id"), "text")
    trees = build_token_trees(edited, BYTE_RANKS, public_tokenizers.PATTERN, "id")
    counted = apply_edits(trees.withColumn("edits", F.col("id.edits")).withColumn("id", F.col("id.doc_id")), BYTE_RANKS, public_tokenizers.PATTERN)
    return counted.select(
        F.col("id").alias("doc_id"),
        "tokens_before",
        "tokens_after",
        "pretokens_encoded",
        "leaves_touched",
        "leaves",
        F.sha2("text", 256).alias("text_sha256"),
    )


@query
def op6_lm_scoring(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    model = train_ngram_model(documents.where(fold("doc_id", 10) != 0), order=2)
    return score_texts(documents, model).select(
        F.col("id").alias("doc_id"),
        (fold("id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@query
def op7_secret_scan(spark, d):
    forest = train_secret_forest(seed_findings(spark))
    return secret_scan(table(spark, d, "documents"), forest).withColumnRenamed("id", "doc_id")


@query
def op8_exact_dedup(spark, d):
    found = exact_dedup(table(spark, d, "documents"), keep="largest")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256", "content_hash")


def pieces(documents):
    """Pieces of documents, each with the checksum of its ids."""
    found = tokenized_pieces(documents, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))


@query
def op9_best_fit_packing(spark, d):
    return pack(pieces(table(spark, d, "documents"))).withColumnRenamed("id", "doc_id")


@query
def op10_ngram_jaccard(spark, d):
    found = ngram_jaccard_join(table(spark, d, "documents"), words=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op11_personal_data(spark, d):
    found = find_personal_data(table(spark, d, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])

    def listed(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))

    def count(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(plain, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(plain), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        *[count(F.col("spans"), kind).alias(f"all_{kind}") for kind in KINDS],
        F.sha2("masked", 256).alias("masked_sha256"),
    )


@query
def op12_fill_in_middle(spark, d):
    made = fill_in_middle(table(spark, d, "documents"))
    return made.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text("output", "form"), 256).alias("restored_sha256"),
    )


@query
def op13_embedding_whitening(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, fit_whitening(vectors)).withColumnRenamed("id", "vec_id")
