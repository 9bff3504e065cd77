"""From raw texts of several channels to records: cleaned, with entities, intent, route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.operators.channels import clean_interactions
from deskline.operators.email import EmailConfig
from deskline.operators.records import FALLBACK_THRESHOLD, extract_entities, to_records, with_route
from deskline.plans.intent_baseline import NaiveBayes, with_intents


def process_interactions(
    df: DataFrame,
    model: NaiveBayes,
    key: str,
    channel_col: str = "channel",
    in_col: str = "raw_text",
    email_config: EmailConfig | None = None,
    threshold: float = FALLBACK_THRESHOLD,
) -> DataFrame:
    """One JSON ``record`` for each row of ``df``: its ``id`` (the ``key`` column, which may
    be null or repeated), ``channel``, ``clean_text``, ``intent``, ``confidence`` (six
    places), ``route`` and ``entities``, null where a row has none.

    One pass: each text is cleaned, searched and judged where it is, and nothing is
    shuffled, unless the model has rare words (see :func:`with_intents`).
    """
    raw = df.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{channel_col}`").alias("channel"), F.col(f"`{in_col}`").alias("raw_text")
    )
    cleaned = extract_entities(clean_interactions(raw, email_config=email_config).drop("raw_text"))
    judged = with_intents(model, cleaned, "clean_text", ("intent", "log_score", "confidence"))
    routed = with_route(judged, threshold).withColumn("confidence", F.round("confidence", 6))
    return to_records(routed.select("id", "channel", "clean_text", "intent", "confidence", "route", "entities"))
