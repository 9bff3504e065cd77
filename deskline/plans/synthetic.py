"""Table work around the generation of synthetic rows: prompts out, replies in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.functions.text import strip

ROWS_PER_INTENT = 200
# Replies are split into lines; a message is longer than this (fixed value).
SHORTEST_MESSAGE = 10

# The five things a prompt says, one to a line; a caller may pass wording of their own.
PROMPT = """rows: %s
intent: %s
meaning: %s
entities: %s
examples:
%s"""


def prompts(spec: DataFrame, rows_per_intent: int = ROWS_PER_INTENT, template: str = PROMPT) -> DataFrame:
    """One prompt for each row of ``intent, description, entities, examples array<string>``.

    The template has five ``%s``, for the number of rows, the intent, its description,
    its entities and its examples, each of these on a line that begins with a dash.
    """
    bullets = F.array_join(F.transform("examples", lambda e: F.concat(F.lit("- "), e)), "\n")
    fields = (F.lit(str(rows_per_intent)), "intent", "description", "entities", bullets)
    return spec.select("intent", F.format_string(template, *fields).alias("prompt"))


def messages(replies: DataFrame, source: str = "synthetic") -> DataFrame:
    """One row ``text, intent, source`` for each line of ``intent, raw_text`` that is
    long enough, stripped; other columns are carried along."""
    carried = [F.col(f"`{c}`") for c in replies.columns if c not in ("raw_text", "intent")]
    lines = replies.select(*carried, "intent", F.explode(F.split("raw_text", "\n")).alias("text"))
    stripped = lines.withColumn("text", strip(F.col("text")))
    return stripped.filter(F.length("text") > SHORTEST_MESSAGE).select(
        *carried, "text", "intent", F.lit(source).alias("source")
    )
