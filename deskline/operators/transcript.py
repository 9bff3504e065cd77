"""Call transcript cleaner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from deskline.functions import patterns as p
from deskline.functions.text import collapse_whitespace, replace_all, said_by_customer, when_contains
from deskline.operators.cleaning import Projection, input_text, normalize, unless_blank


def strip_labels(text: Column) -> Column:
    return replace_all(text, p.CALL_LABEL, "$1")


def strip_agent_lines(text: Column) -> Column:
    """For transcripts without a customer label: drop the agent's lines and any
    other label, keep the rest."""
    return strip_labels(replace_all(text, p.CALL_AGENT_LINE, "$1"))


def strip_speech_noise(text: Column) -> Column:
    """Filler words, repeated ellipses and dashes."""
    text = replace_all(text, p.FILLER, "$1")
    text = when_contains(text, "..", lambda t: replace_all(t, p.ELLIPSES, "... "))
    return when_contains(text, "--", lambda t: replace_all(t, p.DASHES, "-"))


def transcript_body(text: Column, customer_only: bool = True) -> Column:
    """The steps after the normalization of characters."""
    text = replace_all(text, p.CALL_METADATA)
    text = when_contains(text, ":", lambda t: replace_all(t, p.CALL_TIME))
    text = when_contains(text, "[", lambda t: replace_all(t, p.CALL_NOTE, "$1"))
    if customer_only:
        text = said_by_customer(text, p.CALL_CUSTOMER_LINE, strip_agent_lines)
    else:
        text = strip_labels(text)
    return collapse_whitespace(strip_speech_noise(text))


def clean_transcripts(
    df: DataFrame, in_col: str = "raw_transcript", out_col: str = "clean_text", customer_only: bool = True
) -> DataFrame:
    """Add the cleaned form of each raw transcript; never null, ``""`` for no text.

    With ``customer_only`` the customer's lines are kept and the agent's dropped,
    otherwise all turns are kept without their labels. A narrow projection.
    """
    frame = Projection(df)
    raw = input_text(df, in_col)
    text = normalize(frame, unless_blank(raw, raw))
    return frame.result(out_col, transcript_body(text, customer_only))
