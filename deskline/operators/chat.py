"""Chat log cleaner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from deskline.functions import patterns as p
from deskline.functions.text import (
    collapse_whitespace,
    is_ascii,
    only_if,
    replace_all,
    said_by_customer,
    when_contains,
)
from deskline.operators.cleaning import Projection, input_text, normalize, unless_blank


def strip_labels(text: Column) -> Column:
    return replace_all(text, p.CHAT_LABEL, "$1")


def strip_bot_lines(text: Column) -> Column:
    """For logs without a customer label: drop the bot's lines and any other label,
    keep the rest."""
    return strip_labels(replace_all(text, p.CHAT_BOT_LINE, "$1"))


def strip_typing_noise(text: Column) -> Column:
    """Button echoes and repeated punctuation; URLs are masked in between."""
    text = replace_all(text, p.QUICK_REPLY)
    text = replace_all(text, p.URL, p.URL_MASK)
    return replace_all(text, p.PUNCTUATION_RUN, "$1")


def chat_body(text: Column, customer_only: bool = True) -> Column:
    """The steps after the normalization of characters."""
    text = replace_all(text, p.CHAT_METADATA)
    text = when_contains(text, ":", lambda t: replace_all(t, p.CHAT_TIME))
    text = when_contains(text, "[", lambda t: replace_all(t, p.CHAT_EVENT, "$1"))
    text = only_if(text, lambda t: ~is_ascii(t), lambda t: replace_all(t, p.EMOJI))
    if customer_only:
        text = said_by_customer(text, p.CHAT_CUSTOMER_LINE, strip_bot_lines)
    else:
        text = strip_labels(text)
    return collapse_whitespace(strip_typing_noise(text))


def clean_chats(
    df: DataFrame, in_col: str = "raw_chat", out_col: str = "clean_text", customer_only: bool = True
) -> DataFrame:
    """Add the cleaned form of each raw chat log; never null, ``""`` for no text.

    With ``customer_only`` the customer's messages are kept and the bot's dropped,
    otherwise all turns are kept without their labels. A narrow projection.
    """
    frame = Projection(df)
    raw = input_text(df, in_col)
    text = normalize(frame, unless_blank(raw, raw))
    return frame.result(out_col, chat_body(text, customer_only))
