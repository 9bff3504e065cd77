"""Clean texts of several channels in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.functions.text import normalize_newlines
from deskline.operators.chat import chat_body
from deskline.operators.cleaning import Projection, input_text, normalize, unless_blank
from deskline.operators.email import EmailConfig, decoded_email, email_body
from deskline.operators.transcript import transcript_body

EMAIL, TRANSCRIPT, CHAT = "email", "transcript", "chat"


def clean_interactions(
    df: DataFrame,
    channel_col: str = "channel",
    in_col: str = "raw_text",
    out_col: str = "clean_text",
    email_config: EmailConfig | None = None,
    customer_only: bool = True,
) -> DataFrame:
    """Clean each text by its channel: ``email``, ``transcript`` or ``chat``. Texts of
    any other channel, or none, get null.

    The frame is read once, without a filter and a union per channel: the channels
    share the normalization of characters, and of the three chains of steps after it
    a row runs only its own.
    """
    config = email_config or EmailConfig()
    config.check_patterns(df.sparkSession)
    frame = Projection(df)
    channel = F.col(f"`{channel_col}`")
    raw = input_text(df, in_col)
    is_email = channel == EMAIL
    email = decoded_email(F.when(is_email, raw), config)
    if config.normalize_unicode:
        text = normalize(frame, F.when(is_email, email).otherwise(unless_blank(raw, raw)))
    else:
        dialogue = normalize(frame, F.when(~is_email, unless_blank(raw, raw)))
        text = F.when(is_email, normalize_newlines(email)).otherwise(dialogue)
    text = frame.bind(text)
    cleaned = (
        F.when(is_email, email_body(text, config))
        .when(channel == TRANSCRIPT, transcript_body(text, customer_only))
        .when(channel == CHAT, chat_body(text, customer_only))
    )
    return frame.result(out_col, cleaned)
