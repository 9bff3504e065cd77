"""Email cleaner."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions import patterns as p
from deskline.functions.text import (
    collapse_whitespace,
    cut_from,
    first_words,
    let,
    may_contain_any,
    normalize_newlines,
    only_if,
    remove_forwards,
    replace_all,
    when_contains,
)
from deskline.functions.unicode import unescape_html
from deskline.operators.cleaning import Projection, input_text, normalize, unless_blank

# Any case, Unicode classes, and \n as the only line end.
_EXTRA_FLAGS = "(?iUd)"


@dataclass(frozen=True)
class EmailConfig:
    """What the email cleaner removes. Read while the plan is built: a step that
    is off adds nothing to it.

    ``max_chain_depth`` is the number of forwarded blocks removed, 0 for all of
    them. ``max_length`` is a number of words, 0 or None for no limit.
    ``extra_removal_patterns`` are Java regular expressions, matched in any case; ``\\s``,
    ``\\d`` and ``\\w`` are Unicode's, and only ``\\n`` ends a line. A bad pattern is
    refused where a session is active, else when the cleaner is applied.
    """

    strip_forwarded_headers: bool = True
    strip_reply_headers: bool = True
    strip_email_headers: bool = True
    max_chain_depth: int = 3
    strip_signatures: bool = True
    strip_disclaimers: bool = True
    strip_html: bool = True
    strip_urls: bool = True
    strip_emails: bool = False
    strip_phone_numbers: bool = False
    strip_ids: bool = False
    normalize_whitespace: bool = True
    normalize_unicode: bool = True
    lowercase: bool = False
    max_length: int | None = 512
    extra_removal_patterns: tuple[str, ...] = ()

    def __post_init__(self):
        if self.max_chain_depth < 0:
            raise ValueError("max_chain_depth must be 0 (no limit) or more")
        if self.max_length is not None and self.max_length < 0:
            raise ValueError("max_length must be None or 0 (no limit) or more")
        if SparkSession.getActiveSession() is not None:
            self.check_patterns(SparkSession.getActiveSession())

    def check_patterns(self, spark: SparkSession) -> None:
        """Refuse a pattern that Java cannot compile."""
        for pattern in self.extra_removal_patterns:
            try:
                spark.sparkContext._jvm.java.util.regex.Pattern.compile(_EXTRA_FLAGS + pattern)
            except IllegalArgumentException as error:
                raise ValueError(f"bad pattern {pattern!r}: {error}") from None

    @classmethod
    def ner_friendly(cls) -> EmailConfig:
        """Keeps identifiers, addresses and numbers for entity extraction, as the
        default does."""
        return cls()

    @classmethod
    def strict(cls) -> EmailConfig:
        """Masks everything that can be masked; for intent classification."""
        return cls(strip_emails=True, strip_phone_numbers=True, strip_ids=True, max_length=256)


def strip_tags(text: Column) -> Column:
    """Markup and character references that are still there, as spaces."""
    text = when_contains(text, ">", lambda t: replace_all(t, p.HTML_TAG, "$1 "))
    return when_contains(text, "&", lambda t: replace_all(t, p.HTML_ENTITY, " "))


def strip_chain(text: Column, config: EmailConfig) -> Column:
    """Placeholders, automatic replies, forwarded blocks, headers and quotes."""
    text = when_contains(text, "[", lambda t: replace_all(t, p.PLACEHOLDER, "$1"))
    text = replace_all(text, p.AUTO_REPLY)
    if config.strip_forwarded_headers:
        text = when_contains(text, "---", lambda t: remove_forwards(t, config.max_chain_depth))
    if config.strip_reply_headers:
        text = replace_all(text, p.REPLY_HEADER)
    if config.strip_email_headers:
        text = replace_all(text, p.HEADER_LINE)
    return when_contains(text, ">", lambda t: replace_all(t, p.QUOTED_LINE, "$1"))


def strip_disclaimer(text: Column) -> Column:
    """Cut from the first disclaimer phrase."""
    return only_if(
        text,
        lambda t: may_contain_any(t, p.DISCLAIMER_WORDS),
        lambda t: cut_from(t, p.FROM_DISCLAIMER),
    )


def strip_signature(text: Column) -> Column:
    """Cut from the first ``--`` or ``___`` line, or, in texts without one, from the
    first closing phrase on a line of its own."""

    def cut(t: Column) -> Column:
        marked = when_contains(t, ("--", "___"), lambda t: cut_from(t, p.FROM_SIGNATURE_MARK))
        return let(
            marked, lambda head: F.when(head == t, cut_from(t, p.FROM_CLOSING)).otherwise(head)
        )

    return let(text, cut)


def mask_identifiers(text: Column, config: EmailConfig) -> Column:
    """URLs, addresses, phone numbers and freight ids, in this order: a number that
    reads as a phone number is never masked as a waybill."""
    if config.strip_urls:
        text = replace_all(text, p.URL, p.URL_MASK)
    if config.strip_emails:
        text = when_contains(text, "@", lambda t: replace_all(t, p.EMAIL_ADDRESS, "$1" + p.EMAIL_MASK))
    if config.strip_phone_numbers or config.strip_ids:
        text = only_if(text, lambda t: t.rlike(p.FOUR_DIGITS), lambda t: mask_numbers(t, config))
    return text


def mask_numbers(text: Column, config: EmailConfig) -> Column:
    if config.strip_phone_numbers:
        text = replace_all(text, p.PHONE, p.PHONE_MASK)
    if config.strip_ids:
        text = replace_all(text, p.EQUIPMENT_ID, p.EQUIPMENT_MASK)
        text = replace_all(text, p.ORDER_NUMBER, p.ORDER_MASK)
        text = replace_all(text, p.WAYBILL, p.WAYBILL_MASK)
    return text


def decoded_email(raw: Column, config: EmailConfig) -> Column:
    """The first steps, up to the normalization of characters; never null."""
    if not config.strip_html:
        return unless_blank(raw, raw)
    return strip_tags(unless_blank(raw, unescape_html(raw)))


def email_body(text: Column, config: EmailConfig) -> Column:
    """The steps after the normalization of characters."""
    text = strip_chain(text, config)
    if config.strip_disclaimers:
        text = strip_disclaimer(text)
    if config.strip_signatures:
        text = strip_signature(text)
    text = mask_identifiers(text, config)
    for pattern in config.extra_removal_patterns:
        text = replace_all(text, _EXTRA_FLAGS + pattern)
    if config.normalize_whitespace:
        text = collapse_whitespace(text)
    if config.lowercase:
        text = F.lower(text)
    if config.max_length:
        text = first_words(text, config.max_length)
    return text


def clean_emails(
    df: DataFrame, in_col: str = "raw_email", out_col: str = "clean_text", config: EmailConfig | None = None
) -> DataFrame:
    """Add the cleaned form of each raw email; never null, ``""`` for no text.

    A narrow projection: no shuffle, and rows keep their other columns.
    """
    config = config or EmailConfig()
    config.check_patterns(df.sparkSession)
    frame = Projection(df)
    text = decoded_email(input_text(df, in_col), config)
    text = normalize(frame, text) if config.normalize_unicode else normalize_newlines(text)
    return frame.result(out_col, email_body(text, config))
