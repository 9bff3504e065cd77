"""Entities, routing by confidence and JSON records."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskline.functions import patterns as p
from deskline.functions.text import let
from deskline.operators.cleaning import Projection, input_text

FALLBACK_THRESHOLD = 0.85


def found_entities(text: Column) -> Column:
    """What each pattern finds in a text, as a struct of lists. The patterns are
    independent: a seven-digit number is listed as a phone number and as a waybill."""

    none = F.array().cast("array<string>")

    def find(t: Column) -> Column:
        def all_of(pattern: str, group: int = 0) -> Column:
            return F.regexp_extract_all(t, F.lit(pattern), F.lit(group))

        return F.struct(
            F.when(F.contains(t, F.lit("@")), all_of(p.EMAIL_ADDRESS, 2)).otherwise(none).alias("emails"),
            all_of(p.PHONE).alias("phones"),
            all_of(p.WAYBILL).alias("waybills"),
            all_of(p.EQUIPMENT_ID).alias("equipment_ids"),
            all_of(p.ORDER_NUMBER).alias("order_numbers"),
            all_of(p.WEIGHT).alias("weights"),
        )

    return let(F.coalesce(text, F.lit("")), find)


def extract_entities(df: DataFrame, in_col: str = "clean_text", out_col: str = "entities") -> DataFrame:
    """Add the email addresses, phone numbers, waybills, equipment ids, order numbers
    and weights of each text; empty lists where there are none."""
    return Projection(df).result(out_col, found_entities(input_text(df, in_col)))


# Marks around entities; texts that hold them are looked at with other characters there.
_PLAIN, _NEXT, _END = "\x01", "\x02", "\x03"


def _spans_udf():
    kinds, marks = p.ENTITY_KINDS, (_PLAIN, _NEXT, _END)

    def spans(texts: pa.Array) -> pa.Array:
        import pyarrow

        before, between, end = marks
        found = []
        for text in texts.to_pylist():
            at, own = 0, []
            for stretch in (text or "").split(end)[:-1]:
                plain, values = stretch.split(before)
                at += len(plain)
                for kind, value in zip(kinds, values.split(between)):
                    if value:
                        own.append({"kind": kind, "start": at, "stop": at + len(value), "value": value})
                        at += len(value)
            found.append(None if text is None else own)
        fields = [("kind", pyarrow.string()), ("start", pyarrow.int64()), ("stop", pyarrow.int64()), ("value", pyarrow.string())]
        return pyarrow.array(found, pyarrow.list_(pyarrow.struct(fields)))

    return F.arrow_udf(spans, "array<struct<kind:string,start:bigint,stop:bigint,value:string>>")


def entity_spans(df: DataFrame, in_col: str = "clean_text", out_col: str = "spans") -> DataFrame:
    """Add the entities of each text with their places: ``kind``, ``start`` and ``stop``
    (characters from 0, end exclusive) and ``value``, in the order of the text.

    Spans do not overlap. The leftmost entity claims its characters; where several begin,
    the kinds claim in the order email, equipment id, order number, weight, phone, waybill,
    so a number is a phone or a waybill, never both (:func:`extract_entities` lists it as
    both). Null texts and those without entities have no spans.

    The places come from one pattern, matched where the text is; only texts that hold an
    entity go through Python, which counts characters.
    """
    frame = Projection(df)
    text = F.translate(F.coalesce(input_text(df, in_col), F.lit("")), _PLAIN + _NEXT + _END, "\x04\x04\x04")
    groups = "$1" + _PLAIN + _NEXT.join(f"${i + 2}" for i in range(len(p.ENTITY_KINDS))) + _END
    marked = frame.bind(F.regexp_replace(text, F.lit(p.ENTITY), F.lit(groups)))
    spans = _spans_udf()(F.when(F.contains(marked, F.lit(_END)), marked))
    none = F.array().cast("array<struct<kind:string,start:bigint,stop:bigint,value:string>>")
    return frame.result(out_col, F.coalesce(spans, none))


def _confident(threshold: float, confidence_col: str) -> Column:
    """False for a missing confidence and for NaN, which Spark sorts above all numbers."""
    confidence = F.col(f"`{confidence_col}`")
    return F.coalesce(~F.isnan(confidence) & (confidence >= threshold), F.lit(False))


def with_route(
    df: DataFrame, threshold: float = FALLBACK_THRESHOLD, confidence_col: str = "confidence", out_col: str = "route"
) -> DataFrame:
    """Add ``accepted`` or, below the threshold or without a confidence, ``fallback``."""
    route = F.when(_confident(threshold, confidence_col), F.lit("accepted")).otherwise(F.lit("fallback"))
    return df.withColumn(out_col, route)


def route_by_confidence(
    df: DataFrame, threshold: float = FALLBACK_THRESHOLD, confidence_col: str = "confidence"
) -> tuple[DataFrame, DataFrame]:
    """The accepted rows, and all others for the fallback."""
    accepted = _confident(threshold, confidence_col)
    return df.filter(accepted), df.filter(~accepted)


def to_records(df: DataFrame, out_col: str = "record") -> DataFrame:
    """One JSON object for each row with all its fields, null ones as ``null``."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias(out_col))
