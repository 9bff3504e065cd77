"""Shared frame of the three cleaners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskline.functions import patterns as p
from deskline.functions.text import is_ascii, normalize_newlines, only_if, replace_all
from deskline.functions.unicode import to_nfc


class Projection:
    """Adds columns to a frame, some of them only for use by later ones.

    A bound value is generated as a one-element lateral view, which the optimizer
    neither copies into its users nor into a filter on them: a long chain of steps
    runs once per row, while filters on other columns still reach the scan.
    """

    def __init__(self, df: DataFrame):
        self._df = df
        self._columns = df.columns

    def bind(self, value: Column) -> Column:
        """Give ``value`` a name of its own, so that naming it again is free."""
        name = "_bound"
        while name in self._df.columns:
            name += "_"
        self._df = self._df.select("*", F.explode(F.array(value)).alias(name))
        return F.col(name)

    def select(self, *columns: Column) -> DataFrame:
        """The frame with these columns, which may name bound values."""
        return self._df.select(*columns)

    def result(self, out_col: str, value: Column) -> DataFrame:
        """The frame's own columns and ``value`` as ``out_col``."""
        value = self.bind(value)
        kept = [F.col(f"`{c}`") for c in self._columns if c != out_col]
        return self._df.select(*kept, value.alias(out_col))


def input_text(df: DataFrame, in_col: str) -> Column:
    """The column's texts; null for everything that is not text."""
    if not isinstance(df.schema[in_col].dataType, T.StringType):
        return F.lit(None).cast("string")
    return F.col(f"`{in_col}`")


def unless_blank(raw: Column, text: Column) -> Column:
    """``text``, or ``""`` where ``raw`` is null or holds whitespace only."""
    return F.coalesce(F.when(raw.rlike(p.HAS_TEXT), text), F.lit(""))


def normalize(frame: Projection, text: Column) -> Column:
    """LF line ends, no zero-width characters, normalization form C."""
    text = only_if(
        normalize_newlines(text), lambda t: ~is_ascii(t), lambda t: replace_all(t, p.ZERO_WIDTH)
    )
    return to_nfc(frame.bind(text))
