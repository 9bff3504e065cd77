"""Names for columns that exist only inside an operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def unused(name: str, *frames: DataFrame, besides: Iterable[str] = ()) -> str:
    """``name``, lengthened until no column of the frames has it in any case."""
    taken = {c.lower() for frame in frames for c in frame.columns} | {c.lower() for c in besides}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as Spark's parser reads it back."""
    return "`" + name.replace("`", "``") + "`"
