"""Readers and writers of labelled tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskline.functions.names import quoted
from deskline.operators.rows import stack
from deskline.sources.csv_ranges import read_csv_ranges

# Cells read as missing where a caller asks for it (fixed values).
NA_VALUES = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    na_values: Sequence[str] = (),
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV files with a header, whose texts may hold newlines, quotes and outer
    whitespace. An empty cell is missing; so are the words in ``na_values``
    (``NA_VALUES`` for the usual ones).

    Files of any size are split. Where texts may hold newlines, the lines are first
    looked through to tell where rows begin (see :func:`read_csv_ranges`), so the file
    is read three times, twice at once; the rows come in no order. With
    ``multi_line=False`` a line is a row.
    """
    if multi_line:
        df = read_csv_ranges(spark, path, _ddl(schema), _CSV_OPTIONS)
    else:
        df = spark.read.options(**_CSV_OPTIONS).schema(schema).csv(path)
    if not na_values:
        return df
    missing = list(na_values)
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(missing), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def _ddl(schema: T.StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write CSV files with a header and no index; the folder is created or replaced.
    Files are kept small for readers that do not split them."""
    (
        df.write.mode("overwrite")
        .options(**_CSV_OPTIONS, quoteAll=True, maxRecordsPerFile=rows_per_file)
        .csv(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Write parquet files, the default for every table passed on to another step."""
    df.write.mode("overwrite").parquet(path)


def read_labelled(
    spark: SparkSession,
    path: str | list[str],
    text_col: str = "text",
    label_col: str = "intent",
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read a corpus and keep its texts and labels as ``text, intent``. CSV and JSON
    need a schema; parquet brings its own. ``multi_line`` is for CSV."""
    if file_format == "csv":
        df = read_csv(spark, path, schema, multi_line=multi_line)
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.format(file_format).load(path)
    return df.select(
        F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").alias("intent")
    )


def read_splits(
    spark: SparkSession, paths: Mapping[str, str], keep_split: bool = False, **options
) -> DataFrame:
    """Read the splits of a corpus and stack them; ``keep_split`` adds the name of the
    split each row came from."""
    splits = [
        read_labelled(spark, path, **options).withColumn("split", F.lit(name))
        for name, path in paths.items()
    ]
    stacked = stack(*splits)
    return stacked if keep_split else stacked.drop("split")
