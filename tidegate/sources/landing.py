"""Staged CSV files: the options both sides share, and the reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled inside quoted fields, fields may hold line breaks, blanks are kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Columns are read by position, so a file whose header names them in another order is an error.
READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "false"}


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in columns])


def read_landing_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A staged extract, every column a string. Give ``columns`` to skip the look at the header."""
    reader = spark.read.options(**READ_OPTIONS)
    if columns is not None:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path if isinstance(path, str) else list(path))


BROKEN, FILE = "_broken", "_file"


def read_landing_rows(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], **more: str
) -> DataFrame:
    """As ``read_landing_csv``, with rows of too few or too many fields marked instead of refused.

    ``_broken`` has the text of such a row and ``_file`` the file it is from. A header with other
    names is an error all the same. ``more`` are further options of the reader.
    """
    schema = text_schema([*columns, BROKEN])
    options = {**READ_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN, **more}
    rows = spark.read.options(**options).schema(schema)
    rows = rows.csv(path if isinstance(path, str) else list(path))
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))
