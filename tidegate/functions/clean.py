"""Null handling of text extracts, as column expressions over whole frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The whole-field spellings that mean "missing" in a text extract.
NA_TOKENS = (
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


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _replace(df: DataFrame, columns: Sequence[str] | None, sql: str) -> DataFrame:
    """Rewrites columns by one SQL template; ``{c}`` stands for the column."""
    chosen = set(string_columns(df) if columns is None else columns)
    return df.selectExpr(
        *[f"{sql.format(c=f'`{n}`')} AS `{n}`" if n in chosen else f"`{n}`" for n in df.columns]
    )


def sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def na_tokens_to_null(
    df: DataFrame, columns: Sequence[str] | None = None, tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """Fields that are exactly one of ``tokens`` become NULL (string columns by default)."""
    listed = ", ".join(sql_literal(t) for t in tokens).replace("{", "{{").replace("}", "}}")
    return _replace(df, columns, f"CASE WHEN {{c}} NOT IN ({listed}) THEN {{c}} END")


def null_to_empty(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL text becomes the empty string, the one spelling of missing in a staged file."""
    return _replace(df, columns, "coalesce({c}, '')")


def strip_null_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Deletes the letters ``null`` wherever they stand, inside words too.

    It damages values such as ``nullable``; loads use ``na_tokens_to_null`` unless asked.
    """
    return _replace(df, columns, "replace({c}, 'null', '')")


def clean_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count results as text: missing, ``nan`` and ``null`` all mean "no value"."""
    return na_tokens_to_null(df, columns)


def all_text(df: DataFrame) -> DataFrame:
    """Every column as a string, the only transport type of an extract."""
    return df.selectExpr(*[f"CAST(`{n}` AS STRING) AS `{n}`" for n in df.columns])


def extract_is_empty(df: DataFrame) -> bool:
    """True when an extract holds no row; stops at the first row found."""
    return df.isEmpty()


def empty_flag(df: DataFrame) -> DataFrame:
    """The same as a one-row frame."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("zero_rows"))
