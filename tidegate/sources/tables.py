"""Source tables: whole, projected, or by a stored SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_source(
    spark: SparkSession, name: str, root: str | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A source table.

    Without ``root`` it is a table of the session catalog. ``fmt="jdbc"`` passes ``options`` on
    (``url``, and ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` so that many
    tasks read); other formats read ``root/name`` with or without the format's extension.
    """
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).option("dbtable", name).load()
    if root is None:
        return spark.table(name)
    path = name if "." in name else f"{name}.{fmt}"
    return spark.read.format(fmt).options(**options).load(f"{root}/{path}")


def scan_full(df: DataFrame) -> DataFrame:
    """``SELECT *``."""
    return df.select("*")


def scan_projected(df: DataFrame, return_fields: str) -> DataFrame:
    """``SELECT <return_fields>``: the stored text is any SQL select list."""
    fields = return_fields.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT {fields} FROM {{source}}", source=df)


def scan_freeform(
    spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """A stored SQL query over the session's tables and the given ones.

    Given tables are put before the query as named subqueries, so no view is left behind and queries
    beside each other do not see each other's tables.
    """
    frames = {f"given_{k}": df for k, df in enumerate((tables or {}).values())}
    if not frames:
        return spark.sql(sql)
    named = ", ".join(
        f"`{name}` AS (SELECT * FROM {{{key}}})" for name, key in zip(tables, frames, strict=True)
    )
    text = sql.replace("{", "{{").replace("}", "}}").strip()
    begins = text.split(None, 1)
    if begins and begins[0].upper() == "WITH":  # the query has named subqueries of its own
        return spark.sql(f"WITH {named}, {begins[1]}", **frames)
    return spark.sql(f"WITH {named} {text}", **frames)
