"""Target tables: Parquet folders cut into pieces, written by Spark's own committers.

A table is a folder partitioned by ``__piece``, an expression over its rows (month of creation, hash of
the key), or one piece if it is not cut. Loads overwrite the pieces they write and no other (dynamic
partition overwrite), or append. Files are written aside and put in place when the job commits, so a
job that fails leaves the table as it was, and a repeated task leaves nothing twice.

The layout, columns and cut, is kept in ``_layout`` below the table; a new one is appended when it
grows, and files of an earlier layout are read with NULL in later columns.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import drop_path, path_exists, small_frame

PIECE = "__piece"
WHOLE = "all"
_LAYOUT = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField("columns", T.StringType()),
        T.StructField("piece_by", T.StringType()),
    ]
)

# Types that Spark reads from files of a narrower one, each with those it takes in.
WIDER = {
    "smallint": ("tinyint",),
    "int": ("tinyint", "smallint"),
    "bigint": ("tinyint", "smallint", "int"),
    "double": ("tinyint", "smallint", "int", "float"),
    "timestamp_ntz": ("date",),
}


class Layout(NamedTuple):
    number: int
    struct: T.StructType
    piece_by: str | None


def piece_column(piece_by: str | None) -> Column:
    """The piece of a row, as text that is safe in a folder name."""
    if piece_by is None:
        return F.lit(WHOLE)
    raw = F.coalesce(F.expr(piece_by).cast("string"), F.lit("none"))
    safe = F.regexp_replace(raw, "[^A-Za-z0-9_.-]", "_")
    unchanged = (raw == safe) & (raw != "")
    return F.when(unchanged, raw).otherwise(F.concat_ws("_", F.lit("x"), safe, F.crc32(raw)))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _wider(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The one of two types that takes in the other; None where neither does."""
    a, b = one.simpleString(), two.simpleString()
    if a == b or b in WIDER.get(a, ()):
        return one
    if a in WIDER.get(b, ()):
        return two
    if isinstance(one, T.DecimalType) and isinstance(two, T.DecimalType):
        scale = max(one.scale, two.scale)
        whole = max(one.precision - one.scale, two.precision - two.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def grown(held: T.StructType, found: T.StructType) -> T.StructType:
    """The least layout that takes in both: all columns, each with the wider of its types.

    Types without a common wider one keep the held one; values that do not fit it fail the load.
    """
    known = {f.name.lower(): f for f in found.fields}
    fields = []
    for f in held.fields:
        other = known.pop(f.name.lower(), None)
        kind = (other is not None and _wider(f.dataType, other.dataType)) or f.dataType
        fields.append(T.StructField(f.name, kind, True))
    fields += [T.StructField(f.name, f.dataType, True) for f in found.fields if f.name.lower() in known]
    return T.StructType(fields)


class Target:
    """A target table by its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # layout ------------------------------------------------------------------------------

    def layout(self) -> Layout | None:
        """The latest layout; None where there is no table."""
        if not path_exists(self.spark, f"{self.path}/_layout"):
            return None
        kept = self.spark.read.schema(_LAYOUT).parquet(f"{self.path}/_layout")
        last = kept.orderBy(F.desc("number")).first()
        if last is None:
            return None
        return Layout(last.number, T.StructType.fromJson(json.loads(last["columns"])), last.piece_by)

    def _keep(self, layout: Layout) -> Layout:
        row = {"number": layout.number, "columns": layout.struct.json(), "piece_by": layout.piece_by}
        small_frame(self.spark, [row], _LAYOUT).write.mode("append").parquet(f"{self.path}/_layout")
        return layout

    def ensure(self, schema: T.StructType, piece_by: str | None = None) -> tuple[Layout, bool]:
        """The layout with the schema's columns, and whether the table was there before."""
        held = self.layout()
        if held is None:
            return self._keep(Layout(1, _nullable(schema), piece_by)), False
        struct = grown(held.struct, schema)
        if struct != held.struct:
            held = self._keep(Layout(held.number + 1, struct, held.piece_by))
        return held, True

    # reading -----------------------------------------------------------------------------

    def _read(self, layout: Layout) -> DataFrame:
        """All rows with their piece."""
        whole = T.StructType([*layout.struct.fields, T.StructField(PIECE, T.StringType())])
        return self.spark.read.schema(whole).parquet(self.path)

    def read(self, layout: Layout | None = None, pieces: set[str] | None = None) -> DataFrame:
        """The table, or some pieces of it; the files of others are not opened."""
        layout = layout or self.layout()
        if layout is None:
            raise FileNotFoundError(f"no table at {self.path}")
        rows = self._read(layout)
        if pieces is not None:
            rows = rows.where(F.col(PIECE).isin(sorted(pieces)))
        return rows.drop(PIECE)

    def sizes(self) -> dict[str, int]:
        """Rows of each piece, from the files' footers; one entry for each piece."""
        only = T.StructType([T.StructField(PIECE, T.StringType())])
        found = self.spark.read.schema(only).parquet(self.path).groupBy(PIECE).count().collect()
        return {r[PIECE]: r["count"] for r in found}

    # writing -----------------------------------------------------------------------------

    def _write(self, df: DataFrame, layout: Layout, mode: str) -> set[str]:
        """Writes rows into their pieces; gives the pieces that were written."""
        written = Observation()
        rows = df.withColumn(PIECE, piece_column(layout.piece_by))
        if layout.piece_by is not None:
            rows = rows.hint("rebalance", PIECE)  # a piece with most rows goes to many tasks
        (
            rows.observe(written, F.collect_set(PIECE).alias("pieces"))
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PIECE)
            .parquet(self.path)
        )
        return set(written.get["pieces"] or ())

    def overwrite(self, df: DataFrame, layout: Layout, gone: set[str]) -> set[str]:
        """Replaces the pieces that occur in ``df``; of ``gone``, those that do not occur are removed."""
        written = self._write(df, layout, "overwrite")
        for piece in sorted(gone - written):
            self.remove(piece)
        return written

    def append(self, df: DataFrame, layout: Layout) -> set[str]:
        return self._write(df, layout, "append")

    def remove(self, piece: str) -> None:
        drop_path(self.spark, f"{self.path}/{PIECE}={piece}")
