"""Content reconciliation: digests of rows that do not depend on their order.

Equal counts do not say that two tables hold the same rows. A digest of a set of rows is their number
and the sums of two 64-bit hashes; sums merge before any shuffle, so that a table is compared with another
one by one row per group and task. Rows that are compared must have the same columns and types.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 7  # stands before the columns of the second hash
BUCKETS = 4096
_DIGEST = ("row_count", "digest_1", "digest_2")


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row; a missing value differs from all others and keeps its place."""
    marked = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*marked), F.xxhash64(F.lit(SECOND), *marked)


def digests(df: DataFrame, by: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """group, row_count, digest_1 and digest_2 of the rows of each group."""
    one, two = _hashes(columns or df.columns)
    wide = "decimal(38,0)"
    return df.groupBy(by.alias("group")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(one.cast(wide)).alias("digest_1"),
        F.sum(two.cast(wide)).alias("digest_2"),
    )


def differing_groups(source: DataFrame, target: DataFrame) -> DataFrame:
    """Groups of two digests whose rows differ, with both counts; a group that is missing has none."""
    left, right = source.toDF("_group", *[f"_{c}" for c in _DIGEST]), target
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _DIGEST])
    joined = left.join(right, F.col("group").eqNullSafe(F.col("_group")), "full")
    return joined.where(~same).select(
        F.coalesce("group", "_group").alias("group"),
        F.coalesce("_row_count", F.lit(0).cast("bigint")).alias("source_rows"),
        F.coalesce("row_count", F.lit(0).cast("bigint")).alias("target_rows"),
    )


def deleted_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Keys of the target that the source no longer has.

    Keys are dealt to buckets by a hash. Only buckets whose digests differ are looked into, so that
    a table with few deletions joins few of its keys.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))
    ours, theirs = (df.select(*[F.col(f"`{k}`") for k in keys]).distinct() for df in (target, source))
    odd = differing_groups(*[digests(df, bucket) for df in (theirs, ours)]).select("group")
    held = [
        df.withColumn("_bucket", bucket).join(odd, F.col("_bucket") == F.col("group"), "left_semi")
        for df in (ours, theirs)
    ]
    other = held[1].select(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys], F.col("_bucket").alias("_b"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_key_{k}`")) for k in keys]
    on = reduce(lambda a, b: a & b, [F.col("_bucket") == F.col("_b"), *same])
    return held[0].join(other, on, "left_anti").select(*[F.col(f"`{k}`") for k in keys])
