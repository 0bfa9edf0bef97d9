"""Small helpers over frames: bounded label samples, written intermediate tables, exact top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import drop_path, work_path

BINS = 1 << 12


def kept_table(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = work_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Kept:
    """The written intermediate tables of one operator, by purpose, so that they can be removed when
    nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[tuple[str, str]] = []

    def table(self, df: DataFrame, purpose: str) -> DataFrame:
        """As ``kept_table``."""
        path = work_path(self.spark, purpose)
        df.write.parquet(path)
        self.paths.append((purpose, path))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_all_but(self, *purposes: str) -> None:
        """Removes the tables that a result, not computed yet, does not read."""
        for purpose, path in self.paths:
            if purpose not in purposes:
                drop_path(self.spark, path)
        self.paths = [x for x in self.paths if x[0] in purposes]


def label_sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """doc_id and label of at most ``bound`` labelled documents, chosen by a hash of doc_id.

    Rows without an id or a label are left out; of several labels of a document the greatest holds.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    n = rows.count()
    if n > bound:
        share = int(0.97 * bound / n * (1 << 32))
        rows = rows.where(F.xxhash64("doc_id").bitwiseAND((1 << 32) - 1) < share)
    return rows.limit(bound)


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text and label (missing where unknown); the sample's size is bounded, so it is sent
    to every task."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left")


def uniform(seed: int, *columns: str) -> Column:
    """A number between 0 and 1, both excluded, that depends on the columns' values alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def top_k_cut(scored: DataFrame, key: str, tie: str, k: int):
    """(key, tie) of the k-th row by key descending and tie ascending; None where k rows or fewer.

    Each pass counts the rows of a fixed number of bins and goes on with the bin the k-th row is in,
    until few rows or one key are left; only bin counts come to the driver.
    """
    if k < 1:
        return (float("inf"), -1)
    rows, ahead = scored.where(F.col(key).isNotNull()), 0
    total, low, high = rows.agg(F.count("*"), F.min(key), F.max(key)).first()
    if total <= k:
        return None
    while total > 10_000 and low < high:
        width = (high - low) / BINS
        if not width or low + width == low:
            break
        numbered = rows.withColumn(
            "_bin", F.least(F.lit(BINS - 1), F.floor((F.col(key) - low) / width)).cast("int")
        )
        found = {
            r[0]: r[1:]
            for r in numbered.groupBy("_bin")
            .agg(F.count("*"), F.min(key), F.max(key))
            .collect()
        }
        for b in sorted(found, reverse=True):
            if ahead + found[b][0] >= k:
                break
            ahead += found[b][0]
        total, low, high = found[b]
        rows = rows.where((F.col(key) >= low) & (F.col(key) <= high))
    row = (
        rows.select(key, tie)
        .orderBy(F.desc(key), F.asc_nulls_first(tie))
        .offset(k - ahead - 1)
        .limit(1)
        .first()
    )
    return tuple(row)
