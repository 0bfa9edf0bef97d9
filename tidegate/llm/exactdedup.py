"""Exact duplicates by a tree of merges over sorted runs of digests.

Each input partition writes a run: its documents' digests in order, each with the best document that
has it. In binomial rounds, runs whose numbers agree but for their lowest bits exchange what they
hold and merge it, ``2 ** FAN_IN`` at a time, keeping the best document and the count of each digest.
After the last round one run is left, dealt out by digest, and what it knows of repeated texts goes
back down the same tree. A group that holds a third of all documents is thus at most one row for
each run at every level, and never a hot key.

Digests are SHA-256 of the text without ASCII white space; every merge also compares an independent
64-bit hash and the length of that text, so only verified equals are joined. Of equal texts the one
with the most code points stays, then the smallest doc_id (missing ones last), then the first row.
A missing text counts as empty. Repeated rows are one group, of which a single row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import kept_table

FAN_IN = 4  # bits by which runs are merged in a round
RUN_BITS = 8
WHITE = r"[\x20\x09-\x0D]"
SAME = ["digest", "proof", "size"]


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, digest, proof, size, run, row and the rank of every document, sorted within runs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.col("bare")
    return (
        docs.select(
            "doc_id",
            F.length(text).alias("points"),
            F.regexp_replace(text, WHITE, "").alias("bare"),
            F.spark_partition_id().bitwiseAND((1 << RUN_BITS) - 1).alias("run"),
            F.monotonically_increasing_id().alias("row"),
        )
        .select(
            "doc_id",
            F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"),
            F.xxhash64(bare).alias("proof"),
            F.length(bare).alias("size"),
            "run",
            "row",
            F.struct(
                (-F.col("points")).alias("shorter"),
                F.col("doc_id").isNull().alias("unnamed"),
                "doc_id",
                "row",
            ).alias("rank"),
        )
        .sortWithinPartitions("digest")
    )


def merged(held: DataFrame, bits: int) -> DataFrame:
    """One round: runs that differ in their lowest bits become one."""
    return (
        held.withColumn("run", F.shiftright("run", bits))
        .groupBy(*SAME, "run")
        .agg(F.min("rank").alias("rank"), F.sum("n").alias("n"))
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    rows = kept_table(runs(docs), "digest-runs")
    levels = [merged(rows.withColumn("n", F.lit(1).cast("long")), 0)]
    for _ in range(RUN_BITS // FAN_IN):
        levels.append(merged(levels[-1], FAN_IN))
    known = levels[-1].where("n > 1").select(
        *SAME, "run", F.col("rank").alias("best"), F.col("n").alias("group_size")
    )
    for level in reversed(levels[:-1]):
        above = known.withColumnRenamed("run", "up")
        known = (
            level.select(*SAME, "run", F.shiftright("run", FAN_IN).alias("up"))
            .join(above, [*SAME, "up"])
            .select(*SAME, "run", "best", "group_size")
        )
    kept_id = F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return rows.join(known, [*SAME, "run"], "left").select(
        "doc_id",
        kept_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k"""
