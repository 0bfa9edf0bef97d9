"""A training corpus from raw documents: the stages, one after the other.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on; it is written as Parquet and
read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import mixing, neardup, pieces, quality, templates
from tidegate.llm.code import share_code
from tidegate.llm.queries import table, tokenizer_file
from tidegate.session import work_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the rejected ones go."""
    share_code(spark)
    return quality.resample(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines whose template recurs in other documents."""
    share_code(spark)
    return templates.drop_recurring(docs, keep_unique=True).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8."""
    share_code(spark)
    return neardup.deduplicate(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say, none less than once."""
    return mixing.mix(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' piece ids, and whether they decode to the text."""
    share_code(spark)
    return pieces.encode_checked(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("pieces", piece_stage),
]

# hashed models, sketches and templates are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
