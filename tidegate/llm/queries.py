"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidegate.llm import (
    exactdedup,
    licenses,
    merkle,
    mixing,
    nearest,
    neardup,
    periodic,
    pieces,
    quality,
    templates,
    tokenfiles,
    toxicity,
    vectors,
)
from tidegate.llm.code import share_code
from tidegate.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            share_code(spark)
            return fn(spark, sf)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies, on the driver and on every worker."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(licenses.scan_sql())
def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


@query(exactdedup.SQL)
def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf, "documents"))


@query()
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op4_quality_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return quality.draw(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op5_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    return templates.digests(table(spark, sf, "documents"), keep_unique=True)


@query()
def op6_bottom_k_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), width=3, percent=85)


@query()
def op7_near_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query()
def op8_sentence_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.digests(table(spark, sf, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query()
def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "token-files")
    tokenfiles.write_token_files(
        table(spark, sf, "documents"),
        path,
        tokenizer_file("byte_bpe_50k.json"),
        added_tokens=True,
    )
    return tokenfiles.digests(spark, path)


@query()
def op10_soft_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.rates(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op11_adaptive_scan(spark: SparkSession, sf: str) -> DataFrame:
    return nearest.nearest(table(spark, sf, "embeddings"))


@query()
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return periodic.digests(periodic.periodic_runs(periodic.planted(documents)))


@query(merkle.SQL)
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.checked(table(spark, sf, "documents"))
