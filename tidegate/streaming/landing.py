"""Dated change files upserted as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.clean import NA_TOKENS, na_tokens_to_null, strip_null_text
from tidegate.plans.loads import conform, create_if_missing, upsert_load
from tidegate.plans.tables import Target
from tidegate.sources.landing import READ_OPTIONS, text_schema

# Day of a drop, from its folder .../<yyyy>/<mm>/<dd>/...
_DAY_FOLDER = r"/(\d{4}/\d{2}/\d{2})/"
DROP_DAY = "_drop_day"


def landing_stream(
    spark: SparkSession, path: str, columns: Sequence[str], max_files: int | None = None
) -> DataFrame:
    """New staged files below ``path``, with the day of the drop they belong to."""
    reader = (
        spark.readStream.schema(text_schema(columns))
        .options(**READ_OPTIONS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    text = reader.csv(path)
    day = F.regexp_extract(F.col("_metadata.file_path"), _DAY_FOLDER, 1)
    return text.select("*", day.alias(DROP_DAY))


def landing_upsert_stream(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] = (),
    piece_by: str | None = None,
    max_files: int | None = None,
    tokens: Sequence[str] = NA_TOKENS,
    strip: bool = False,
) -> StreamingQuery:
    """Upserts all files there are, then stops; run again for later ones.

    The later drop wins a key, then ``order_by``, in whatever order drops arrive: a target made
    here keeps the drop day of each row in the column ``_drop_day``, and older drops do not replace
    newer rows. Targets without that column are compared by ``order_by`` alone. ``max_files`` bounds
    a batch. A batch repeated after a failure finds its own rows in the target and writes them again
    as they are; a new checkpoint is a new query, which reads everything again. A file whose header
    differs from ``schema`` stops the stream.
    """
    dated = T.StructType([*schema.fields, T.StructField(DROP_DAY, T.StringType())])
    if Target(spark, target).layout() is None:
        create_if_missing(spark, target, dated, piece_by)

    def apply(batch: DataFrame, _: int) -> None:
        layout = Target(batch.sparkSession, target).layout()
        held = {k.lower() for k in keys}
        text = strip_null_text(batch, schema.fieldNames()) if strip else batch
        cleaned = [c for c in schema.fieldNames() if c.lower() not in held]
        rows = conform(na_tokens_to_null(text, cleaned, tokens), dated)
        keeps_day = DROP_DAY in layout.struct.fieldNames()
        upsert_load(
            rows,
            target,
            keys,
            [DROP_DAY, *order_by],
            order_only=[] if keeps_day else [DROP_DAY],
            newer_by=[DROP_DAY, *order_by] if keeps_day else list(order_by),
        )

    return (
        landing_stream(spark, path, schema.fieldNames(), max_files)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
