"""Staging extracts and loading them: replace, append, upsert, and their windowed forms.

``staged`` frames are lazy; each load runs them once, into the target's pieces (an upsert
first writes the reduced stage, whose size then decides how the joins run). Rows are counted from
the footers of written files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.clean import (
    NA_TOKENS,
    all_text,
    na_tokens_to_null,
    null_to_empty,
    strip_null_text,
)
from tidegate.operators.joins import (
    assign_window,
    keep_latest,
    primary_keys,
    rows_with_match,
    rows_without_match,
)
from tidegate.operators.slices import catalog_slice
from tidegate.plans.tables import PIECE, Layout, Target, piece_column
from tidegate.schemas import CATALOG_COLUMNS, PRIMARY_KEYS
from tidegate.session import drop_path, work_path
from tidegate.sources.landing import BROKEN, CSV_OPTIONS, FILE, read_landing_csv
from tidegate.sources.tables import scan_projected

ASIDE = T.StructType([T.StructField(c, T.StringType()) for c in ("reason", "row", "file")])
ROWS_PER_FILE = 250_000  # a file with line breaks inside fields is read by one task


class LoadResult(NamedTuple):
    path: str
    rows_before: int
    rows_after: int
    processed: int


# staging -----------------------------------------------------------------------------------


def stage_raw(
    df: DataFrame,
    root: str,
    prefix: str,
    load_id: str,
    window: str | None = None,
    strip: bool = False,
    rows_per_file: int = ROWS_PER_FILE,
    tokens: Sequence[str] = NA_TOKENS,
    keys: Sequence[str] = (),
) -> str:
    """Writes an extract as cleaned CSV text below ``root/prefix`` and returns its folder.

    Spellings of missing become empty fields, but not in ``keys``: there they would make different
    keys one.

    With ``window`` the rows of each window go to a folder of their own; the shuffle this takes
    splits windows that hold a large share of the rows.
    """
    path = f"{root.rstrip('/')}/{prefix.strip('/')}/{load_id}"
    text = all_text(df)
    if strip:
        text = strip_null_text(text)
    values = [c for c in text.columns if c != window]
    text = null_to_empty(na_tokens_to_null(text, _beside(values, keys), tokens), values)
    # one empty field alone on a line would read as no line at all
    empty = "" if len(values) > 1 else '""'
    if window:
        text = text.hint("rebalance", window)
    writer = (
        text.write.options(**CSV_OPTIONS)
        .option("emptyValue", empty)
        .option("nullValue", "")
        .option("maxRecordsPerFile", rows_per_file)
    )
    (writer.partitionBy(window) if window else writer).csv(path)
    return path


def _beside(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    held = {k.lower() for k in keys}
    return [c for c in columns if c.lower() not in held]


def staged_per_window(spark: SparkSession, path: str, columns: Sequence[str], window: str) -> DataFrame:
    """window and row_count of what was staged, from the files."""
    text = read_landing_csv(spark, path, [*columns, window])
    return text.groupBy(window).agg(F.count(F.lit(1)).alias("row_count"))


def read_staged(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    window: str | None = None,
    tokens: Sequence[str] = NA_TOKENS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """A staged extract with missing spellings as NULL and the columns cast to ``schema``.

    A value that does not fit its type is an error of the load, not a silent NULL.
    """
    columns = [n for n in schema.fieldNames() if n != window]
    text = read_landing_csv(spark, path, columns)
    text = na_tokens_to_null(text, _beside(columns, keys), tokens)
    return conform(text.drop(window) if window else text, schema)


def set_aside(
    df: DataFrame, schema: T.StructType, aside: str, keys: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """The rows that fit ``schema``, cast to it, and how many others were written below ``aside``.

    Others are rows that reading marked as broken, rows with a value that does not fit its type, and rows
    without one of the ``keys``. They are kept as JSON with the reason and, where it is known,
    their file. Rows are read twice: once for what is set aside, once for the load.
    """
    have = {c.lower(): c for c in df.columns}
    reasons = []
    if BROKEN in df.columns:
        reasons.append(F.when(F.col(BROKEN).isNotNull(), "broken row"))
    for f in schema.fields:
        if f.name.lower() in have:
            value = F.col(f"`{have[f.name.lower()]}`")
            unfit = value.isNotNull() & value.try_cast(f.dataType).isNull()
            reasons.append(F.when(unfit, f"{f.name} is not {f.dataType.simpleString()}"))
    for key in keys:
        reasons.append(F.when(F.col(f"`{have[key.lower()]}`").isNull(), f"no {key}"))
    marked = df.withColumn("_reason", F.coalesce(*reasons, F.lit(None).cast("string")))
    bad = marked.where(F.col("_reason").isNotNull())
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in (BROKEN, FILE)]
    raw = F.coalesce(F.col(BROKEN), F.to_json(F.struct(*text))) if BROKEN in df.columns else F.to_json(F.struct(*text))
    file = F.col(FILE) if FILE in df.columns else F.lit(None).cast("string")
    bad.select("_reason", raw.alias("row"), file.alias("file")).toDF(*ASIDE.fieldNames()).write.mode(
        "append"
    ).json(aside)
    n = df.sparkSession.read.schema(ASIDE).json(aside).count()
    good = marked.where(F.col("_reason").isNull()).drop("_reason", BROKEN, FILE)
    return conform(good, schema), n


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in the target's order and types; a column the target lacks is an error.

    Loads let the target grow first, so that it lacks none.
    """
    have = {c.lower(): c for c in df.columns}
    extra = set(have) - {f.name.lower() for f in schema.fields}
    if extra:
        raise ValueError(f"columns not in the target: {', '.join(sorted(extra))}")

    def column(f: T.StructField) -> str:
        source = have.get(f.name.lower())
        value = "NULL" if source is None else f"`{source}`"
        return f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`"

    return df.selectExpr(*[column(f) for f in schema.fields])


# creating ----------------------------------------------------------------------------------


def create_if_missing(
    spark: SparkSession, target: str, schema: T.StructType, piece_by: str | None = None
) -> tuple[bool, int]:
    """Whether the table was there, and its rows before; an absent one is created empty.

    A table that is there takes in the schema's columns and wider types.
    """
    table = Target(spark, target)
    _, there = table.ensure(schema, piece_by)
    return there, sum(table.sizes().values()) if there else 0


def metadata_layout(kind: str, found: T.StructType | None = None) -> T.StructType:
    """The fixed columns of ``columns`` or ``primary_keys``, and those of ``found`` beside them."""
    fixed = {"columns": CATALOG_COLUMNS, "primary_keys": PRIMARY_KEYS}[kind]
    known = {f.name.lower() for f in fixed.fields}
    more = [f for f in (found.fields if found else []) if f.name.lower() not in known]
    return T.StructType([*fixed.fields, *[T.StructField(f.name.lower(), f.dataType) for f in more]])


def create_if_missing_metadata(
    spark: SparkSession, target: str, kind: str, found: T.StructType | None = None
) -> tuple[bool, int]:
    """As above with the layout of ``columns`` or ``primary_keys``, extended by an extract's columns."""
    piece_by = {"columns": "slice", "primary_keys": None}[kind]
    return create_if_missing(spark, target, metadata_layout(kind, found), piece_by)


def _open(df: DataFrame, target: str, piece_by: str | None) -> tuple[Target, Layout, dict[str, int]]:
    """The table with the frame's columns, and the rows of its pieces."""
    table = Target(df.sparkSession, target)
    layout, there = table.ensure(df.schema, piece_by)
    return table, layout, table.sizes() if there else {}


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return Target(spark, target).read()


# loading -----------------------------------------------------------------------------------


def _rows(sizes: dict[str, int]) -> int:
    return sum(sizes.values())


def replace_load(
    staged: DataFrame, target: str, piece_by: str | None = None, clear_when_empty: bool = False
) -> LoadResult:
    """The staged rows become the table. Without any row the table stays as it was.

    Pieces are replaced when the job commits; those the stage has no row of are removed after it.
    """
    table, layout, before = _open(staged, target, piece_by)
    rows = conform(staged, layout.struct)
    written = table.overwrite(rows, layout, set())
    if written or clear_when_empty:
        for piece in sorted(set(before) - written):
            table.remove(piece)
    after = _rows(table.sizes())
    return LoadResult(target, _rows(before), after, after if written else 0)


def append_load(staged: DataFrame, target: str, piece_by: str | None = None) -> LoadResult:
    """Adds the staged rows; what is there is neither read nor written again."""
    table, layout, before = _open(staged, target, piece_by)
    table.append(conform(staged, layout.struct), layout)
    after = _rows(table.sizes())
    return LoadResult(target, _rows(before), after, after - _rows(before))


def windowed_replace_load(
    source: DataFrame,
    windows: DataFrame,
    target: str,
    updated: str = "last_update_date",
    truncate: bool = True,
    piece_by: str | None = None,
) -> LoadResult:
    """All windows in one pass over the source; the table is emptied first, once.

    ``truncate=False`` keeps the earlier rows, for manual reloads of a date range.
    """
    rows = assign_window(source, windows, updated).drop("window_id")
    if truncate:
        return replace_load(rows, target, piece_by, clear_when_empty=True)
    return append_load(rows, target, piece_by)


def upsert_load(
    staged: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    piece_by: str | None = None,
    order_only: Sequence[str] = (),
    newer_by: Sequence[str] = (),
) -> LoadResult:
    """Rows whose key is staged are replaced, others are kept, new ones are added.

    The stage is reduced to one row per key (the greatest by ``order_by``; columns in
    ``order_only`` serve that and are not loaded) and written once. Only pieces that hold a staged
    key, or get a staged row, are read whole and written again, in one job: its commit puts all of
    them in place. With ``newer_by``, a staged row older than the target's by these columns is
    not loaded. Loading the same stage again changes nothing.
    """
    spark = staged.sparkSession
    table, layout, before = _open(staged.drop(*order_only), target, piece_by)
    reduced = work_path(spark, "stage")
    latest = keep_latest(staged, keys, order_by).drop(*order_only)
    try:
        conform(latest, layout.struct).write.parquet(reduced)
        stage = spark.read.schema(layout.struct).parquet(reduced)
        processed = stage.count()
        if not processed:
            return LoadResult(target, _rows(before), _rows(before), 0)
        touched = _touched_pieces(table, layout, set(before), stage, keys)
        old = table.read(layout, touched)
        if newer_by:
            stage = rows_without_match(stage, _older(stage, old, keys, newer_by), keys)
        fresh = rows_without_match(old, stage, keys).unionByName(stage)
        # a piece whose rows have all moved to others is removed
        table.overwrite(fresh, layout, touched)
    finally:
        drop_path(spark, reduced)
    return LoadResult(target, _rows(before), _rows(table.sizes()), processed)


def _older(
    stage: DataFrame, old: DataFrame, keys: Sequence[str], newer_by: Sequence[str]
) -> DataFrame:
    """Keys of staged rows that the target has in a newer version."""
    held = old.select(
        *[F.col(f"`{k}`").alias(f"_key_{k}") for k in keys],
        F.struct(*[F.col(f"`{c}`") for c in newer_by]).alias("_held"),
    )
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_key_{k}`")) for k in keys]
    return (
        stage.join(held, reduce(lambda a, b: a & b, same))
        .where(F.struct(*[F.col(f"`{c}`") for c in newer_by]) < F.col("_held"))
        .select(*[F.col(f"`{k}`") for k in keys])
    )


def _touched_pieces(
    table: Target, layout: Layout, present: set[str], stage: DataFrame, keys: Sequence[str]
) -> set[str]:
    """Pieces that hold a staged key or get a staged row; at most one row per piece comes back.

    Where the piece names no column beside the key, the stage alone tells and the target is not
    read. Otherwise its key columns are, where they lie within the staged keys' range, which files
    sorted or cut along the key are skipped by.
    """
    if layout.piece_by is None or not present:
        return present
    held = stage.select(piece_column(layout.piece_by).alias(PIECE))
    others = {c.lower() for c in stage.columns} - {k.lower() for k in keys}
    if any(_names(layout.piece_by, c) for c in others):
        rows = table.read(layout)
        low, high = stage.agg(F.min(f"`{keys[0]}`"), F.max(f"`{keys[0]}`")).first()
        if low is not None:
            key = F.col(f"`{keys[0]}`")
            rows = rows.where(key.between(F.lit(low), F.lit(high)) | key.isNull())
        # the match comes first: the piece is worked out for matched rows only
        matched = rows_with_match(rows, stage, keys)
        held = held.unionByName(matched.select(piece_column(layout.piece_by).alias(PIECE)))
    return present & {r[0] for r in held.distinct().collect()}


def _names(sql: str, column: str) -> bool:
    return re.search(rf"(?<!\w){re.escape(column)}(?!\w)", sql.lower()) is not None


def overwrite_pieces(staged: DataFrame, target: str, piece_by: str) -> LoadResult:
    """Replaces the pieces that occur in the stage and keeps the others."""
    table, layout, before = _open(staged, target, piece_by)
    written = table.overwrite(conform(staged, layout.struct), layout, set())
    after = table.sizes()
    return LoadResult(target, _rows(before), _rows(after), sum(after.get(p, 0) for p in written))


def freeform_load(staged: DataFrame, target: str, truncate: bool) -> LoadResult:
    """Creates the table from the extract's columns if needed; then replaces or appends."""
    return (replace_load if truncate else append_load)(staged, target)


def metadata_cols_load(
    columns: DataFrame,
    target: str,
    owner: str | None,
    text_type: str = "VARCHAR2",
    return_fields: str | None = None,
) -> LoadResult:
    """Both slices of the column catalog in one pass and one write."""
    found = catalog_extract(columns, owner, text_type, return_fields)
    return metadata_load(found, target, "columns")


def catalog_extract(
    columns: DataFrame,
    owner: str | None,
    text_type: str = "VARCHAR2",
    return_fields: str | None = None,
) -> DataFrame:
    """Both slices with the fixed columns, whatever the case of their names, and ``return_fields``."""
    both = catalog_slice(columns, owner, None, text_type)
    if return_fields:
        return scan_projected(both, f"{return_fields}, slice")
    have = {c.lower(): c for c in both.columns}
    lacking = [f.name for f in CATALOG_COLUMNS.fields if f.name not in have]
    if lacking:
        raise ValueError(f"the catalog lacks: {', '.join(lacking)}")
    return both.select(*[F.col(f"`{have[f.name]}`").alias(f.name) for f in CATALOG_COLUMNS.fields])


def metadata_load(staged: DataFrame, target: str, kind: str) -> LoadResult:
    """Replaces a metadata target, which is made from the fixed layout and the stage's columns."""
    create_if_missing_metadata(staged.sparkSession, target, kind, staged.schema)
    return replace_load(staged, target, clear_when_empty=True)


def metadata_primarykeys_load(
    constraints: DataFrame, cons_columns: DataFrame, target: str, owner: str
) -> LoadResult:
    return metadata_load(primary_keys(constraints, cons_columns, owner), target, "primary_keys")


def release_snapshot(staged: DataFrame, target: str, release: str) -> LoadResult:
    """Keeps one copy per release: this release's rows are replaced, the others stay."""
    return overwrite_pieces(staged.withColumn("release", F.lit(release)), target, "release")
