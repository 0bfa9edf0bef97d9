"""Fixed schemas: control table, load statistics, catalogs, windows and run results."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _B, _L, _I, _D, _TS = (
    T.StringType(),
    T.BooleanType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.TimestampNTZType(),
)

# One row per source table. ``table_uid`` is the key.
CONTROL = _struct(
    table_uid=_S,
    source_table=_S,
    target_schema=_S,
    frequency=_S,
    active=_B,
    created=_B,
    load_type=_S,
    schedule=_S,
    batched=_B,
    priority=_I,
    sort_order=_I,
    instance=_S,
    primary_key=_S,
    return_fields=_S,
    promote=_B,
    has_update_date=_B,
    last_update_date=_S,
    validation_table=_S,
    schedule_truncate=_B,
    schedule_begin=_D,
    schedule_end=_D,
    freeform_sql=_S,
    freeform_truncate=_B,
    source_row_count=_L,
    target_row_count=_L,
    extract_error=_S,
    counted_at=_S,
    min_update_date=_S,
    max_update_date=_S,
    zero_rows=_B,
    load_error=_B,
    load_error_message=_S,
    inserted_rows=_L,
    updated_rows=_L,
)

# One row per extracted file. ``file_name`` is the key; everything is text.
LOAD_STATS = _struct(
    **{
        name: _S
        for name in (
            "file_name project feed year month day source_rows target_rows processed_rows "
            "inserted_rows updated_rows extract_start extract_end load_start load_end "
            "extract_status load_status zone target_schema table_uid target_table "
            "extract_failure load_failure"
        ).split()
    }
)

CONSTRAINTS = _struct(owner=_S, constraint_name=_S, constraint_type=_S, status=_S)

CONSTRAINT_COLUMNS = _struct(
    owner=_S, constraint_name=_S, table_name=_S, column_name=_S, position=_I
)

# Layout of the per-release copies of the column catalog and of the primary keys.
CATALOG_COLUMNS = _struct(owner=_S, table_name=_S, column_name=_S, data_type=_S, slice=_I)

PRIMARY_KEYS = _struct(table_name=_S, column_name=_S, position=_I, status=_S, owner=_S)

WINDOWS = _struct(window_id=_S, grain=_S, begin_date=_D, end_date=_D)

# Progress of a load split by date, one row per window.
WINDOW_STATUS = _struct(
    table_uid=_S,
    loaded_at=_S,
    window_id=_S,
    begin_date=_D,
    end_date=_D,
    row_count=_L,
    target_row_count=_L,
    zero_rows=_B,
)

# What one load reports; the reconciliation operators work on frames of these.
RUN_RESULT = _struct(
    table_uid=_S,
    load_type=_S,
    outcome=_S,  # loaded | empty | extract_failed
    source_count=_L,
    min_update_date=_S,
    max_update_date=_S,
    rows_before=_L,
    rows_after=_L,
    processed=_L,
    load_error=_B,
    load_error_message=_S,
    extract_error=_S,
    promote=_B,
    prior_update_date=_S,
    finished_at=_S,
    count_failed=_B,  # the source count is unknown, not 0
)

# Results as runs record them, one row per table and load; control and statistics are read from them.
RUN_JOURNAL = T.StructType(
    [
        *RUN_RESULT.fields,
        *_struct(
            file_name=_S, scheduled=_B, extract_start=_S, extract_end=_S, left_out=_L,
            set_aside=_L,  # rows that did not fit the target
            content_differs=_B,  # source and target were compared row by row, and differ
            differing=_S,  # in these months or, without a date, somewhere
            day=_S,
        ).fields,
    ]
)

# A fact about control rows: what the named fields are from a time on.
CONTROL_FACTS = T.StructType(
    [
        *CONTROL.fields,
        T.StructField("fields", T.ArrayType(_S, False)),
        *_struct(at=_S, edited=_B).fields,
    ]
)
