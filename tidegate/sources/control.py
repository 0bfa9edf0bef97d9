"""The control table: read from text, flags parsed once at the edge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegate.schemas import CONTROL
from tidegate.sources.landing import CSV_OPTIONS, text_schema

# Field names of an existing control store. Pass them as ``field_names``, with the
# names of the remaining fields added, to read its items.
STORE_FIELD_NAMES = {
    "table_uid": "TableName",
    "source_table": "TableName1",
    "target_schema": "SchemaName",
    "frequency": "Frequency",
    "active": "ActiveDownloadFlag",
    "created": "TableCreatedFlag",
    "load_type": "DailyLoadType",
    "schedule": "Schedule",
    "batched": "BatchesFlag",
    "priority": "priority",
    "sort_order": "sortOrder",
    "primary_key": "primarykey",
    "return_fields": "returnFields",
    "promote": "FullToCDCFlag",
    "has_update_date": "LUD_InTable_Flag",
    "last_update_date": "LastUpdateDate",
    "schedule_truncate": "ScheduleTruncateFlag",
    "schedule_begin": "ScheduleBeginDate",
    "schedule_end": "ScheduleEndDate",
    "freeform_sql": "zzFreeFormSQL",
    "freeform_truncate": "zzFreeformTruncateFlag",
    "source_row_count": "SourceRowCount",
    "counted_at": "SourceRecCNTUpdateDate",
    "min_update_date": "minLUD",
    "max_update_date": "maxLUD",
    "zero_rows": "ZeroRowsReturned",
}

# Flags are the strings 'true' and 'false'. Anything but 'true' is off, except that a table has
# an update date unless told otherwise.
_ON_UNLESS_FALSE = {"has_update_date"}


# Without these no row can be selected; a row without its target's names fails when it is loaded.
REQUIRED = ("table_uid", "source_table", "load_type")


def _require(present: set[str], names: Mapping[str, str]) -> None:
    """Fails where a required field has no source; an empty store has no columns and is fine."""
    lacking = [f for f in REQUIRED if names.get(f, f) not in present]
    if present and lacking:
        told = ", ".join(f"{f} (from {names.get(f, f)})" for f in lacking)
        raise ValueError(f"the control store lacks: {told}")


def parse_control(raw: DataFrame, field_names: Mapping[str, str] | None = None) -> DataFrame:
    """Text control items with the fixed schema.

    ``field_names`` maps our field to the caller's where they differ; missing fields are NULL.
    """
    names = dict(field_names or {})
    present = set(raw.columns)

    def column(field: T.StructField) -> str:
        source = names.get(field.name, field.name)
        value = f"CAST(`{source}` AS STRING)" if source in present else "CAST(NULL AS STRING)"
        kind = field.dataType.simpleString()
        if field.name in _ON_UNLESS_FALSE:
            value = f"coalesce({value} <> 'false', true)"
        elif kind == "boolean":
            value = f"coalesce({value} = 'true', false)"
        elif kind != "string":
            value = f"CAST(nullif({value}, '') AS {kind})"
        return f"{value} AS {field.name}"

    return raw.selectExpr(*[column(f) for f in CONTROL.fields])


def read_control(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    field_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """All control items, whatever their number, from an export of the control store."""
    names = dict(field_names or {})
    if fmt in ("json", "csv"):
        schema = text_schema(list(dict.fromkeys(names.get(f.name, f.name) for f in CONTROL.fields)))
        reader = spark.read.format(fmt)
        if fmt == "json":
            _require(set(spark.read.json(path).columns), names)
            reader = reader.schema(schema)
        else:
            reader = reader.options(**CSV_OPTIONS)
        raw = reader.load(path)
    elif fmt == "table":
        raw = spark.table(path)
    else:
        raw = spark.read.format(fmt).load(path)
    if fmt != "json":
        _require(set(raw.columns), names)
    return parse_control(raw, names)
