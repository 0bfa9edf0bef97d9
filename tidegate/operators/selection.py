"""Which control rows a run takes, in which order, to which target and raw-zone folder."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.dates import DAY

# Load types, schedules and raw-zone classes.
REGULAR_TYPES = ("CDC", "Full", "Validation", "Special_Full", "Special_CDC", "MetaData")
SCHEDULED_TYPES = ("Full", "Special_Full")
METADATA_TYPES = ("MetaData_Cols", "MetaData_primarykeys")
FREEFORM_TYPE = "FreeForm"
SCHEDULES = ("true", "Full", "Batches", "Manual")
CHANGE_TYPES = ("CDC", "Special_CDC")
ALL = "All"
ZONE_FULL, ZONE_CHANGES, ZONE_VALIDATION, ZONE_METADATA = (
    "FullTableLoads",
    "CDC",
    "Validation",
    "MetaData",
)


def _daily() -> Column:
    return F.col("frequency") == "Daily"


def select_regular(control: DataFrame) -> DataFrame:
    return control.filter(
        _daily()
        & F.col("active")
        & F.col("created")
        & F.col("load_type").isin(*REGULAR_TYPES)
        & (F.col("schedule") == "false")
    )


def select_batched(control: DataFrame) -> DataFrame:
    return select_regular(control).filter(F.col("batched"))


def select_scheduled(control: DataFrame) -> DataFrame:
    return control.filter(
        _daily()
        & F.col("active")
        & F.col("created")
        & F.col("load_type").isin(*SCHEDULED_TYPES)
        & F.col("schedule").isin(*SCHEDULES)
    )


def select_metadata(control: DataFrame) -> DataFrame:
    """No frequency test: metadata is loaded whenever it is asked for."""
    return control.filter(
        F.col("active") & F.col("created") & F.col("load_type").isin(*METADATA_TYPES)
    )


def select_freeform(control: DataFrame) -> DataFrame:
    """No test of created or schedule: the load creates its own target."""
    return control.filter(_daily() & F.col("active") & (F.col("load_type") == FREEFORM_TYPE))


def select_snapshot(control: DataFrame) -> DataFrame:
    return control.filter(_daily() & F.col("active") & F.col("created"))


def apply_run_args(
    control: DataFrame, priority: int | str | None = None, instance: str | None = None
) -> DataFrame:
    """Restricts a run to one priority and one instance; None and ``All`` take every row."""
    if priority not in (None, ALL):
        control = control.filter(F.col("priority") == int(priority))
    if instance not in (None, ALL):
        control = control.filter(F.col("instance") == instance)
    return control


def once_per_day_gate(control: DataFrame, as_of: date) -> DataFrame:
    """Rows not loaded yet on ``as_of``. A blank or missing stamp means "run"."""
    loaded_on = F.substring(F.col("last_update_date"), 1, 10)
    return control.filter(~loaded_on.eqNullSafe(F.lit(as_of.isoformat())))


def route(control: DataFrame) -> DataFrame:
    """``batched`` for full loads to be split by date, ``regular`` for everything else."""
    split = F.coalesce(F.col("batched") & (F.col("load_type") == "Full"), F.lit(False))
    return control.withColumn("route", F.when(split, "batched").otherwise("regular"))


def resolve_target(control: DataFrame, instance_arg: str = ALL, release: str = "") -> DataFrame:
    """Target table name: the alternate one for validations, one per release for metadata."""
    kind = F.col("load_type")
    return control.withColumn(
        "target_table",
        F.when(kind == "Validation", F.col("validation_table"))
        .when(
            kind.isin("MetaData", *METADATA_TYPES),
            F.concat_ws("_", "source_table", F.lit(instance_arg), F.lit(release)),
        )
        .otherwise(F.col("source_table")),
    )


def raw_prefix(control: DataFrame, as_of: date, root: str = "") -> DataFrame:
    """Raw-zone folder: class, table, year, month, day."""
    kind = F.col("load_type")
    zone = (
        F.when(kind.isin(*CHANGE_TYPES), ZONE_CHANGES)
        .when(kind == "Validation", ZONE_VALIDATION)
        .when(kind.isin("MetaData", *METADATA_TYPES), ZONE_METADATA)
        .otherwise(ZONE_FULL)
    )
    dated = F.date_format(F.lit(as_of), DAY.replace("-", "/"))
    base = root.rstrip("/") + "/" if root else ""
    return control.withColumn(
        "raw_prefix",
        F.concat(F.lit(base), zone, F.lit("/"), "source_table", F.lit("/"), dated, F.lit("/")),
    )


def order_work(control: DataFrame) -> DataFrame:
    """Ascending priority and sort order, rows without them last; the key breaks ties."""
    return control.orderBy(
        F.col("priority").asc_nulls_last(), F.col("sort_order").asc_nulls_last(), "table_uid"
    )
