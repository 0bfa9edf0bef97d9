"""The five flows of a run: regular, batched, scheduled, metadata and free-form loads.

Only the work list (one row per table to load) and one result per table come to the driver; rows
of source and target tables stay in Spark jobs.

State is a set of facts that are only ever added: edits of the control table, files entered when a flow
starts, and one result per table and load, recorded as it is done. Control and statistics are
folds of these: each control field has the value of its latest fact. So runs beside each other, a
run that died, or a result recorded twice cannot undo anything, and what a flow writes does not
depend on how much there is already.

A source that could not be counted is not an empty one: loads that are split or empty their table
by date end as failed extracts, others go on but are never promoted. Nor is a source empty of whose
counted rows none is staged.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import content
from tidegate.operators import counts as C
from tidegate.operators import reconcile as R
from tidegate.operators import selection as sel
from tidegate.operators import windows as win
from tidegate.operators.joins import assign_window, keep_latest, parse_keys, primary_keys
from tidegate.functions.dates import trunc_day
from tidegate.functions.clean import NA_TOKENS, all_text, na_tokens_to_null, strip_null_text
from tidegate.operators.slices import CREATED, UPDATED, cdc_day_slice, owner_filter
from tidegate.plans import loads
from tidegate.plans.tables import Target, grown
from tidegate.schemas import CONTROL, CONTROL_FACTS, LOAD_STATS, RUN_JOURNAL, WINDOW_STATUS
from tidegate.session import drop_path, path_exists, small_frame, work_path
from tidegate.sources.tables import scan_freeform, scan_projected

# Rows of one window, and its staged bytes (fixed value).
WINDOW_LIMITS = {"row_count": 5_000_000, "byte_count": 1_073_741_824}
STAMP = "%Y-%m-%d %H:%M:%S"
_SCHEDULED = T.StructType(
    [
        CONTROL["table_uid"],
        CONTROL["schedule"],
        CONTROL["schedule_begin"],
        CONTROL["schedule_end"],
        T.StructField("min_update_date", T.TimestampNTZType()),
        T.StructField("max_update_date", T.TimestampNTZType()),
    ]
)
PRIMARY_KEYS_TABLE = "primarykeys"  # fixed value: the control row that loads key columns


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class IngestRun:
    """One run's settings. ``read`` gives the source table of a name as a DataFrame."""

    spark: SparkSession
    read: Callable[[str], DataFrame]
    control_path: str
    stats_path: str
    raw_root: str
    target_root: str
    as_of: date
    priority: int | str | None = None
    instance: str | None = None
    release: str = ""
    owner: str | None = None
    lag: int = 1
    since: date | None = None
    # what bounds a window of a split load: staged bytes (reads every column) or rows (reads the
    # date column only), and how many; None takes the value in WINDOW_LIMITS
    window_cost: str = "byte_count"
    window_limit: int | None = None
    clock: Callable[[], datetime] = _utc_now
    project: str = ""
    # target table name -> SQL expression that cuts it into pieces, "*" for all others that have
    # its columns; a change load rewrites only the pieces it touches, an uncut target as a whole
    pieces: dict[str, str] | None = None
    # spellings of a missing value, and whether the letters null are deleted inside values
    na_tokens: tuple[str, ...] = NA_TOKENS
    strip_null: bool = False
    # rows of a split or scheduled load that no date window covers: reported, loaded beside the
    # windows, or a failure of the load
    remainder: str = "report"
    # tables loaded at the same time; those of one target always follow each other
    parallel: int = 1
    # folder for rows that do not fit their target; without one they fail the load
    aside_root: str | None = None
    # compare full loads with their source row by row, by digests; where they differ there is no promotion
    compare_content: bool = False
    # frames that free-form queries may name beside the session's tables
    tables: dict[str, DataFrame] | None = None
    # folder for the exported statistics items of free-form loads
    stats_export: str | None = None

    # tables of the run ---------------------------------------------------------------------

    def control(self) -> DataFrame:
        """The control table: of each field, the latest of edits and results."""
        edits = _facts(self.spark, f"{self.control_path}/edits", CONTROL_FACTS)
        return R.fold_control(edits.unionByName(R.result_facts(self.results())))

    def results(self) -> DataFrame:
        """What loads have recorded, each once."""
        return _facts(self.spark, self.results_path, RUN_JOURNAL).dropDuplicates(["file_name", "table_uid"])

    def stats(self) -> DataFrame:
        """The statistics: files as they were entered, moved on by what happened to them."""
        entered = _facts(self.spark, self.entered_path, LOAD_STATS)
        first = R.stats_put_if_absent(entered.limit(0), entered)
        ended = keep_latest(self.results(), ["file_name"], ["finished_at"])
        left = ended.select(
            F.col("file_name").alias("_ended"), F.col("left_out").cast("string").alias("left_out_rows")
        )
        moved = R.stats_transition(first, _happened(ended))
        return moved.join(left, F.col("file_name") == F.col("_ended"), "left").drop("_ended")

    @property
    def entered_path(self) -> str:
        """Files as flows enter them, by day."""
        return f"{self.stats_path}/entered"

    @property
    def results_path(self) -> str:
        """Results as loads record them, by day."""
        return f"{self.stats_path}/results"

    @property
    def windows_path(self) -> str:
        """Progress rows of loads split by date."""
        return f"{self.stats_path}_windows"

    def target_path(self, item: Row) -> str:
        if not item.target_schema or not item.target_table:
            raise ValueError(f"{item.table_uid}: no target schema or table name")
        return f"{self.target_root}/{item.target_schema}/{item.target_table}"

    def piece_by(self, item: Row, staged: DataFrame) -> str | None:
        declared = self.pieces or {}
        if item.target_table in declared:
            return declared[item.target_table]
        if "*" in declared:
            try:
                staged.selectExpr(declared["*"])
            except AnalysisException:
                return None  # a table without these columns
            return declared["*"]
        return None

    def now(self) -> str:
        return self.clock().strftime(STAMP)


def _facts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Facts that were added below a path; none where nothing was."""
    if not path_exists(spark, path):
        return small_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def _add(df: DataFrame, path: str, *days: str) -> None:
    df.write.mode("append").partitionBy(*days).parquet(path)


def start_control(spark: SparkSession, control: DataFrame, path: str) -> None:
    """Defines the control table by these rows (as ``read_control`` gives them), earlier than any result."""
    facts = R.as_facts(control, CONTROL.fieldNames(), F.lit(""), True)
    facts.write.mode("overwrite").parquet(f"{path}/edits")


def edit_control(run: IngestRun, changes: DataFrame, at: str | None = None) -> None:
    """Sets the columns of ``changes`` for its tables, from ``at`` on; a later result may set them again.

    A row with all control fields defines a new table.
    """
    fields = [c for c in changes.columns if c != "table_uid"]
    facts = R.as_facts(changes, fields, F.lit(at or run.now()), True)
    facts.write.mode("append").parquet(f"{run.control_path}/edits")


def tidy(run: IngestRun, day: date) -> None:
    """Puts the results and entered files of a day together in few files; what they say stays the same."""
    for path, schema, days in (
        (run.results_path, RUN_JOURNAL, ["day"]),
        (run.entered_path, LOAD_STATS, ["year", "month", "day"]),
    ):
        facts = _facts(run.spark, path, schema)
        values = {"year": f"{day:%Y}", "month": f"{day:%m}", "day": f"{day:%d}"}
        if days == ["day"]:
            values = {"day": f"{day:%Y-%m-%d}"}
        for name, value in values.items():
            facts = facts.where(F.col(name) == value)
        (
            facts.dropDuplicates().hint("rebalance")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*days).parquet(path)
        )


def work_list(run: IngestRun, selected: DataFrame) -> list[Row]:
    """The items to load, in order, with target and raw-zone folder; one row per table."""
    due = sel.once_per_day_gate(sel.apply_run_args(selected, run.priority, run.instance), run.as_of)
    named = sel.raw_prefix(
        sel.resolve_target(due, run.instance or sel.ALL, run.release), run.as_of
    )
    return sel.order_work(named).collect()


# one table ---------------------------------------------------------------------------------


def _text(value) -> str | None:
    return None if value is None else str(value)


def _stamps(counted: DataFrame) -> tuple[int, object, object]:
    """Counts as driver values; dates of any type as zone-less time stamps."""
    return tuple(
        counted.selectExpr(
            "row_count",
            "CAST(min_update_date AS timestamp_ntz)",
            "CAST(max_update_date AS timestamp_ntz)",
        ).first()
    )


def _count(run: IngestRun, item: Row) -> tuple[int, object, object]:
    """Rows, earliest and latest update."""
    df = run.read(item.source_table)
    if not item.has_update_date:
        owner = run.owner if item.load_type == "MetaData" else None
        return _stamps(C.record_counts_no_lud(df, owner))
    if item.load_type == "CDC":
        return _stamps(C.record_counts_cdc(df, run.as_of, run.lag))
    return _stamps(C.record_counts(df))


def _extract(run: IngestRun, item: Row, df: DataFrame) -> DataFrame:
    """The rows a load type takes from its source."""
    if item.load_type in sel.CHANGE_TYPES:
        df = cdc_day_slice(df, run.as_of, run.lag, run.since)
    if item.load_type == "MetaData" and run.owner is not None:
        df = owner_filter(df, run.owner)
    if item.load_type in ("Validation", "Special_Full", "Special_CDC", "MetaData"):
        df = scan_projected(df, item.return_fields)
    return df


def _load(run: IngestRun, item: Row, staged: DataFrame) -> loads.LoadResult:
    target, piece_by = run.target_path(item), run.piece_by(item, staged)
    if item.load_type in sel.CHANGE_TYPES:
        newest = [c for c in (UPDATED, CREATED) if c in [n.lower() for n in staged.columns]]
        return loads.upsert_load(staged, target, parse_keys(item.primary_key), newest, piece_by)
    if item.load_type == sel.FREEFORM_TYPE:
        return loads.freeform_load(staged, target, item.freeform_truncate)
    if item.load_type == "MetaData":
        return loads.metadata_load(staged, target, "columns")
    return loads.replace_load(staged, target, piece_by)


def _first_line(error: Exception) -> str:
    return str(error).split("\n")[0]


def _blank(item: Row, counted: tuple, count_error: str | None) -> dict:
    return {
        "table_uid": item.table_uid,
        "load_type": item.load_type,
        "outcome": "loaded",
        "source_count": counted[0],
        "min_update_date": _text(counted[1]),
        "max_update_date": _text(counted[2]),
        "rows_before": 0,
        "rows_after": 0,
        "processed": 0,
        "load_error": False,
        "load_error_message": "",
        "extract_error": "",
        "promote": item.promote,
        "prior_update_date": item.last_update_date,
        "count_failed": count_error is not None,
    }


def _stage(
    run: IngestRun, item: Row, name: str, extract: DataFrame, window: str | None = None
) -> DataFrame:
    """Stages an extract and returns it read back, typed as the extract was."""
    keys = parse_keys(item.primary_key) if (item.primary_key or "").strip(" ,") else []
    path = loads.stage_raw(
        extract, run.raw_root, item.raw_prefix, name, window, run.strip_null,
        tokens=run.na_tokens, keys=keys,
    )
    schema = extract.drop(window).schema if window else extract.schema
    # what was cleaned before it was written has one spelling of missing left
    return loads.read_staged(run.spark, path, schema, window, tokens=("",), keys=keys)


def _fitting(run: IngestRun, item: Row, staged: DataFrame) -> tuple[DataFrame, int]:
    """The staged rows that fit the target there is, and how many were set aside."""
    layout = Target(run.spark, run.target_path(item)).layout()
    if layout is None:
        return staged, 0
    fields = [f for f in grown(layout.struct, staged.schema).fields if f.name.lower() in
              {c.lower() for c in staged.columns}]
    keys = parse_keys(item.primary_key) if item.load_type in sel.CHANGE_TYPES else []
    aside = f"{run.aside_root.rstrip('/')}/{item.table_uid}/{run.clock():%Y%m%d%H%M%S%f}"
    return loads.set_aside(staged, T.StructType(fields), aside, keys)


def _compared(run: IngestRun, item: Row, staged: DataFrame) -> dict:
    """Whether the target holds the source's rows as they are to be loaded, by digests of each month."""
    target = loads.read_target(run.spark, run.target_path(item))
    keys = parse_keys(item.primary_key) if (item.primary_key or "").strip(" ,") else []
    text = all_text(_extract(run, item, run.read(item.source_table)))
    text = strip_null_text(text) if run.strip_null else text
    cleaned = [c for c in text.columns if c.lower() not in {k.lower() for k in keys}]
    text = na_tokens_to_null(text, cleaned, ("", *run.na_tokens))
    source = loads.conform(text, target.schema)
    dated = UPDATED in [c.lower() for c in target.columns]
    month = F.date_format(F.col(UPDATED), "yyyy-MM") if dated else F.lit("all")
    odd = content.differing_groups(*[content.digests(df, month) for df in (source, target)])
    groups = sorted(r["group"] or "undated" for r in odd.collect())  # one row per month
    return {"content_differs": bool(groups), "differing": ", ".join(groups)}


def _announce(run: IngestRun, items: list[Row]) -> dict[str, str]:
    """Enters the files of a work list in the statistics, in progress; gives their names."""
    stamp = f"{run.clock():%Y%m%d%H%M%S%f}"
    names = {i.table_uid: f"{i.source_table}_{stamp}_{i.table_uid}" for i in items}
    new = [
        {
            "file_name": names[item.table_uid],
            "project": run.project,
            "feed": item.source_table,
            "year": f"{run.as_of:%Y}",
            "month": f"{run.as_of:%m}",
            "day": f"{run.as_of:%d}",
            "zone": item.raw_prefix,
            "target_schema": item.target_schema,
            "table_uid": item.table_uid,
            "target_table": item.target_table,
        }
        for item in items
    ]
    _add(small_frame(run.spark, new, LOAD_STATS), run.entered_path, "year", "month", "day")
    return names


@dataclass
class Steps:
    """How one table is counted, extracted and staged, and loaded."""

    count: Callable[[], tuple]
    extract: Callable[[tuple], DataFrame]
    load: Callable[[DataFrame], loads.LoadResult]
    needs_count: bool = False  # without it the extract would be a wrong one
    clean_up: Callable[[], None] = lambda: None


def _load_one(run: IngestRun, item: Row, steps: Steps, empty_is_loaded: bool) -> dict:
    """Counts, extracts, stages and loads one table.

    A failure of one step is recorded, not raised. Loads leave the table alone when nothing was
    staged, unless ``empty_is_loaded``: those that empty their table first.
    """
    started, counted, count_error = run.now(), (0, None, None), None
    try:
        run.target_path(item)
        counted = steps.count()
    except Exception as error:
        count_error = _first_line(error)
    result = {**_blank(item, counted, count_error), "extract_start": started}
    try:
        run.target_path(item)
        if steps.needs_count and count_error is not None:
            raise RuntimeError(f"the source could not be counted: {count_error}")
        staged = steps.extract(counted)
        if steps.needs_count and counted[0] and staged.isEmpty():
            raise ValueError(f"none of {counted[0]} source rows is in a date window")
    except Exception as error:
        result.update(outcome="extract_failed", extract_error=_first_line(error))
    result["extract_end"] = run.now()
    if result["outcome"] == "loaded":
        try:
            if run.aside_root:
                staged, result["set_aside"] = _fitting(run, item, staged)
            done = steps.load(staged)
            if run.compare_content and item.load_type in R.PROMOTIONS:
                result.update(_compared(run, item, staged))
            result.update(
                rows_before=done.rows_before, rows_after=done.rows_after, processed=done.processed
            )
            if steps.needs_count:
                # rows without a date, or outside all windows
                result["left_out"] = max(result["source_count"] - done.processed, 0)
            if not done.processed and not empty_is_loaded:
                result["outcome"] = "empty"
        except Exception as error:
            result.update(load_error=True, load_error_message=_first_line(error))
            result.update(source_count=0, rows_before=0, rows_after=0, processed=0)
    steps.clean_up()
    return {**result, "finished_at": run.now()}


def _record(run: IngestRun, result: dict, scheduled: bool) -> None:
    """Adds one table's result to the facts."""
    row = {f: result.get(f) for f in RUN_JOURNAL.fieldNames()}
    row |= {"scheduled": scheduled, "day": f"{run.as_of:%Y-%m-%d}"}
    _add(small_frame(run.spark, [row], RUN_JOURNAL), run.results_path, "day")


def _happened(results: DataFrame) -> DataFrame:
    """Results as the statistics take them."""
    return R.load_tally(results).select(
        "file_name",
        "outcome",
        F.col("source_count").alias("source_rows"),
        F.col("rows_after").alias("target_rows"),
        "inserted_rows",
        "updated_rows",
        "load_error",
        "load_error_message",
        "extract_error",
        "extract_start",
        "extract_end",
        F.col("finished_at").alias("load_end"),
    )


def _run_items(
    run: IngestRun,
    items: list[Row],
    steps: Callable[[Row, str], Steps],
    scheduled: bool = False,
    empty_is_loaded: bool = False,
) -> list[dict]:
    """Loads the listed tables in order, ``run.parallel`` at a time.

    Results are recorded here, by one thread, as each table is done.
    """
    if not items:
        return []
    names = _announce(run, items)

    def one(item: Row) -> dict:
        name = names[item.table_uid]
        return {**_load_one(run, item, steps(item, name), empty_is_loaded), "file_name": name}

    def one_target(group: list[Row]) -> list[dict]:
        return [one(item) for item in group]

    done = []
    if run.parallel <= 1:
        for item in items:
            done.append(one(item))
            _record(run, done[-1], scheduled)
    else:
        groups: dict[tuple, list[Row]] = {}
        for item in items:
            groups.setdefault((item.target_schema, item.target_table), []).append(item)
        with ThreadPoolExecutor(run.parallel) as pool:
            work = inheritable_thread_target(run.spark)(one_target)
            for ended in as_completed([pool.submit(work, group) for group in groups.values()]):
                for result in ended.result():
                    done.append(result)
                    _record(run, result, scheduled)
    return done


# the flows ---------------------------------------------------------------------------------


def run_regular(run: IngestRun) -> list[dict]:
    """Change, full, projected, validation and metadata loads that are not split by date."""
    routed = sel.route(sel.select_regular(run.control()))

    def steps(item: Row, name: str) -> Steps:
        def extract(_) -> DataFrame:
            return _stage(run, item, name, _extract(run, item, run.read(item.source_table)))

        return Steps(lambda: _count(run, item), extract, lambda staged: _load(run, item, staged))

    regular = routed.filter(F.col("route") == "regular").drop("route")
    return _run_items(run, work_list(run, regular), steps)


def _written_once(run: IngestRun, df: DataFrame, path: str) -> DataFrame:
    """Small results that are used more than once; read back, their size is known."""
    df.write.parquet(path)
    return run.spark.read.schema(df.schema).parquet(path)


def plan_windows(
    run: IngestRun, sizes: DataFrame, min_update_date, source: DataFrame | None = None
) -> DataFrame:
    """The window set of a full load, decided from measured sizes before any extract.

    With the ``source``, days beyond the limit are cut into time ranges.
    """
    span = T.StructType([T.StructField("min_update_date", T.TimestampNTZType())])
    first = small_frame(run.spark, [{"min_update_date": min_update_date}], span)
    months = win.month_windows(first, run.as_of)
    dated = sizes.filter(F.col("day").isNotNull())
    limit = run.window_limit or WINDOW_LIMITS[run.window_cost]
    windows = win.adaptive_windows(dated, months, limit, run.window_cost)
    return windows if source is None else win.split_days(source, windows, limit)


def _windowed(
    run: IngestRun, item: Row, name: str, windows: DataFrame, source_rows: int, whole: bool = True
) -> DataFrame:
    """Stages the rows of all windows in one pass over the days the windows span.

    No window for a source that has rows is a failure, never an empty extract. ``whole`` loads are
    to take every row: what no window covers is loaded or a failure where the run says so.
    """
    source = run.read(item.source_table)
    span = windows.agg(F.min("begin_date"), F.max("end_date")).first()
    if span[0] is None and source_rows:
        raise ValueError(f"no date window covers any of {source_rows} source rows")
    span = tuple(span) if span[0] is not None else None
    rest = run.remainder if whole else "report"
    if rest == "fail":
        left = R.remainder(C.measure_days(source, UPDATED), windows).agg(F.sum("row_count")).first()[0]
        if left:
            raise ValueError(f"no date window covers {left} of {source_rows} source rows")
    dated = assign_window(source, windows, UPDATED, span, remainder=rest == "load")
    if item.load_type == "Special_Full":
        dated = scan_projected(dated, f"{item.return_fields}, window_id")
    return _stage(run, item, name, dated, "window_id")


def _progress(run: IngestRun, item: Row, days: DataFrame, windows: DataFrame, name: str) -> DataFrame:
    """Progress of each window, from what was loaded, and of the rows that no window covers.

    The loaded rows' dates are read from the target's files, one column; where the select list left the
    date out, or days are cut into ranges, the staged files are counted.
    """
    loaded = loads.read_target(run.spark, run.target_path(item))
    if UPDATED in [c.lower() for c in loaded.columns] and "begin_at" not in windows.columns:
        sizes = loaded.groupBy(trunc_day(UPDATED).alias("day")).agg(F.count("*").alias("row_count"))
        spread = windows.select("window_id", F.explode(F.sequence("begin_date", "end_date")).alias("day"))
        sizes = sizes.join(spread, "day")
    else:
        path = f"{run.raw_root}/{item.raw_prefix.strip('/')}/{name}"
        sizes = loads.staged_per_window(run.spark, path, [*loaded.columns], "window_id")
    progress = R.window_progress(sizes, windows, rows="row_count")
    left = R.remainder(days, windows).withColumn("zero_rows", F.col("row_count") == 0)
    return progress.unionByName(left, allowMissingColumns=True).withColumns(
        {"table_uid": F.lit(item.table_uid), "loaded_at": F.lit(run.now())}
    )


def run_batched(run: IngestRun) -> list[dict]:
    """Full loads split into date windows; the table is emptied once, windows load in one pass.

    One scan of the source measures its days, for the counts and for the windows; a second one
    extracts.
    """
    routed = sel.route(sel.select_batched(run.control()))

    def steps(item: Row, name: str) -> Steps:
        work = work_path(run.spark, "windows")
        frames: dict[str, DataFrame] = {}

        def measure() -> DataFrame:
            if "days" not in frames:
                source = run.read(item.source_table)
                days = C.measure_days(source, UPDATED, run.window_cost == "byte_count")
                frames["days"] = _written_once(run, days, f"{work}/days")
            return frames["days"]

        def count() -> tuple:
            if not item.has_update_date:
                return _count(run, item)
            return _stamps(C.profile_counts(measure()))

        def extract(counted: tuple) -> DataFrame:
            chosen = plan_windows(run, measure(), counted[1])
            if chosen.where("oversize").isEmpty():
                frames["windows"] = _written_once(run, chosen, f"{work}/windows")
            else:
                source = run.read(item.source_table)
                cut = plan_windows(run, measure(), counted[1], source)
                frames["windows"] = _written_once(run, cut, f"{work}/windows")
            return _windowed(run, item, name, frames["windows"], counted[0])

        def load(staged: DataFrame) -> loads.LoadResult:
            target = run.target_path(item)
            done = loads.replace_load(
                staged, target, run.piece_by(item, staged), clear_when_empty=True
            )
            progress = _progress(run, item, measure(), frames["windows"], name)
            shown = progress.select(*WINDOW_STATUS.fieldNames())
            loads.append_load(shown, run.windows_path)
            return done

        return Steps(
            count, extract, load, needs_count=True, clean_up=lambda: drop_path(run.spark, work)
        )

    batched = routed.filter(F.col("route") == "batched").drop("route")
    return _run_items(run, work_list(run, batched), steps, empty_is_loaded=True)


def run_scheduled(run: IngestRun) -> list[dict]:
    """Loads asked for by their schedule: by months, over all update dates, or a manual range."""

    def steps(item: Row, name: str) -> Steps:
        def extract(counted: tuple) -> DataFrame:
            asked = {
                **item.asDict(),
                "min_update_date": counted[1],
                "max_update_date": counted[2],
            }
            frame = small_frame(
                run.spark, [{f: asked[f] for f in _SCHEDULED.fieldNames()}], _SCHEDULED
            )
            windows = win.schedule_windows(frame, run.as_of).drop("table_uid")
            whole = item.schedule != "Manual"
            return _windowed(run, item, name, windows, counted[0], whole)

        def load(staged: DataFrame) -> loads.LoadResult:
            target, piece_by = run.target_path(item), run.piece_by(item, staged)
            if item.schedule == "Manual" and not item.schedule_truncate:
                return loads.append_load(staged, target, piece_by)
            return loads.replace_load(staged, target, piece_by, clear_when_empty=True)

        return Steps(lambda: _count(run, item), extract, load, needs_count=True)

    items = work_list(run, sel.select_scheduled(run.control()))
    return _run_items(run, items, steps, scheduled=True, empty_is_loaded=True)


def run_metadata(
    run: IngestRun, constraints: str = "all_constraints", cons_columns: str = "all_cons_columns"
) -> list[dict]:
    """Column catalog (both slices) and primary keys, into one target per release."""

    def steps(item: Row, name: str) -> Steps:
        keys = item.source_table == PRIMARY_KEYS_TABLE

        def extract(_) -> DataFrame:
            if keys:
                found = primary_keys(run.read(constraints), run.read(cons_columns), run.owner)
            else:
                found = loads.catalog_extract(
                    run.read(item.source_table), run.owner, return_fields=item.return_fields
                )
            return _stage(run, item, name, found)

        def load(staged: DataFrame) -> loads.LoadResult:
            kind = "primary_keys" if keys else "columns"
            return loads.metadata_load(staged, run.target_path(item), kind)

        return Steps(lambda: (0, None, None) if keys else _count(run, item), extract, load)

    items = work_list(run, sel.select_metadata(run.control()))
    return _run_items(run, items, steps, empty_is_loaded=True)


def run_freeform(run: IngestRun) -> list[dict]:
    """Stored SQL queries, into targets created from their columns."""

    def steps(item: Row, name: str) -> Steps:
        return Steps(
            lambda: (0, None, None),
            lambda _: _stage(run, item, name, scan_freeform(run.spark, item.freeform_sql, run.tables)),
            lambda staged: _load(run, item, staged),
        )

    done = _run_items(run, work_list(run, sel.select_freeform(run.control())), steps)
    if run.stats_export:
        stats = run.stats()
        for result in done:
            name = result["file_name"]
            R.export_stats_item(stats, name, f"{run.stats_export}/{name}")
    return done


def run_all(run: IngestRun, export_to: str | None = None) -> list[dict]:
    """All flows in order, then the export of the control table."""
    done = [
        *run_regular(run),
        *run_batched(run),
        *run_scheduled(run),
        *run_metadata(run),
        *run_freeform(run),
    ]
    if export_to:
        R.export_control_snapshot(run.control(), export_to, run.priority, run.instance)
    return done
