"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the jobs are planned for. Adaptive execution does the sizing: shuffles start with many
# partitions and are merged to the advisory size, hot ones are split.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # plans over wide tables are built column by column; recording the call site of each is slow
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_dirs: dict[str, str] = {}


def build_session(
    app: str = "tidegate", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the defaults above; ``settings`` use ``_`` for ``.`` (``spark_sql_x="1"``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A temporary folder stands in for it only under a local master, where driver and executors
    are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidegate-")
    return _local_dirs[app]


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{work_root(spark)}/tidegate/{purpose}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def drop_path(spark: SparkSession, path: str) -> None:
    """Removes a work folder this job has made and no longer reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows of the driver's own making, as a local relation whose size the optimizer knows."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)))
