"""Readies a session for the operators that run Python: its workers' code, and batches of texts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shared: set[str] = set()
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def share_code(spark: SparkSession) -> None:
    """Sends the package to the executors unless the environment's path has it already.

    Where the package is installed on every machine, or given with --py-files, that is not needed.
    Rows here are whole texts, so Arrow batches of Spark's default number of rows are made smaller; a
    number the session has been given stays.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    app = spark.sparkContext.applicationId
    if app in _shared or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidegate-code-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shared.add(app)
