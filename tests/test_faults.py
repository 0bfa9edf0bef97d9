"""Failed tasks, and the folder intermediate results go to."""

from __future__ import annotations

import pytest

from tidegate import session
from tidegate.plans import loads as L


def flaky(spark, data, schema):
    """Rows whose first reading fails in every partition, after some rows were handed out."""

    def read(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise OSError("executor lost")

    rows = spark.createDataFrame(data, schema).repartition(3)
    return rows.mapInPandas(read, rows.schema)


def test_retried_tasks_do_not_change_rows_or_counts(spark, tmp_path):
    schema = "id bigint, v string, last_update_date string"
    first = [(i, "old", "2024-01-01") for i in range(1000)]
    changes = [(i, "new", "2024-01-02") for i in range(900, 1100)]
    for name, piece_by in (("whole", None), ("pieces", "id % 4")):
        target = str(tmp_path / name)
        done = L.replace_load(flaky(spark, first, schema), target, piece_by)
        assert done.rows_after == L.read_target(spark, target).count() == 1000
        path = L.stage_raw(flaky(spark, changes, schema), str(tmp_path / "raw"), name, "load")
        staged = L.read_staged(spark, path, L.read_target(spark, target).schema)
        done = L.upsert_load(staged, target, ["id"], ["last_update_date"])
        assert (done.rows_before, done.rows_after, done.processed) == (1000, 1100, 200)
        assert L.read_target(spark, target).filter("v = 'new'").count() == 200
        done = L.append_load(flaky(spark, [(9999, "x", "")], schema), target)
        assert done.rows_after == L.read_target(spark, target).count() == 1101


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    """Only what the choice of the work folder looks at."""

    def __init__(self, master, **settings):
        self.conf = _Conf(settings)
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def getConf(self):
        return self.conf


def test_work_folder():
    shared = _Session("spark://x:7077", **{"spark.checkpoint.dir": "hdfs://shared/ck/"})
    assert session.work_path(shared, "stage").startswith("hdfs://shared/ck/tidegate/stage-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(_Session("yarn"))
    local = session.work_root(_Session("local[2]"))
    assert local == session.work_root(_Session("local[2]"))


def test_work_folders_are_removed_after_an_upsert(spark, tmp_path, monkeypatch):
    made = []
    real = session.work_path

    def keep(spark, purpose):
        made.append(real(spark, purpose))
        return made[-1]

    monkeypatch.setattr(L, "work_path", keep)
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    L.upsert_load(rows, str(tmp_path / "t"), ["id"])
    from pathlib import Path

    assert made and not any(Path(p).exists() for p in made)
