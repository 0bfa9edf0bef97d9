from __future__ import annotations

from datetime import timedelta

import pytest

from checks import fixtures as fx
from tidegate.operators.slices import cdc_day_slice
from tidegate.plans.loads import read_target, replace_load, stage_raw, upsert_load
from tidegate.sources.landing import read_landing_csv
from tidegate.streaming.landing import landing_upsert_stream

KEY, NEWEST = ["o_orderkey"], ["last_update_date"]


def test_drops_equal_upserts_and_restart_adds_nothing(spark, sf, tmp_path, rows):
    src = fx.src_orders(spark, sf)
    start = fx.AS_OF - timedelta(days=4)
    streamed, loaded = str(tmp_path / "streamed"), str(tmp_path / "loaded")
    for target in (streamed, loaded):
        replace_load(fx.tgt_orders(spark, sf, str(start)), target)

    def run():
        query = landing_upsert_stream(
            spark, str(tmp_path / "raw"), streamed, src.schema, KEY, str(tmp_path / "ckpt"), NEWEST
        )
        query.awaitTermination()
        assert query.exception() is None

    for n in range(1, 5):
        day = start + timedelta(days=n)
        drop = cdc_day_slice(src, day)
        stage_raw(drop, str(tmp_path / "raw"), f"CDC/orders/{day:%Y/%m/%d}", f"load_{n}")
        upsert_load(drop, loaded, KEY, NEWEST)
        if n in (2, 4):
            run()
    assert rows(read_target(spark, streamed)) == rows(read_target(spark, loaded))
    before = sorted(p.name for p in (tmp_path / "streamed").rglob("*.parquet"))
    run()
    assert sorted(p.name for p in (tmp_path / "streamed").rglob("*.parquet")) == before


def test_the_later_drop_wins_within_a_batch(spark, tmp_path):
    schema = "id bigint, v string"
    for day, v in (("2024/01/02", "late"), ("2024/01/01", "early")):
        drop = spark.createDataFrame([(1, v)], schema)
        stage_raw(drop, str(tmp_path / "raw"), f"CDC/t/{day}", "load")
    target = str(tmp_path / "t")
    landing_upsert_stream(
        spark, str(tmp_path / "raw"), target, drop.schema, ["id"], str(tmp_path / "ckpt")
    ).awaitTermination()
    assert [r.v for r in read_target(spark, target).collect()] == ["late"]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    """As after a crash between the load and the checkpoint."""
    drop = spark.createDataFrame([(1, "a")], "id bigint, v string")
    stage_raw(drop, str(tmp_path / "raw"), "CDC/t/2024/01/01", "load")
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "ckpt")

    def run(path):
        landing_upsert_stream(
            spark, str(tmp_path / "raw"), target, drop.schema, ["id"], path
        ).awaitTermination()

    run(checkpoint)
    before = rows(read_target(spark, target))
    # the checkpoint forgets that its first batch is done
    for mark in (tmp_path / "ckpt" / "commits").glob("*0"):
        mark.unlink()
    for mark in (tmp_path / "ckpt" / "commits").glob(".*"):
        mark.unlink()
    run(checkpoint)
    assert rows(read_target(spark, target)) == before


def test_a_new_checkpoint_reads_everything_again(spark, tmp_path):
    schema = "id bigint, v string"
    target = str(tmp_path / "t")
    for n, (day, row) in enumerate((("2024/01/01", (1, "a")), ("2024/01/02", (2, "b")))):
        drop = spark.createDataFrame([row], schema)
        stage_raw(drop, str(tmp_path / "raw"), f"CDC/t/{day}", "load")
        landing_upsert_stream(
            spark, str(tmp_path / "raw"), target, drop.schema, ["id"], str(tmp_path / f"ck{n}")
        ).awaitTermination()
    assert {r.id for r in read_target(spark, target).collect()} == {1, 2}


def test_an_older_drop_does_not_replace_a_newer_one(spark, tmp_path):
    schema = "id bigint, v string"
    target = str(tmp_path / "t")
    for day, v in (("2024/01/02", "late"), ("2024/01/01", "early"), ("2024/01/03", "last")):
        drop = spark.createDataFrame([(1, v), (int(day[-1]) + 10, v)], schema)
        stage_raw(drop, str(tmp_path / "raw"), f"CDC/t/{day}", "load")
        landing_upsert_stream(
            spark, str(tmp_path / "raw"), target, drop.schema, ["id"], str(tmp_path / "ckpt")
        ).awaitTermination()
        got = {r.id: r.v for r in read_target(spark, target).collect()}
        assert got[1] == ("late" if v == "early" else v)
    assert got == {1: "last", 11: "early", 12: "late", 13: "last"}


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    folder = tmp_path / "raw" / "CDC" / "t" / "2024" / "01" / "01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id,q,p\n1,2,3\n")
    schema = spark.createDataFrame([], "id bigint, p bigint, q bigint").schema
    with pytest.raises(Exception, match="(?i)header"):
        read_landing_csv(spark, str(folder), ["id", "p", "q"]).collect()
    query = landing_upsert_stream(
        spark, str(tmp_path / "raw"), str(tmp_path / "t"), schema, ["id"], str(tmp_path / "ckpt")
    )
    with pytest.raises(Exception, match="(?i)header"):
        query.awaitTermination()
    assert read_target(spark, str(tmp_path / "t")).count() == 0
