"""Digests of rows, deletions, and rows that do not fit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.flows import make_run
from tidegate.operators import content
from tidegate.plans import flows
from tidegate.plans import loads as L
from tidegate.sources.landing import read_landing_rows



def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string, w string")


def differ(spark, a, b):
    found = [content.digests(frame(spark, x).repartition(3), F.lit("all")) for x in (a, b)]
    return [tuple(r) for r in content.differing_groups(*found).collect()]


def test_digests_see_every_change_and_no_order(spark):
    rows = [(k, f"v{k % 5}", None if k % 3 else "") for k in range(50)]
    assert differ(spark, rows, rows[::-1]) == []
    assert differ(spark, rows, rows[:-1]) == [("all", 50, 49)]
    assert differ(spark, rows, [(0, "other", ""), *rows[1:]]) == [("all", 50, 50)]
    # a missing value is not an empty one, and moves between columns are seen
    assert differ(spark, rows, [(0, "v0", None), *rows[1:]]) == [("all", 50, 50)]
    assert differ(spark, [(1, "a", None)], [(1, None, "a")]) == [("all", 1, 1)]
    # one row twice for another: the sums of both hashes differ
    assert differ(spark, [rows[0], rows[1]], [rows[0], rows[0]]) == [("all", 2, 2)]
    assert differ(spark, [], rows[:2]) == [("all", 0, 2)]


def test_groups_of_one_side_only(spark):
    a, b = frame(spark, [(1, "x", ""), (2, None, "")]), frame(spark, [(1, "x", ""), (3, "y", "")])
    odd = content.differing_groups(*[content.digests(df, F.col("v")) for df in (a, b)])
    assert sorted(map(tuple, odd.collect()), key=repr) == [("y", 0, 1), (None, 1, 0)]


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_deleted_keys(spark, buckets):
    rows = [(k, f"v{k % 4}", "") for k in range(300)] + [(None, "v", ""), (9, None, "")]
    target = frame(spark, rows)
    source = frame(spark, [r for r in rows if r[0] not in (17, 250, None)] + [(999, "new", "")])
    got = content.deleted_keys(source, target, ["id", "v"], buckets).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(17, "v1"), (250, "v2"), (None, "v")], key=repr)


def test_broken_rows_are_set_aside(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "a.csv").write_text('id,v,w\n1,a,b\n2,a\n3,"x, y",c\nfour,a,b\n5,a,b,c,d\n,a,b\n')
    text = read_landing_rows(spark, str(folder), ["id", "v", "w"])
    good, n = L.set_aside(text, frame(spark, []).schema, str(tmp_path / "aside"), ["id"])
    assert sorted(map(tuple, good.collect())) == [(1, "a", "b"), (3, "x, y", "c")]
    assert n == 4
    aside = spark.read.schema(L.ASIDE).json(str(tmp_path / "aside")).collect()
    assert sorted(r.reason for r in aside) == ["broken row", "broken row", "id is not bigint", "no id"]
    assert all(r.file.endswith("a.csv") for r in aside)
    assert "2,a" in {r.row for r in aside}
    (folder / "a.csv").write_text("id,w,v\n1,a,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing_rows(spark, str(folder), ["id", "v", "w"]).collect()


def test_a_flow_loads_what_fits(spark, sf, tmp_path):
    """One value that is no number fails the load, or goes aside where there is a folder for it."""
    day = "TIMESTAMP_NTZ'1998-06-14 01:00:00' AS"
    base = [f"{day} last_update_date", f"{day} creation_date"]
    rows = spark.sql(f"SELECT * FROM VALUES (1, '2.5'), (2, 'much'), (3, '4') AS t(id, v)").selectExpr("*", *base)
    for aside in (None, str(tmp_path / "aside")):
        run = make_run(
            spark, sf, [{"table_uid": "t", "source_table": "t", "load_type": "CDC", "primary_key": "id"}],
            read={"t": lambda: rows}, aside_root=aside,
        )
        L.replace_load(rows.selectExpr("id", "0.0D AS v", "last_update_date", "creation_date"), f"{run.target_root}/dw/t")
        (done,) = flows.run_regular(run)
        held = {r.id: r.v for r in L.read_target(spark, f"{run.target_root}/dw/t").collect()}
        if aside is None:
            assert done["load_error"] and set(held.values()) == {0.0}
        else:
            assert not done["load_error"] and held == {1: 2.5, 2: 0.0, 3: 4.0}
            assert (done["processed"], done["set_aside"]) == (2, 1)
            assert run.results().first().set_aside == 1


def test_promotion_needs_the_same_rows(spark, sf):
    rows = spark.sql("SELECT id, 'NA' AS k, DATE'1998-06-01' + CAST(id AS INT) AS last_update_date FROM range(40)")
    changed = rows.selectExpr("id", "CASE WHEN id = 35 THEN 'x' ELSE k END AS k", "last_update_date")
    asked = []

    def moving():
        asked.append(1)
        return rows if len(asked) <= 2 else changed

    run = make_run(
        spark, sf, [{"table_uid": t, "source_table": t, "load_type": "Full"} for t in ("a", "b")],
        read={"a": lambda: rows, "b": moving}, compare_content=True,
    )
    flows.run_regular(run)
    assert {r.table_uid: r.load_type for r in run.control().collect()} == {"a": "CDC", "b": "Full"}
    assert {r.table_uid: r.differing for r in run.results().collect()} == {"a": "", "b": "1998-07"}
