from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import types as T

from tidegate.functions import clean as cl
from tidegate.operators import counts as C
from tidegate.plans.loads import conform, read_staged, stage_raw
from tidegate.sources.landing import read_landing_csv

NASTY = [
    'He said "no", twice',
    '""',
    '"',
    "a,b",
    "line\nbreak",
    "windows\r\nbreak",
    "carriage\rreturn",
    "  blanks kept  ",
    "back\\slash",
    'back\\"slash',
    "accents é ü ß 漢字",
    "#comment",
    "nullable",
    "'single'",
    "tab\tinside",
    "\n",
    "end\n",
    "0012",
    "1e5",
]


def test_text_survives_staging(spark, tmp_path, rows):
    data = [(str(i), text) for i, text in enumerate(NASTY)]
    df = spark.createDataFrame(data, "id string, text string")
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    assert rows(read_landing_csv(spark, path)) == rows(df)
    assert rows(read_staged(spark, path, df.schema)) == rows(df)


def test_missing_spellings_become_null_and_stay_null(spark, tmp_path, rows):
    data = [(i, t) for i, t in enumerate([None, *cl.NA_TOKENS, "nullable", " NA", "Null"])]
    df = spark.createDataFrame(data, "id int, text string")
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    kept = {r.text for r in read_staged(spark, path, df.schema).collect()}
    assert kept == {None, "nullable", " NA", "Null"}
    path = stage_raw(df, str(tmp_path), "zone/own", "load", tokens=["NA"])
    own = read_staged(spark, path, df.schema, tokens=["NA"])
    assert own.filter("text IS NULL").count() == 3  # NA, and both spellings of nothing


def test_a_single_column_keeps_its_empty_rows(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("",), ("b",)], "text string")
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    assert read_landing_csv(spark, path).count() == 4


def test_every_type_comes_back(spark, tmp_path, rows):
    df = spark.sql(
        "SELECT 9007199254740993 AS big, cast(1.1 AS double) AS d, 1e300D AS huge, true AS b,"
        " date'2024-02-29' AS day, timestamp_ntz'2024-02-29 23:59:59.123456' AS ts,"
        " cast(12.3400 AS decimal(10,4)) AS dec, cast(NULL AS int) AS none"
    )
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    assert rows(read_staged(spark, path, df.schema)) == rows(df)


def test_a_value_that_does_not_fit_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "n string")
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    wanted = T.StructType([T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_staged(spark, path, wanted).collect()


def test_windows_get_their_own_folders(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('W', id % 3) AS window_id")
    path = stage_raw(df, str(tmp_path), "zone/t", "load", window="window_id", rows_per_file=10)
    folders = sorted(p.name for p in Path(path).iterdir() if p.is_dir())
    assert folders == ["window_id=W0", "window_id=W1", "window_id=W2"]
    assert len(list(Path(path, "window_id=W0").glob("*.csv"))) >= 4  # 34 rows, 10 a file


def test_a_hot_window_is_split(spark, tmp_path):
    """Two thirds of the rows in one window do not end up in one task."""
    df = spark.range(200_000).selectExpr(
        "id", "uuid() AS text", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('W', id % 9) END AS w"
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        path = stage_raw(df, str(tmp_path), "zone/t", "load", window="w", rows_per_file=10**9)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list(Path(path, "w=hot").glob("*.csv"))) > 3


def test_byte_cost_is_the_staged_size(spark, tmp_path):
    data = [(i, t) for i, t in enumerate(t for t in NASTY if "\r" not in t)]
    df = spark.createDataFrame(data, "id int, text string").coalesce(1)
    path = stage_raw(df, str(tmp_path), "zone/t", "load")
    written = sum(p.stat().st_size for p in Path(path).glob("*.csv"))
    header = len("id,text\n")
    assert df.agg({"id": "count"}).first()[0] == len(data)
    assert df.select(C.csv_bytes(df).alias("n")).agg({"n": "sum"}).first()[0] == written - header


def test_strip_null_text_damages_words_as_documented(spark):
    df = spark.createDataFrame([("nullable null",)], "t string")
    assert cl.strip_null_text(df).first().t == "able "


def test_odd_column_names(spark, rows):
    df = spark.createDataFrame([("NA", "x")], "`a b` string, `c.d` string")
    assert rows(cl.null_to_empty(cl.na_tokens_to_null(df))) == [("", "x")]


def test_conform_by_name(spark):
    wanted = T.StructType([T.StructField("B", T.LongType()), T.StructField("c", T.StringType())])
    df = spark.createDataFrame([("7",)], "b string")
    assert conform(df, wanted).first().asDict() == {"B": 7, "c": None}
    with pytest.raises(ValueError, match="not in the target: z"):
        conform(df.selectExpr("b", "1 AS z"), wanted)


def test_empty_extract(spark):
    assert cl.extract_is_empty(spark.range(0)) and not cl.extract_is_empty(spark.range(3))
    assert cl.empty_flag(spark.range(0)).first().zero_rows is True
