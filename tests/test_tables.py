from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.text import sanitize
from tidelog.sources import delimited, tables


def test_delimited_round_trip(spark, tmp_path):
    df = spark.sql("select '' as a, cast(null as bigint) as n, map('k', '1') as m, 'x\\ny' as t, '' as z, 'q\"r' as q")
    path = str(tmp_path / "t")
    delimited.write_delimited(df, path)
    assert spark.read.option("lineSep", "\n").text(path).first().value == '\x01\x01k:1\x01x\x03y\x01\x01q"r'
    back = delimited.scan_delimited(spark, path, df.schema).first()
    assert tuple(back) == ("", None, {"k": "1"}, "x\x03y", "", 'q"r')


def test_every_line_is_a_row(spark, tmp_path):
    """One text column with empty rows, a carriage return, quotes and backslashes."""
    values = ["", "x", "", "a\rb", "\\", '"', "\\\\\x02", ""]
    df = spark.createDataFrame([(v,) for v in values], "only string").coalesce(1)
    path = str(tmp_path / "t")
    delimited.write_delimited(df, path)
    assert sorted(r.only for r in delimited.scan_delimited(spark, path, df.schema).collect()) == sorted(values)


def test_sanitize(spark):
    df = spark.createDataFrame([("a\x01b\nc",)], "x string")
    assert df.select(sanitize(F.col("x")).alias("x")).first().x == "ab\x03c"


def test_partition_pruning_and_text_keys(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(100).selectExpr("id", "'20240101' as event_day", "lpad(id % 3, 2, '0') as event_hour", "'00' as event_minute")
    tables.write_partitioned(df, path)
    back = tables.scan_partitions(spark, path).filter("event_hour = '01'")
    assert {r.event_minute for r in back.collect()} == {"00"}
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_hour" in plan


def test_overwrite_replaces_only_given_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(10).selectExpr("id", "cast(id % 2 as string) as k")
    tables.write_partitioned(df, path, ["k"])
    tables.write_partitioned(df.filter("k = '1'").limit(2), path, ["k"], mode="overwrite")
    counts = {r.k: r.n for r in tables.scan_partitions(spark, path, ["k"]).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {"0": 5, "1": 2}


def test_only_published_partitions_are_visible(spark, tmp_path):
    location = str(tmp_path / "t")
    df = spark.range(6).selectExpr("id", "'20240101' as event_day", "lpad(id % 2, 2, '0') as event_hour", "'00' as event_minute")
    tables.write_partitioned(df, location)
    tables.create_event_table(spark, "visible", df.schema, location, replace=True)
    assert spark.table("visible").count() == 0
    for _ in range(2):
        tables.publish_partitions(spark, "visible", location, df.filter("event_hour = '01'").drop("id").distinct())
    assert {r.id for r in spark.table("visible").collect()} == {1, 3, 5}
    spark.sql("drop table visible")


def test_script(spark, tmp_path):
    script = "-- a; b\nset x.y = 1;\nselect ';' as a, \"--\" as b, 5 - 2 as c;\n"
    assert tuple(tables.sql_script(spark, script).first()) == (";", "--", 3)
    (tmp_path / "s.sql").write_text(script)
    assert tuple(tables.sql_file(spark, str(tmp_path / "s.sql")).first()) == (";", "--", 3)
    assert tables.sql_script(spark, " ;; ") is None


def test_bucket_file_names(spark):
    names = ["app_1_202401010000", "app_1_202401010000.done", "app_1_20240101", "app_x_202401010000", "other_1_202401010000", "app_2_202401010010"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    files = tables.parse_bucket_files(df, "app", F.col("name"))
    assert files.count() == 3
    pending = tables.not_uploaded(files).collect()
    assert [(r.pipelet, r.bucket) for r in pending] == [(2, "202401010010")]


@pytest.mark.parametrize("kind", [T.StringType(), T.LongType()])
def test_partition_exists(spark, kind):
    a = spark.range(4).select(F.col("id").cast(kind).alias("k"))
    assert tables.partition_exists(a, a.limit(2).unionByName(a.limit(2)), ["k"]).count() == 2


@pytest.mark.parametrize(
    "script, statements",
    [
        ("/* a; b */ select 1", ["  select 1"]),
        ("select 1 -- c; d\n;select 2;", ["select 1 \n", "select 2"]),
        ("select ';', \"--\", `a;b` /* x /* y; */ z */ ; ;", ["select ';', \"--\", `a;b`   "]),
        ("select 'it\\'s; it''s' ; select '/* no */'", ["select 'it\\'s; it''s' ", " select '/* no */'"]),
        ("select /*+ broadcast(t) */ 4 / 2 - -1", ["select /*+ broadcast(t) */ 4 / 2 - -1"]),
        ("-- nothing", []),
        ("", []),
    ],
)
def test_statements_of_a_script(script, statements):
    assert tables.split_statements(script) == statements


@pytest.mark.parametrize("script", ["select 'a", 'select "a', "select `a", "select 1 /* a", "select '\\'"])
def test_what_does_not_end_is_an_error(script):
    with pytest.raises(ValueError, match="does not end"):
        tables.split_statements(script)


def test_script_with_comments(spark):
    assert tables.sql_script(spark, "/* first; */ select 1 as a; -- last\nselect 2 as a -- two").first().a == 2
