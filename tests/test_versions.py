"""Versions of a table: atomic commits, time travel, crashes between the steps."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.versions import ConcurrentCommit, VersionedTable

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.StringType()), T.StructField("hour", T.StringType())])
KEYS = ("day", "hour")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), SCHEMA, KEYS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_and_time_travel(spark, table):
    assert table.current() is None and table.read().count() == 0 and table.manifest().count() == 0
    assert table.commit(frame(spark, (1, "01", "00"), (2, "01", "01"), (3, None, "01"))) == 0
    early = table.read()
    assert table.commit(frame(spark, (4, "01", "01"), (5, "02", "00")), remove=frame(spark, (0, None, "01"))) == 1
    assert ids(table.read(0)) == [1, 2, 3] and ids(table.read(1)) == ids(table.read()) == [1, 4, 5]
    assert ids(early) == [1, 2, 3]  # planned before the second commit
    assert {(r.day, r.hour, r.n_rows) for r in table.manifest().collect()} == {("01", "00", 1), ("01", "01", 1), ("02", "00", 1)}
    assert table.read().filter("hour = '00'").select("day").distinct().count() == 2
    with pytest.raises(ValueError, match="no version 7"):
        table.read(7)


@pytest.mark.parametrize("step", ["data", "manifest", "marker", "rename"])
def test_a_crash_between_steps_changes_nothing(spark, table, step):
    table.commit(frame(spark, (1, "01", "00"), (2, "01", "01")))

    def crash(name):
        if name == step:
            raise KeyboardInterrupt

    broken = VersionedTable(spark, table.root, SCHEMA, KEYS, on_step=crash)
    with pytest.raises(KeyboardInterrupt):
        broken.commit(frame(spark, (7, "01", "00"), (8, "02", "00")), name="b")
    assert table.versions() == [0] and ids(table.read()) == [1, 2]
    # the same commit goes through later
    assert table.commit(frame(spark, (7, "01", "00"), (8, "02", "00")), name="b") == 1
    assert ids(table.read()) == [2, 7, 8] and ids(table.read(0)) == [1, 2]


def test_a_repeated_commit_is_one(spark, table):
    assert table.commit(frame(spark, (1, "01", "00")), name="batch-0") == 0
    assert table.commit(frame(spark, (2, "01", "00")), name="batch-1") == 1
    assert table.commit(frame(spark, (1, "01", "00")), name="batch-0") == 0
    assert table.versions() == [0, 1] and ids(table.read()) == [2]


def test_of_two_writers_one_commits(spark, table):
    table.commit(frame(spark, (1, "01", "00")))

    def meanwhile(step):
        if step == "rename":
            VersionedTable(spark, table.root, SCHEMA, KEYS).commit(frame(spark, (2, "01", "00")))

    with pytest.raises(ConcurrentCommit):
        VersionedTable(spark, table.root, SCHEMA, KEYS, on_step=meanwhile).commit(frame(spark, (3, "01", "00")))
    assert table.versions() == [0, 1] and ids(table.read()) == [2]


def test_vacuum_keeps_what_versions_need(spark, table):
    for i in range(5):
        table.commit(frame(spark, (i, "01", "00"), (i, f"1{i}", "00")), name=f"c{i}")
    table.vacuum(keep=2)
    assert table.versions() == [3, 4]
    assert ids(table.read()) == [0, 1, 2, 3, 4, 4] and ids(table.read(3)) == [0, 1, 2, 3, 3]
    table.commit(frame(spark, *((9, f"1{i}", "00") for i in range(3))))
    table.vacuum(keep=1)
    assert ids(table.read()) == [3, 4, 4, 9, 9, 9]
    folders = {p.name for p in (Path(table.root) / "data").iterdir() if p.is_dir()}
    assert {"commit=c0", "commit=c1", "commit=c2"} & folders == set() and len(folders) == 3


def test_an_empty_commit_is_a_version(spark, table):
    table.commit(frame(spark, (1, "01", "00")))
    assert table.commit(frame(spark).filter(F.lit(False))) == 1
    assert ids(table.read()) == [1]
