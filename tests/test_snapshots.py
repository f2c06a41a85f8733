"""Snapshots by key range: results as of a plain merge, and only touched files rewritten."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.snapshots import KeyedSnapshot


def schema(kind):
    return T.StructType([T.StructField("k", kind), T.StructField("v", T.LongType()), T.StructField("x", T.StringType())])


def rewritten(snapshot, version):
    """Files of a version that the one before did not have as they are."""
    now, before = ({(r.file, r.commit) for r in snapshot.files(v).collect()} for v in (version, version - 1))
    return now - before, {f for f, _ in before}


@pytest.mark.parametrize("kind", [T.LongType(), T.StringType()])
def test_merges_are_those_of_a_dict(spark, tmp_path, kind):
    rng = random.Random(2)
    key = (lambda i: f"k{i:06d}") if isinstance(kind, T.StringType) else (lambda i: i)
    snapshot = KeyedSnapshot(spark, str(tmp_path / "s"), schema(kind), "k", "v", rows_per_file=100, files_per_slot=3)
    want = {key(2 * i): (0, "base") for i in range(1000)}
    snapshot.create(spark.createDataFrame([(k, v, x) for k, (v, x) in want.items()], schema(kind)))
    assert snapshot.files().count() == 10
    for round_ in range(1, 5):
        part = [rng.randrange(2100) for _ in range(30)] if round_ < 4 else list(range(2100, 2400))
        rows = [(key(i), round_ * 10 + j, f"r{round_}") for i in part for j in (0, 1)] + [(None, 1, "x")]
        version = snapshot.merge(spark.createDataFrame(rows, schema(kind)))
        want |= {key(i): (round_ * 10 + 1, f"r{round_}") for i in part}
        got = snapshot.read().collect()
        assert len(got) == len(want) and {r.k: (r.v, r.x) for r in got} == want
        assert all(r.n_keys == r.n_rows and r.least <= r.greatest for r in snapshot.files().collect())
        assert snapshot.files().groupBy("slot").count().agg(F.max("count")).first()[0] <= 3
    assert version == 4 and snapshot.read(0).count() == 1000


def test_an_increment_of_one_percent_rewrites_its_files_only(spark, tmp_path):
    snapshot = KeyedSnapshot(spark, str(tmp_path / "s"), schema(T.LongType()), "k", "v", rows_per_file=500)
    snapshot.create(spark.range(0, 20_000, 2).selectExpr("id as k", "0L as v", "'a' as x"))
    assert snapshot.files().count() == 20
    # one percent, next to each other: one file, or two
    version = snapshot.merge(spark.range(5_000, 5_200, 2).selectExpr("id as k", "1L as v", "'b' as x"))
    new, before = rewritten(snapshot, version)
    assert 1 <= len(new) <= 2 and {f for f, _ in new} <= before
    # keys that are not there, within all ranges: no file is written again
    version = snapshot.merge(spark.range(1, 20_000, 1_000).selectExpr("id as k", "2L as v", "'c' as x"))
    new, before = rewritten(snapshot, version)
    assert {f for f, _ in new} & before == set() and snapshot.read().count() == 10_020
    assert snapshot.read().filter("x = 'b'").count() == 100


def test_nothing_to_merge(spark, tmp_path):
    snapshot = KeyedSnapshot(spark, str(tmp_path / "s"), schema(T.LongType()), "k", "v")
    empty = spark.createDataFrame([], schema(T.LongType()))
    snapshot.create(empty)
    snapshot.merge(empty)
    assert snapshot.read().count() == 0
    snapshot.merge(spark.createDataFrame([(1, 1, "a")], schema(T.LongType())))
    assert snapshot.read().count() == 1
