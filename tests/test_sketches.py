"""Sketches against exact answers."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import sketches


def events(spark, n, seed):
    """Some frequent keys, and very many rare ones."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        keys = {f"rare{rng.randrange(10**9)}" for _ in range(3)} | {f"k{min(int(rng.expovariate(0.4)), 30)}"}
        rows.append((i % 3, {k: "v" for k in keys}))
    rows += [(0, {}), (1, None)]
    return rows, spark.createDataFrame(rows, "day bigint, event_loginfo map<string,string>")


@pytest.mark.parametrize("share", [0.2, 0.05, 0.01])
def test_frequent_keys(spark, share):
    rows, df = events(spark, 4000, 1)
    counts = collections.Counter(k for _, m in rows for k in m or ())
    want = {k: n for k, n in counts.items() if n >= share * counts.total()}
    assert {r.key: r.n_rows for r in sketches.frequent_keys(df.repartition(7), share).collect()} == want
    # days' sketches merged name them as well, and few others
    merged = sketches.merged_key_sketches(sketches.key_sketches(df, share, by=["day"]))
    found = [r.key for r in sketches.candidate_keys(merged, share).collect()]
    assert set(want) <= set(found) and len(found) <= sketches.tracked_for(share)


def test_no_keys(spark):
    _, df = events(spark, 0, 1)
    assert sketches.frequent_keys(df, 0.1).count() == 0
    with pytest.raises(ValueError, match="a share"):
        sketches.tracked_for(0)


@pytest.mark.parametrize("size", [200, 400])
def test_quantiles_within_the_bound(spark, size):
    rng = random.Random(size)
    delays = [(p, int(rng.lognormvariate(6 + p, 1.5))) for p in range(4) for _ in range(5000)]
    df = spark.createDataFrame([*delays, (1, None)], "part bigint, ms bigint").repartition(6)
    shares = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    parts = sketches.freshness(df, F.col("ms"), ["part"], size)
    for sketch, keep in ((sketches.merged_freshness(parts), range(4)), (parts.filter("part = 2"), (2,))):
        values = sorted(ms for p, ms in delays if p in keep)
        got = sketches.freshness_quantiles(sketch, shares).collect()
        assert [r.share for r in got] == shares and all(r.n == len(values) for r in got)
        for r in got:
            below, upto = sum(v < r.delay for v in values), sum(v <= r.delay for v in values)
            off = sketches.rank_error(size) * len(values)
            assert below - off <= r.share * len(values) <= upto + off
