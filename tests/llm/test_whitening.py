"""Whitening against a full decomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import whitening
from tidelog.llm.queries import QUERIES
from tidelog.llm.whitening import Whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def whole(row):
    return [math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in row]


def check(spark, rows, how=Whitening(), components=None):
    """All rows of the operator against numpy's."""
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("x", "d", "component", "n")}).repartition(3)
    got = {}
    for r in whitening.whiten(df, how).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    kept = {i: whole(v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(map(tuple, kept.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, sum(values > 1e-12 * values[0])) if components is None else components
    assert set(got) == set(kept)
    signs = {}
    for i, v in kept.items():
        assert sorted(got[i]) == list(range(1, k + 1))
        own = np.array([(n * c - s) / n for c, s in zip(v, sums)])
        for j, r in got[i].items():
            want = own @ vectors[:, j - 1] / math.sqrt(values[j - 1])
            sign = signs.setdefault(j, 1 if want * r.whitened > 0 else -1) if abs(want) > 1e-6 else signs.get(j, 1)
            assert abs(r.whitened - sign * want) < 1e-9
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(v, sums))
            assert abs(r.explained / (values[j - 1] / values.sum()) - 1) < 1e-10 and r.identity_error < 1e-10


def random(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) * (1 + 3 * rng.random(d)))]


def test_more_dimensions_than_the_block(spark):
    check(spark, random(400, 70), Whitening(block=20))


def test_odd_rows(spark):
    rows = random(60, 20)
    rows += [(100, None), (101, [None] * 20), (102, [float("nan")] * 20), (103, [float("inf")] * 20), (104, rows[0][1]), (105, rows[0][1])]
    check(spark, rows)


def test_few_dimensions(spark):
    check(spark, random(50, 3))


def test_few_vectors(spark):
    check(spark, random(6, 30), components=5)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_other_lengths_and_vast_entries(spark):
    rows = random(30, 4) + [(50, [1.0]), (51, [1.0, 2.0, 3.0]), (52, [3e38, -3e38, 0.0, 1.0])]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id for r in out} == {*range(30), 52}
    assert all(math.isfinite(r.whitened) for r in out) and {r.deviation for r in out if r.vec_id == 52} == {None}


def test_null_and_repeated_ids(spark):
    rows = [(None, v) for _, v in random(5, 4)] + [(1, v) for _, v in random(5, 4, 2)]
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 10 * 4


def test_partial_sums_meet_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PARTIALS", 2)
    check(spark, random(80, 6))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(spark, rows)
    assert QUERIES["op13_whitening"](spark, sf_dir).count() == 16 * len(rows)
