from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import buckets, merge, progress
from tidelog.operators.enrich import ip_range_join
from tidelog.shared import lookup_join
from tidelog.sources import pipe


def rows_of(spark, seed=1, n=600, pipelets=4, n_buckets=12, hot=0.4):
    """Random rows, a large share of them in one pipelet and bucket."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        p, b = (0, 5) if rng.random() < hot else (rng.randrange(pipelets), rng.randrange(n_buckets))
        out.append((p, i, rng.randrange(n), f"2024010100{b:02d}"))
    return out, spark.createDataFrame(out, "pipelet bigint, msg_id bigint, arrival bigint, bucket string")


def model_late(rows):
    late, newest = set(), {}
    for p, i, _, b in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        if b < newest.get(p, ""):
            late.add(i)
        newest[p] = max(b, newest.get(p, ""))
    return late


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_rows(spark, seed):
    rows, df = rows_of(spark, seed)
    assert {r.msg_id for r in buckets.late_rows(df).collect()} == model_late(rows)


def test_seal_and_publish(spark):
    rows, df = rows_of(spark, pipelets=3, n=200)
    newest = {p: max(b for q, _, _, b in rows if q == p) for p in range(3)}
    want = {
        b
        for b in {r[3] for r in rows}
        if all(any(q == p and c == b for q, _, _, c in rows) and b < newest[p] for p in range(3))
    }
    assert want and {r.partition for r in progress.publishable(df, 3).collect()} == want
    status = {r.partition: r.is_public for r in progress.publication_status(df, 3).collect()}
    assert {b for b, public in status.items() if public} == want
    sealed = {(r.pipelet, r.bucket) for r in buckets.sealed_buckets(df).collect()}
    assert all(any(b in (bb for pp, bb in sealed if pp == p) for p in range(3)) for b in want)


def test_masks(spark):
    df = spark.createDataFrame(
        [(0, "a"), (1, "a"), (0, "b"), (0, "b"), (62, "c"), (63, "d"), (-1, "e"), (0, "e")], "pipelet bigint, bucket string"
    )
    listed = progress.deliveries(df)
    assert {r.partition: r.pipelets for r in listed.collect()} == {"a": [0, 1], "b": [0], "c": [62], "d": [63], "e": [-1, 0]}
    masks = progress.completeness_mask(df)
    assert {r.partition: r.mask for r in masks.collect()} == {"a": 3, "b": 1, "c": 1 << 62, "d": None, "e": None}
    assert [r.partition for r in progress.complete_partitions(listed, 2).collect()] == ["a"]
    assert {r.partition: r.missing for r in progress.missing_pipelets(listed, 2).collect()}["b"] == [1]
    wrong = progress.unexpected_pipelets(listed, 63).collect()
    assert sorted((r.partition, r.pipelet) for r in wrong) == [("d", 63), ("e", -1)]
    with pytest.raises(ValueError):
        progress.full_mask(64)


def test_one_too_many_is_not_complete(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "a")], "pipelet bigint, bucket string")
    assert progress.complete_partitions(progress.deliveries(df), 2).count() == 0


def test_upsert_is_idempotent(spark):
    status = spark.createDataFrame([("a", [0])], "partition string, pipelets array<bigint>")
    delivered = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0)], "partition string, pipelet bigint")
    once = progress.upsert_status(status, delivered)
    assert sorted(once.collect()) == sorted(progress.upsert_status(once, delivered).collect()) == [("a", [0, 1]), ("b", [0])]


def test_pipelets_beyond_a_mask_keep_their_positions(spark):
    """200 pipelets: 63 and 199 go on where they stopped, and count for completeness."""
    messages = spark.range(2000).selectExpr("id % 200 as pipelet", "id as msg_id")
    starts = spark.range(200).selectExpr("id as pipelet", "id + 1601 as start")
    got = {(r.pipelet, r.msg_id) for r in pipe.new_only(messages, starts).collect()}
    assert got == {(p, 1800 + p) for p in range(200)}
    assert len(json.loads(pipe.kafka_starting_offsets("t", starts))["t"]) == 200
    listed = progress.deliveries(messages.withColumn("bucket", F.lit("x")))
    assert progress.complete_partitions(listed, 200).count() == 1
    assert progress.missing_pipelets(listed.select("partition", F.expr("filter(pipelets, p -> p != 199) as pipelets")), 200).first().missing == [199]


def test_calendar(spark):
    days = spark.createDataFrame([("20240101",)], "event_day string")
    assert buckets.day_calendar(days, 10).count() == 144
    uneven = buckets.day_calendar(days, 7).filter("event_hour = '03'").orderBy("event_minute").collect()
    assert [r.event_minute for r in uneven] == ["00", "07", "14", "21", "28", "35", "42", "49", "56"]


@pytest.mark.parametrize(
    ("saved", "fixed", "quirk"),
    [(None, -1, -1), ("", -1, -1), ("-2", -2, -2), (" 100\n", 101, 101), ("0", 1, -1)],
)
def test_start_point(spark, saved, fixed, quirk):
    df = spark.createDataFrame([(saved,)], "saved string")
    row = df.select(
        pipe.start_point(df.saved).alias("a"), pipe.start_point(df.saved, quirks=True).alias("b")
    ).first()
    assert (row.a, row.b) == (fixed, quirk)


def test_valid_starts(spark):
    df = spark.createDataFrame([(-1,), (-2,), (65535,), (-42,), (0,)], "p bigint")
    assert [r.ok for r in df.select(pipe.is_valid_start(df.p).alias("ok")).collect()] == [True, True, True, False, True]


def test_kafka_offsets(spark):
    starts = spark.createDataFrame([(0, 101), (1, -1), (2, -2)], "pipelet bigint, start bigint")
    assert pipe.kafka_starting_offsets("t", starts) == '{"t": {"0": 101, "1": -2, "2": -1}}'


def test_envelope(spark):
    df = spark.createDataFrame([(0, b"x", 1, 5), (None, b"y", 1, 6)], "err_no int, msg_body binary, pipelet_id int, pipelet_msg_id bigint")
    assert [r.missing for r in pipe.envelope_check(df).collect()] == [[], ["err_no"]]
    bodies = pipe.decode_body(df.union(spark.sql("select 3, cast(null as binary), 1, 7L")).union(spark.sql("select 0, cast(null as binary), 1, 8L")))
    assert [r.body for r in pipe.decoded(bodies).collect()] == ["x"]
    assert [(r.msg_id, r.reason) for r in pipe.undecoded(bodies).collect()] == [(6, "no_err_no"), (7, "error"), (8, "no_body")]


@pytest.mark.parametrize("salts", [1, 8])
def test_lookup_join_with_a_hot_key(spark, salts):
    rows, df = rows_of(spark, hot=0.9)
    lookup = df.select("bucket").distinct().selectExpr("bucket", "substring(bucket, 11, 2) as m").filter("m < '08'")
    left = lookup_join(df, lookup, ["bucket"], salts=salts, spread=["msg_id"])
    assert {r.msg_id: r.m for r in left.collect()} == {r[1]: (r[3][-2:] if r[3][-2:] < "08" else None) for r in rows}
    semi = lookup_join(df, lookup, ["bucket"], how="left_semi", salts=salts, spread=["msg_id"])
    assert semi.columns == df.columns and semi.count() == sum(r[3][-2:] < "08" for r in rows)


def test_plans_are_built_without_jobs(spark):
    """No lookup is computed, counted or written while a plan is built; adaptive execution sends small ones."""
    _, df = rows_of(spark)
    starts = pipe.offset_checkpoint(df).withColumnRenamed("msg_id", "start")
    ranges = spark.createDataFrame([(0, 9, "a")], "lo bigint, hi bigint, place string")
    context = spark.sparkContext
    context.setJobGroup("plans", "")
    frames = [buckets.late_flag(df), pipe.new_only(df, starts), ip_range_join(df, ranges, df.bucket, ("place",))]
    assert not context.statusTracker().getJobIdsForGroup("plans")
    for frame in frames:
        frame.collect()
        assert "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()
    context.setJobGroup("", "")


def test_merge_prefers_increment_then_version(spark):
    old = spark.createDataFrame([(1, 9, "old"), (2, 1, "old")], "k bigint, v bigint, x string")
    new = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (3, 1, "c")], "k bigint, v bigint, x string")
    got = merge.snapshot_merge(new, old, ["k"], "v")
    assert sorted(map(tuple, got.collect())) == [(1, 2, "b"), (2, 1, "old"), (3, 1, "c")]


def test_merge_of_several_versions(spark):
    old = spark.createDataFrame([(1, 9, "x"), (1, 8, "y"), (2, 1, "b"), (2, 1, "a"), (None, 1, "n")], "k bigint, v bigint, x string")
    new = spark.createDataFrame([(None, 1, "m"), (3, 1, "a"), (3, 1, "b")], "k bigint, v bigint, x string")
    got = sorted(map(str, merge.snapshot_merge(new, old, ["k"], "v", unique=False).collect()))
    assert len(got) == 4 and got == sorted(map(str, merge.snapshot_merge(new.orderBy("x"), old.orderBy("x"), ["k"], "v", unique=False).collect()))


def test_the_snapshot_does_not_move_for_a_small_increment(spark):
    old = spark.range(100_000).selectExpr("id as k", "1L as v")
    new = spark.range(10).selectExpr("id * 7 as k", "2L as v")
    merged = merge.snapshot_merge(new, old, ["k"], "v")
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.find("Initial Plan")] if "Initial Plan" in plan else plan
    side = final[: final.find("BroadcastQueryStage")]
    assert "BroadcastHashJoin" in side and "Exchange" not in side


def test_hot_keys_are_pruned_before_the_shuffle(spark):
    _, df = rows_of(spark)
    plan = merge.first_per_key(df, ["bucket"], df.arrival)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_snapshot_keeps_the_old_one(spark, tmp_path):
    target = str(tmp_path / "snap")
    for i in range(3):
        merge.write_snapshot(spark.range(i + 1), target)
    assert [spark.read.parquet(target + s).count() for s in ("", ".bak1", ".bak")] == [3, 2, 1]


def test_dedupe(spark):
    _, df = rows_of(spark)
    assert merge.dedupe_replay(df.unionByName(df)).count() == df.count()
