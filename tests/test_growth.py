"""What queries do more of as their tables grow."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from tidelog.functions import text
from tidelog.operators import ids
from tidelog.plans.sample_log import messages
from tidelog.streaming.shards import ShardProgress
from workload import QUERIES, load_all

load_all()


def _events(spark, path, event_ids):
    rows = spark.createDataFrame([(i,) for i in event_ids], "event_id bigint").coalesce(1)
    kinds = {"user_id": F.col("event_id") % 7, "event_type": F.lit("click"), "value": F.lit(1.5), "props": F.lit('{"k": 1}')}
    rows.select("event_id", F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"), *(c.alias(n) for n, c in kinds.items())).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_rounds_of_a_long_pipe_are_bounded(spark, tmp_path, monkeypatch):
    found = [0, 1, 30, 3000 * 17, 3000 * 160 + 10, 3000 * 300, 3000 * 300]
    sf_dir, rounds, absorb = _events(spark, tmp_path, found), [], ids.absorb
    monkeypatch.setattr(ids, "absorb", lambda *a: rounds.append(1) or absorb(*a))
    got = sorted(map(tuple, QUERIES["dedupe_intervals"](spark, sf_dir).collect()))
    assert got == sorted((i % 16, i // 16, i // 3000) for i in set(found))
    assert len(rounds) <= 16


def test_lines_of_one_small_file_are_the_work_of_all_cores(spark, tmp_path):
    lines = messages(spark, _events(spark, tmp_path, range(100)))
    assert lines.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert lines.count() == 100


def test_state_is_asked_once_for_each_bucket():
    calls, held = [], {}

    def updated(key, value):
        calls.append(key)
        held[key] = value

    progress = ShardProgress()
    progress.open = SimpleNamespace(containsKey=held.__contains__, getValue=held.get, updateValue=updated, keys=lambda: list(held), removeKey=held.pop)
    progress.newest = SimpleNamespace(exists=lambda: False, update=lambda value: None)
    progress.handle = SimpleNamespace(listTimers=list, registerTimer=lambda at: None)
    start = SimpleNamespace(timestamp=lambda: 0)
    rows = [SimpleNamespace(bucket=b, start=start, n_rows=n) for b, n in [("202401010000", 2), ("202401020000", 1), ("202401010000", 3)] * 50]
    out = list(progress.handleInputRows((4,), iter(rows), None))
    assert len(calls) == 2
    assert [(r.pipelet, r.kind, r.bucket, r.n_rows) for r in out] == [(4, "sealed", "202401010000", 250)]


def test_pairs_take_no_token_apart_whole(spark):
    lines = spark.createDataFrame([("a=1=2 b c= =d e==f é=ü=x",), ("a=1 b=2 a=3=4 b",), ("",)], "x string")
    got = [r.m for r in lines.select(text.pairs_to_map("x", " ").alias("m")).collect()]
    assert got == [{"a": "1", "b": "", "c": "", "": "d", "e": "", "é": "ü"}, {"a": "3", "b": ""}, {"": ""}]
    assert "split_part" not in text.raw_pairs_sql("x", " ")
