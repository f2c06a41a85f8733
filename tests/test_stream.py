"""The stream against the batch operators, batch by batch."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidelog.operators.progress import publishable
from tidelog.plans.application import Application
from tidelog.operators.mapping import MapRule
from tidelog.plans.example import schema_from_text
from tidelog.shared import checkpoint_dir
from tidelog.streaming.etl import StreamEtl

APP = Application(
    "small",
    schema_from_text("event_logid s\nevent_time s\nevent_loginfo ms"),
    (MapRule(("logid",), ("event_logid",)), MapRule(("date", "time"), ("event_time=time",), "date_time")),
    n_pipelets=2,
)
SCHEMA = "pipelet bigint, msg_id bigint, body string, ingest_ts timestamp_ntz"


def row(pipelet, msg_id, minute):
    body = f"NOTICE: 01-01 00:{minute:02d}:00 x [logid={msg_id} pad=%41]"
    return (pipelet, msg_id, body, dt.datetime(2024, 1, 1, 1, 0))


BATCHES = [
    [row(0, 1, 1), row(1, 1, 2), row(0, 2, 3)],
    [row(0, 3, 11), row(0, 2, 3), (1, 9, "junk", dt.datetime(2024, 1, 1))],  # a replay, a bad line
    [row(1, 2, 12), row(1, 1, 2)],  # now all have left the first bucket; another replay
    [row(0, 4, 4)],  # late
    [row(0, 5, 25), row(1, 3, 25)],  # seals the second bucket
]


@pytest.fixture(scope="module")
def etl(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("etl")
    for i, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(root / "in" / f"b{i}"))
    etl = StreamEtl(spark, APP, str(root / "out"))
    for i in range(len(BATCHES)):  # one run per batch: each goes on where the last one stopped
        source = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        folder = root / "now"
        folder.mkdir(exist_ok=True)
        for f in (root / "in" / f"b{i}").glob("part-*"):
            f.rename(folder / f"b{i}-{f.name}")
        etl.start(source.parquet(str(folder)), availableNow=True).awaitTermination()
    return etl


def _ids(df):
    return sorted((r.pipelet, r.msg_id) for r in df.collect())


def test_published_rows(etl):
    assert _ids(etl.published()) == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]
    assert {r.event_logid for r in etl.published().collect()} == {"1", "2", "3"}


def test_status(etl):
    status = {r.partition: r for r in etl.status(4).collect()}
    assert (status["202401010000"].published_batch, status["202401010010"].published_batch) == (2, 4)
    assert status["202401010020"].published_batch is None
    assert etl.status(1).filter("published_batch is not null").count() == 0


def test_late_rows_are_listed(etl):
    assert _ids(etl.late(4)) == [(0, 4)]


def test_bad_lines_are_kept(etl):
    assert [(r.msg_id, r.reason) for r in etl.quarantine(4).collect()] == [(9, "no_header")]


def test_published_is_what_the_batch_says(etl):
    rows = etl.staged().filter("reason is null").select("pipelet", "bucket")
    public = {r.partition for r in publishable(rows, 2).collect()}
    assert public == {r.bucket for r in etl.published().select("bucket").distinct().collect()}


def test_repeating_a_batch_changes_nothing(etl, spark):
    before = _ids(etl.published())
    staged = etl.staged().count()
    etl.process(spark.createDataFrame(BATCHES[4], SCHEMA), 4)
    assert _ids(etl.published()) == before and etl.staged().count() == staged
    assert etl.status(4).filter(F.col("published_batch") == 4).count() == 1


def test_late_rows_are_merged_into_published_buckets(spark, tmp_path):
    """Published rows and the log of late ones are what a batch over all rows says."""
    etl = StreamEtl(spark, APP, str(tmp_path / "out"))
    for i, rows in enumerate([*BATCHES, [row(1, 9, 5), row(1, 2, 12)]]):
        etl.process(spark.createDataFrame(rows, SCHEMA), i)
    before = etl.public.current()
    etl.correct(5)
    after = etl.public.current()
    all_rows = etl.staged().filter("reason is null and bucket < '202401010020'")
    assert _ids(etl.published()) == sorted({(r.pipelet, r.msg_id) for r in all_rows.collect()})
    assert (0, 4) not in _ids(etl.published(before)) and after == before + 1
    # only the bucket that got rows was written again
    assert etl.public.manifest().filter("commit = 'correct-5'").count() == 1
    etl.correct(5)
    assert etl.public.current() == after


def run_all(spark, root, batches, **settings):
    etl = StreamEtl(spark, APP, str(root), **settings)
    for i, rows in enumerate(batches):
        etl.process(spark.createDataFrame(rows, SCHEMA).coalesce(1), i)
    return etl


def public_buckets(etl):
    return {r.bucket for r in etl.published().select("bucket").distinct().collect()}


FIVE = [[row(p, 10 * i + p, 10 * i) for p in (0, 1)] for i in range(5)]


@pytest.mark.parametrize("stray", [5, None, -1])
def test_strays_hold_up_nothing(spark, tmp_path, stray):
    etl = run_all(spark, tmp_path, [[*FIVE[0], row(stray, 99, 0)], *FIVE[1:]])
    rows = [(r[0], f"2024010100{m:02d}") for m in range(0, 50, 10) for r in FIVE[m // 10]] + [(stray, "202401010000")]
    batch = publishable(spark.createDataFrame(rows, "pipelet bigint, bucket string"), 2)
    assert public_buckets(etl) == {r.partition for r in batch.collect()} and len(public_buckets(etl)) == 4
    assert [(r.msg_id, r.reason) for r in etl.quarantine(4).collect()] == [(99, "unexpected_pipelet")]


def test_nobody_waits_for_an_idle_shard(spark, tmp_path):
    batches = [FIVE[0], *([r[0]] for r in FIVE[1:])]  # pipelet 1 falls silent
    rows = [(r[0], f"2024010100{10 * i:02d}") for i, b in enumerate(batches) for r in b]
    df = spark.createDataFrame(rows, "pipelet bigint, bucket string")
    for name, idle_after in (("waits", None), ("goes_on", 20)):
        etl = run_all(spark, tmp_path / name, batches, idle_after=idle_after)
        batch = {r.partition for r in publishable(df, 2, idle_after).collect()}
        assert public_buckets(etl) == batch and len(batch) == (0 if idle_after is None else 4)


def test_a_bucket_that_stays_incomplete_is_given_up(spark, tmp_path):
    batches = [[row(p, 10 * i + p, 10 * (i % 6)) for p in (0, 1) if (i, p) != (1, 1)] for i in range(6)]
    etl = run_all(spark, tmp_path, [*batches, [row(1, 999, 10)]], give_up_after=20, keep_batches=1)
    # a message that comes after that opens nothing
    assert [(r.partition, r.missing) for r in etl.incomplete(5).collect()] == [("202401010010", [1])]
    assert [r.partition for r in etl.incomplete(6).collect()] == ["202401010010"]
    assert _ids(etl.given_up(6)) == [(0, 10), (1, 999)]
    assert public_buckets(etl) == {f"2024010100{m:02d}" for m in (0, 20, 30, 40)}
    assert len(list((tmp_path / "staged").iterdir())) <= 3


def test_old_buckets_are_forgotten(spark, tmp_path):
    batches = [*FIVE, [row(0, 77, 1)], [row(0, 78, 1), row(0, 50, 50), row(1, 51, 50)]]
    etl = run_all(spark, tmp_path, batches, remember=15, keep_batches=1)
    assert {r.partition for r in etl.status(6).collect()} == {f"2024010100{m:02d}" for m in (40, 50)}
    assert _ids(etl.late(6)) == [(0, 77), (0, 78)] and len(public_buckets(etl)) == 5


def test_files_stay_bounded(spark, tmp_path):
    """50 micro-batches, a bucket never complete: what is staged, and what states there are, does not grow."""
    etl = StreamEtl(spark, APP, str(tmp_path / "out"), keep_batches=3, give_up_after=10)
    shared = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = len(list(shared.iterdir()))
    sizes = []
    for i in range(50):
        rows = [row(p, 10 * i + k, i) for p in (0, 1) for k in (1, 2)] + [(0, 10 * i, "junk", dt.datetime(2024, 1, 1))]
        if i == 30:
            rows.append(row(0, 999, 11))
        if i < 10:
            rows = [r for r in rows if r[0] == 0 or "junk" in r[2]]  # of the first bucket pipelet 1 has nothing
        etl.process(spark.createDataFrame(rows, SCHEMA).coalesce(1), i)
        sizes.append(len(list((tmp_path / "out" / "staged").iterdir())))
    assert max(sizes[25:]) <= 20 and len(list(shared.iterdir())) == before
    assert len(list((tmp_path / "out" / "aside" / "data").iterdir())) <= 60
    for kind in ("status", "newest", "delivered", "listed", "ready"):
        assert len(list((tmp_path / "out" / kind).iterdir())) <= 11
    # ten minutes are ten batches of two pipelets with two messages; the bucket of pipelet 0 alone is given up
    assert public_buckets(etl) == {f"2024010100{m}" for m in (10, 20, 30)}
    assert etl.published().count() == 4 * 30 and etl.given_up(49).count() == 20
    assert etl.quarantine(49).count() == 50 and _ids(etl.late(49)) == [(0, 999)]
