"""Pipe to published partitions, continuously.

Every micro-batch is parsed and mapped once and staged under its ``batch_id``,
so that a repeated batch replaces its own rows.  A bucket is published when all declared
pipelets have delivered it and moved on to a newer one; it is then built anew from all
its staged rows, without replays, and becomes part of a new version of the published
table.  Rows staged after that are late; :meth:`StreamEtl.correct` merges them.

Pipelets that were not declared, or are NULL, hold up nothing: their rows are bad ones.
With ``idle_after`` nobody waits for a pipelet that far behind the newest of all.  With
``give_up_after`` a bucket that is still incomplete so far behind the frontier is given
up: it is reported, and its rows are kept apart.

A staged batch is kept while an open bucket may have rows in it, and for ``keep_batches``
more.  Then its late, bad and given up rows move to a table of their own, whose small
parts are merged, and it is deleted.

What is carried from batch to batch is one row per pipelet, and one per bucket that is no
further than ``remember`` behind the frontier.  Rows of buckets beyond that are late.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.clock import key_minutes, split_key_parts
from tidelog.operators.buckets import bucket_counts
from tidelog.operators.corrections import additions, merge_changes
from tidelog.operators.merge import first_per_key
from tidelog.operators.progress import complete_but_idle, deliveries, is_declared, missing_pipelets, shard_progress
from tidelog.plans.application import Application
from tidelog.shared import lookup_join
from tidelog.sources import tables
from tidelog.sources.versions import VersionedTable

_KEPT_STATES = 10
# parts of the table of rows set aside: so many are merged, those of fewer rows than this
_PARTS, _SMALL = 20, 1_000_000

_LISTED = "pipelet bigint, bucket string, n_rows bigint"
_STATUS = (
    "partition string, pipelets array<bigint>, n_rows bigint, first_batch bigint, published_batch bigint, given_up_batch bigint"
)
# the row without a pipelet has the newest bucket that is no longer remembered
_NEWEST = "pipelet bigint, bucket string, first string"
_READY = "partition string, first_batch bigint"

MESSAGE = ("pipelet", "msg_id")


@dataclass
class StreamEtl:
    """One application writing below ``root``, a folder all executors share.

    ``idle_after``, ``give_up_after`` and ``remember`` are minutes of event time.
    """

    spark: SparkSession
    app: Application
    root: str
    table: str | None = None
    keep_batches: int = 10
    idle_after: int | None = None
    give_up_after: int | None = None
    remember: int = 30 * 1440
    keep_versions: int = 10

    def _path(self, kind: str, batch_id: int | None = None) -> str:
        base = f"{self.root.rstrip('/')}/{kind}"
        return base if batch_id is None else f"{base}/batch_id={batch_id}"

    @cached_property
    def public(self) -> VersionedTable:
        """The published table."""
        return VersionedTable(self.spark, self._path("published"), self._event_schema)

    @cached_property
    def _aside(self) -> VersionedTable:
        """Rows of deleted batches that are not published: ``kind`` is bad, late or given_up."""
        own = [T.StructField("kind", T.StringType()), T.StructField("part", T.StringType())]
        return VersionedTable(self.spark, self._path("aside"), T.StructType([*self._staged_schema, *own]), ("kind", "part"))

    def start(self, messages: DataFrame, **trigger) -> StreamingQuery:
        """Run on a streaming frame of ``pipelet, msg_id, body, ingest_ts``.

        The source's own offsets go to the query checkpoint; a restart goes on
        where it stopped.
        """
        writer = messages.writeStream.foreachBatch(self.process).option("checkpointLocation", self._path("checkpoint"))
        return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()

    # -- one micro-batch ---------------------------------------------------

    def process(self, messages: DataFrame, batch_id: int) -> None:
        self._stage(messages, batch_id)
        good = self._staged_batches(batch_id, batch_id).filter("reason is null")
        # a row per pipelet and bucket; the only pass over the batch
        listed = self._save(bucket_counts(good), "listed", batch_id, _LISTED)
        newest = self._newest_after(listed, batch_id)
        status = self._status_after(listed, newest, batch_id)
        progress = shard_progress(newest.filter("pipelet is not null"), self.app.n_pipelets, self.idle_after).first()
        ready = self._save(self._ready(status, progress), "ready", batch_id, _READY)
        first = ready.agg(F.min("first_batch")).first()[0]
        if first is not None:
            self._publish(ready, first, batch_id)
        now = ready.select("partition", F.lit(batch_id).cast("bigint").alias("now"))
        after = lookup_join(status, now, ["partition"])
        after = after.withColumn("published_batch", F.coalesce("published_batch", "now")).drop("now")
        after = after.withColumn("given_up_batch", self._given_up(progress["frontier"], batch_id))
        self._retire(self._save(after.select(*self._names(_STATUS)), "status", batch_id), newest, progress["frontier"], batch_id)

    def _stage(self, messages: DataFrame, batch_id: int) -> None:
        rows = messages.transform(self.app.run)
        stray = ~is_declared(F.col("pipelet"), self.app.n_pipelets)
        reason = F.when(stray, F.coalesce("reason", F.lit("unexpected_pipelet"))).otherwise(F.col("reason"))
        # no shuffle: a batch is a few files, and the order lets a reader that wants
        # some buckets skip the other row groups
        rows = rows.withColumn("reason", reason).sortWithinPartitions("bucket")
        rows.write.mode("overwrite").parquet(self._path("staged", batch_id))

    def _newest_after(self, listed: DataFrame, batch_id: int) -> DataFrame:
        seen = listed.select("pipelet", "bucket", F.col("bucket").alias("first"))
        seen = seen.unionByName(self._load("newest", _NEWEST, batch_id - 1))
        newest = seen.groupBy("pipelet").agg(F.max("bucket").alias("bucket"), F.min("first").alias("first"))
        return self._save(newest, "newest", batch_id, _NEWEST)

    def _status_after(self, listed: DataFrame, newest: DataFrame, batch_id: int) -> DataFrame:
        before = self._load("status", _STATUS, batch_id - 1)
        # a bucket that is no longer remembered does not open again
        horizon = newest.filter("pipelet is null").agg(F.max("bucket").alias("h")).first()["h"]
        listed = listed.filter(F.col("bucket") > F.lit(horizon or ""))
        known = before.select(F.col("partition").alias("bucket"), F.explode("pipelets").alias("pipelet"))
        delivered = deliveries(listed.select("bucket", "pipelet").unionByName(known))
        none = F.lit(None).cast("bigint")
        counts = (
            listed.select(
                F.col("bucket").alias("partition"),
                "n_rows",
                F.lit(batch_id).cast("bigint").alias("first_batch"),
                none.alias("published_batch"),
                none.alias("given_up_batch"),
            )
            .unionByName(before.drop("pipelets"))
            .groupBy("partition")
            .agg(F.sum("n_rows").alias("n_rows"), *(F.min(c).alias(c) for c in ("first_batch", "published_batch", "given_up_batch")))
        )
        status = delivered.join(counts, "partition").select(*self._names(_STATUS))
        return self._save(status, "delivered", batch_id)

    def _ready(self, status: DataFrame, progress) -> DataFrame:
        """Complete, sealed buckets that are neither published nor given up."""
        open_ = status.filter("published_batch is null and given_up_batch is null")
        state = self.spark.createDataFrame([(progress["frontier"], progress["idle"])], "frontier string, idle array<bigint>")
        return complete_but_idle(open_, state, self.app.n_pipelets).select("partition", "first_batch")

    def _given_up(self, frontier: str | None, batch_id: int):
        """When a bucket was given up; not at all if it is published."""
        if self.give_up_after is None or frontier is None:
            return F.col("given_up_batch")
        old = key_minutes(F.lit(frontier)) - key_minutes(F.col("partition")) > self.give_up_after
        return F.when(F.col("published_batch").isNull() & old, F.coalesce("given_up_batch", F.lit(batch_id).cast("bigint"))).otherwise(
            F.col("given_up_batch")
        )

    def _publish(self, ready: DataFrame, first: int, batch_id: int) -> None:
        keys = ready.select(F.col("partition").alias("bucket"))
        rows = lookup_join(self._staged_batches(first, batch_id).filter("reason is null"), keys, ["bucket"], how="left_semi")
        # replays are rare: look for them by their keys, and move whole rows only if there are any
        ids = rows.groupBy(*MESSAGE).agg(F.count("*").alias("n"))
        if not ids.filter("n > 1").isEmpty():
            rows = first_per_key(rows, MESSAGE, F.col("batch_id"))
        self._commit(rows, f"batch-{batch_id}")

    def _commit(self, rows: DataFrame, name: str) -> None:
        self.public.commit(rows.select(*self._event_schema.fieldNames()), name=name)
        self._show(name)
        self.public.vacuum(self.keep_versions)

    def _show(self, name: str) -> None:
        """Let the catalog's table have the partitions of a commit."""
        if self.table is not None:
            changed = self.public.manifest().filter(F.col("commit") == name)
            tables.publish_partitions(self.spark, self.table, f"{self.public.root}/data/commit={name}", changed, replace=True)

    def _retire(self, status: DataFrame, newest: DataFrame, frontier: str | None, batch_id: int) -> None:
        """Set aside the rows of staged batches that no open bucket needs; delete these batches.

        That is done for several batches at a time.
        """
        needed = status.filter("published_batch is null and given_up_batch is null").agg(F.min("first_batch")).first()[0]
        last = min(batch_id - self.keep_batches, batch_id if needed is None else needed - 1)
        fs, path_of = self._files()
        first = last + 1
        while first > 0 and fs.exists(path_of(self._path("staged", first - 1))):
            first -= 1
        if last - first + 1 >= max(1, min(self.keep_batches, 10)):
            rows = self._kinds(self._staged_batches(first, last), status, newest).filter("kind is not null")
            rows = rows.withColumn("part", F.lit(f"{last:012d}"))
            if not rows.isEmpty():
                self._aside.commit(rows, name=f"upto-{last}")
                self._merge_parts(last)
            for b in range(first, last + 1):
                fs.delete(path_of(self._path("staged", b)), True)
            first = last + 1
        if frontier is not None:
            self._remember(status, newest, frontier, first, batch_id)

    def _merge_parts(self, last: int) -> None:
        small = self._aside.manifest().filter(F.col("n_rows") < _SMALL)
        if small.count() > _PARTS:
            rows = lookup_join(self._aside.read(), small.select("kind", "part"), ["kind", "part"], how="left_semi")
            gone = small.select("kind", "part").filter(F.col("part") != f"{last:012d}")
            self._aside.commit(rows.withColumn("part", F.lit(f"{last:012d}")), name=f"merged-{last}", remove=gone)
        self._aside.vacuum(self.keep_versions)

    def _remember(self, status: DataFrame, newest: DataFrame, frontier: str, staged: int, batch_id: int) -> None:
        """Forget buckets that are done and old; the newest of them is noted.

        Batches up to the one that was the last for a bucket are no longer ``staged``, so
        whatever is still found of it is late.
        """
        done = F.col("published_batch").isNotNull() | F.col("given_up_batch").isNotNull()
        settled = F.coalesce("published_batch", "given_up_batch") < staged
        old = key_minutes(F.lit(frontier)) - key_minutes(F.col("partition")) > self.remember
        open_ = status.filter(~done).agg(F.min("partition").alias("p")).first()["p"]
        gone = F.coalesce(done & old & settled, F.lit(False)) & (F.col("partition") < F.lit(open_ or "9"))
        horizon = status.filter(gone).agg(F.max("partition").alias("h")).first()["h"]
        if horizon is None:
            return
        # the batch's own files stay what they are; the next one starts from these
        self._save(status.filter(~gone), "kept", batch_id)
        mark = self.spark.createDataFrame([(None, horizon, horizon)], _NEWEST)
        self._save(newest.filter("pipelet is not null").unionByName(mark), "kept_newest", batch_id, _NEWEST)

    def _kinds(self, rows: DataFrame, status: DataFrame, newest: DataFrame) -> DataFrame:
        """Add ``kind`` to staged rows: bad, late, given_up, or NULL for those published in time."""
        horizon = newest.filter("pipelet is null").agg(F.max("bucket").alias("h")).first()["h"]
        known = status.select(F.col("partition").alias("bucket"), "published_batch", "given_up_batch")
        joined = lookup_join(rows, known, ["bucket"])
        kind = (
            F.when(F.col("reason").isNotNull(), "bad")
            .when(F.col("batch_id") > F.col("published_batch"), "late")
            .when(F.col("given_up_batch").isNotNull(), "given_up")
            .when(F.col("published_batch").isNull() & (F.col("bucket") <= F.lit(horizon or "")), "late")
        )
        return joined.withColumn("kind", kind).select(*rows.columns, "kind")

    # -- state -------------------------------------------------------------

    @staticmethod
    def _names(schema: str) -> list[str]:
        return [c.split()[0] for c in schema.split(", ")]

    def _load(self, kind: str, schema: str, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return self.spark.createDataFrame([], schema)
        kept = {"status": "kept", "newest": "kept_newest"}.get(kind)
        fs, path_of = self._files()
        if kept and fs.exists(path_of(f"{self._path(kept, batch_id)}/_SUCCESS")) and fs.exists(path_of(f"{self._path('kept_newest', batch_id)}/_SUCCESS")):
            kind = kept
        return self.spark.read.schema(schema).parquet(self._path(kind, batch_id))

    def _save(self, df: DataFrame, kind: str, batch_id: int, schema: str = _STATUS) -> DataFrame:
        # a row per bucket or pipelet; adaptive execution gives it as many files as it needs
        df.write.mode("overwrite").parquet(self._path(kind, batch_id))
        self._forget(kind, batch_id - _KEPT_STATES)
        return self.spark.read.schema(schema).parquet(self._path(kind, batch_id))

    def _files(self):
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        return path_of(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path_of

    def _forget(self, kind: str, batch_id: int) -> None:
        if batch_id >= 0:
            fs, path_of = self._files()
            fs.delete(path_of(self._path(kind, batch_id)), True)

    @cached_property
    def _event_schema(self) -> T.StructType:
        messages = "pipelet bigint, msg_id bigint, body string, ingest_ts timestamp_ntz"
        return self.app.run(self.spark.createDataFrame([], messages)).schema

    @property
    def _staged_schema(self) -> T.StructType:
        return T.StructType([*self._event_schema, T.StructField("batch_id", T.LongType())])

    def _staged_batches(self, first: int, last: int) -> DataFrame:
        paths = [self._path("staged", b) for b in range(first, last + 1)]
        return self.spark.read.schema(self._staged_schema).option("basePath", self._path("staged")).parquet(*paths)

    # -- results -----------------------------------------------------------

    def staged(self) -> DataFrame:
        """The rows of the batches that are still staged, with the batch that brought them."""
        fs, path_of = self._files()
        if not fs.exists(path_of(self._path("staged"))):
            return self.spark.createDataFrame([], self._staged_schema)
        return self.spark.read.schema(self._staged_schema).parquet(self._path("staged"))

    def status(self, batch_id: int) -> DataFrame:
        """``partition, pipelets, n_rows, first_batch, published_batch, given_up_batch`` after a batch."""
        return self._load("status", _STATUS, batch_id)

    def published(self, version: int | None = None) -> DataFrame:
        """The public rows; none before the first bucket is complete."""
        return self.public.read(version)

    def _rows(self, kind: str, batch_id: int) -> DataFrame:
        staged = self._kinds(self.staged(), self.status(batch_id), self._load("newest", _NEWEST, batch_id))
        # batches that were set aside, but not yet deleted, count once
        parts = self._aside.manifest().agg(F.max("part").alias("p")).first()["p"]
        staged = staged.filter(F.col("batch_id") > int(parts or -1))
        return self._aside.read().drop("part").unionByName(staged).filter(F.col("kind") == kind).drop("kind")

    def quarantine(self, batch_id: int) -> DataFrame:
        """All rows that have no place in the table, with the reason and the batch."""
        return self._rows("bad", batch_id)

    def late(self, batch_id: int) -> DataFrame:
        """Rows staged after their bucket had been published."""
        return self._rows("late", batch_id)

    def given_up(self, batch_id: int) -> DataFrame:
        """Rows of buckets that were given up."""
        return self._rows("given_up", batch_id)

    def incomplete(self, batch_id: int) -> DataFrame:
        """The status of the buckets that were given up, with the pipelets that are ``missing``."""
        return missing_pipelets(self.status(batch_id).filter("given_up_batch is not null"), self.app.n_pipelets)

    def correct(self, batch_id: int) -> int | None:
        """Merge the late rows known after a batch into the published buckets; the new version.

        Messages that are published already stay as they are.
        """
        late = first_per_key(self.late(batch_id), MESSAGE, F.col("batch_id")).drop("batch_id")
        there = self.public.read().select(*(F.col(c).alias(f"_p_{c}") for c in MESSAGE))
        new = late.join(there, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in MESSAGE], "left_anti")
        if new.isEmpty():
            return self.public.current()
        name = f"correct-{batch_id}"
        version = merge_changes(self.public, additions(new, batch_id), MESSAGE, name=name)
        self._show(name)
        return version
