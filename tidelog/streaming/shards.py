"""Progress of shards in Spark's state store: which buckets are sealed, and who is idle.

Every pipelet has its newest bucket and its open ones as state.  A newer bucket seals those
before it.  The watermark lies ``idle_after`` behind the newest bucket of all pipelets; a
pipelet that it passes is idle: a timer seals what it has open and says so.  Rows that are
older than the watermark are late, and Spark leaves them out.

What comes out is a list, one row per pipelet and bucket and one per spell of idleness;
:func:`publishable_after` reads from it what may be published, as the batch operator
``publishable`` does from the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.progress import is_declared

SEALED = "pipelet bigint, kind string, bucket string, n_rows bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# fixed value: the provider that keeps typed state and timers
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ShardProgress(StatefulProcessor):
    """Rows ``pipelet, kind, bucket, n_rows`` of one pipelet: ``sealed`` buckets, and ``idle`` at its newest."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "bucket string, start bigint")
        self.open = handle.getMapState("open", "bucket string", "n_rows bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.newest.get() if self.newest.exists() else None
        newest, start = before or (None, 0)
        # a row per bucket and Arrow batch: the state is asked once for each bucket
        more: dict[str, int] = {}
        for row in rows:
            more[row.bucket] = more.get(row.bucket, 0) + row.n_rows
            if newest is None or row.bucket > newest:
                newest, start = row.bucket, int(row.start.timestamp() * 1000)
        for bucket, n in more.items():
            at = (bucket,)
            known = self.open.getValue(at)[0] if self.open.containsKey(at) else 0
            self.open.updateValue(at, (known + n,))
        if before is None or newest != before[0]:
            self.newest.update((newest, start))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # the watermark passes the bucket's start
            self.handle.registerTimer(start + 1)
        yield from self._seal(key, newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest = self.newest.get()[0]
        yield from self._seal(key, None)
        yield Row(pipelet=key[0], kind="idle", bucket=newest, n_rows=0)

    def _seal(self, key, newest: str | None) -> Iterator[Row]:
        done = sorted(k[0] for k in self.open.keys() if newest is None or k[0] < newest)
        for bucket in done:
            yield Row(pipelet=key[0], kind="sealed", bucket=bucket, n_rows=self.open.getValue((bucket,))[0])
            self.open.removeKey((bucket,))

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's rows per pipelet and bucket: few of them go to the state."""
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(["pipelet", "bucket", "start"]).aggregate([([], "count_all")])
        counts = counts.rename_columns(["pipelet", "bucket", "start", "n_rows"])
        yield from counts.set_column(3, "n_rows", pc.cast(counts.column("n_rows"), pa.int64())).to_batches()


def needs_state_store(spark: SparkSession) -> None:
    """Typed state and timers are kept by one of Spark's providers only; a session that has chosen another is left alone."""
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKS)


def sealed_stream(rows: DataFrame, n_pipelets: int, idle_after: int) -> DataFrame:
    """``pipelet, kind, bucket, n_rows`` of a stream of rows with ``pipelet`` and ``bucket``.

    Rows of pipelets that are not declared take no part.  A bucket that is sealed again,
    as its pipelet came back to it, has a further row.
    """
    needs_state_store(rows.sparkSession)
    own = rows.filter(is_declared(F.col("pipelet"), n_pipelets) & F.col("bucket").isNotNull())
    start = F.to_timestamp("bucket", "yyyyMMddHHmm")
    listed = own.select(F.col("pipelet").cast("bigint").alias("pipelet"), "bucket", start.alias("start"))
    counted = listed.mapInArrow(_counted, "pipelet bigint, bucket string, start timestamp, n_rows bigint")
    marked = counted.withWatermark("start", f"{idle_after} minutes")
    return marked.groupBy("pipelet").transformWithState(ShardProgress(), SEALED, "Append", "EventTime")


def publishable_after(sealed: DataFrame, n_pipelets: int) -> DataFrame:
    """(partition, pipelets) that all pipelets have sealed, but for those that are idle.

    A pipelet is idle that has sealed nothing behind the bucket at which it fell silent.
    """
    last = sealed.groupBy("pipelet").agg(
        F.max(F.when(F.col("kind") == "idle", F.col("bucket"))).alias("silent"), F.max(F.when(F.col("kind") == "sealed", F.col("bucket"))).alias("last")
    )
    idle = last.filter("silent is not null and (last is null or last <= silent)")
    none = F.array().cast("array<bigint>")
    idle = idle.agg(F.coalesce(F.collect_list("pipelet"), none).alias("idle"))
    delivered = sealed.filter("kind = 'sealed'").groupBy(F.col("bucket").alias("partition")).agg(F.collect_set("pipelet").alias("done"))
    met = delivered.withColumn("k", F.lit(0)).join(idle.withColumn("k_idle", F.lit(0)), F.col("k") == F.col("k_idle"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(n_pipelets - 1).cast("bigint"))
    lacking = F.array_except(F.array_except(every, F.col("done")), F.col("idle"))
    return met.filter(F.size(lacking) == 0).select("partition", F.sort_array("done").alias("pipelets"))
