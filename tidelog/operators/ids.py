"""Sets of message ids as intervals: gaps, low-water marks, and what has been seen.

Ids of a pipelet are cut into blocks.  A block's ids become a bitmap in each task, so that
what is shuffled does not grow with repeats; runs of set bits are its intervals, and
intervals that meet at the borders of blocks are joined: first those of a thousand blocks,
then those of a pipelet.  One pipelet is many tasks' work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ids of a block: the bits of one bitmap
BLOCK = 32768

INTERVALS = "pipelet bigint, lo bigint, hi bigint"
SEEN = "pipelet bigint, block bigint, lo bigint, hi bigint"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of set bits of each bitmap."""
    for batch in batches:
        owner, lo, hi = [], [], []
        blocks = batch.column(1).to_numpy(zero_copy_only=False)
        for i, bits in enumerate(batch.column(2).to_pylist()):
            padded = np.zeros(8 * len(bits) + 2, np.int8)
            padded[1:-1] = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
            edges = np.flatnonzero(np.diff(padded)) + blocks[i] * BLOCK
            owner.append(np.full(len(edges) // 2, i))
            lo.append(edges[::2])
            hi.append(edges[1::2] - 1)
        none = [np.empty(0, np.int64)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.concatenate(owner or none))), pa.array(np.concatenate(lo or none)), pa.array(np.concatenate(hi or none))],
            names=["pipelet", "lo", "hi"],
        )


def _joined(intervals: DataFrame, *part) -> DataFrame:
    """Intervals of a part that overlap or follow each other as one."""
    keys = ["pipelet", *part]
    ahead = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    starts = (F.col("lo") > F.max("hi").over(ahead) + 1) | F.max("hi").over(ahead).isNull()
    numbered = intervals.withColumn("_new", starts.cast("bigint"))
    running = Window.partitionBy(*keys).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)
    numbered = numbered.withColumn("_island", F.sum("_new").over(running))
    return numbered.groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def intervals(messages: DataFrame, pipelet: str = "pipelet", msg_id: str = "msg_id") -> DataFrame:
    """(pipelet, lo, hi): the longest runs of ids that are there, repeats counted once.

    Null ids are none; a null pipelet is one.
    """
    ids = messages.select(F.col(pipelet).cast("bigint").alias("pipelet"), F.col(msg_id).cast("bigint").alias("id")).filter("id is not null")
    block = F.expr(f"(id - pmod(id, {BLOCK})) div {BLOCK}").alias("block")
    bits = ids.groupBy("pipelet", block).agg(F.bitmap_construct_agg(F.expr(f"pmod(id, {BLOCK})")).alias("bits"))
    runs = bits.mapInArrow(_runs, INTERVALS)
    near = runs.withColumn("_part", F.expr(f"(lo - pmod(lo, {1000 * BLOCK}L)) div {1000 * BLOCK}L"))
    return _joined(_joined(near, "_part").select("pipelet", "lo", "hi"))


def gaps(found: DataFrame) -> DataFrame:
    """(pipelet, lo, hi) of the ids that are missing between intervals."""
    following = F.lead("lo").over(Window.partitionBy("pipelet").orderBy("lo"))
    ahead = found.withColumn("_next", following).filter("_next is not null")
    return ahead.select("pipelet", (F.col("hi") + 1).alias("lo"), (F.col("_next") - 1).alias("hi"))


def low_water(found: DataFrame, first: int | None = None) -> DataFrame:
    """(pipelet, msg_id): the last id before which none is missing.

    Counted from ``first``, or from each pipelet's first id that is there.  With ``first``
    a pipelet that lacks it has none: ``first - 1``.
    """
    if first is None:
        return found.groupBy("pipelet").agg(F.min(F.struct("lo", "hi"))["hi"].alias("msg_id"))
    there = F.max(F.when(F.lit(first).between(F.col("lo"), F.col("hi")), F.col("hi")))
    return found.groupBy("pipelet").agg(F.coalesce(there, F.lit(first - 1)).alias("msg_id"))


# -- what has been seen ----------------------------------------------------------


def nothing_seen(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SEEN)


def unseen(messages: DataFrame, seen: DataFrame, keys: tuple[str, str] = ("pipelet", "msg_id")) -> DataFrame:
    """The messages whose ids are not in the set.

    ``seen`` has one row without a block per pipelet, up to which every id has been seen,
    and intervals beyond it by block: a message meets one row of the first kind, and those
    of its own block.
    """
    columns = messages.columns
    marks = seen.filter("block is null").select(F.col("pipelet").alias("_m_pipelet"), F.col("hi").alias("_m_hi"))
    rest = seen.filter("block is not null").select(*(F.col(c).alias(f"_s_{c}") for c in seen.columns))
    p, i = (F.col(k) for k in keys)
    left = messages.join(marks, p.eqNullSafe(F.col("_m_pipelet")), "left")
    left = left.filter(F.col("_m_hi").isNull() | (i > F.col("_m_hi"))).select(*columns)
    block = F.expr(f"(`{keys[1]}` - pmod(`{keys[1]}`, {BLOCK})) div {BLOCK}")
    there = p.eqNullSafe(F.col("_s_pipelet")) & (block == F.col("_s_block")) & i.between(F.col("_s_lo"), F.col("_s_hi"))
    return left.join(rest, there, "left_anti")


def absorb(seen: DataFrame, messages: DataFrame, first: int = 0, keys: tuple[str, str] = ("pipelet", "msg_id")) -> DataFrame:
    """The set after the messages; ids below ``first`` do not occur.

    What closes up from ``first`` on is one row of its pipelet, whatever its length.
    """
    new = intervals(messages, *keys)
    every = _joined(seen.select("pipelet", "lo", "hi").unionByName(new))
    closed = every.filter(F.lit(first).between(F.col("lo"), F.col("hi")))
    marks = closed.select("pipelet", F.lit(None).cast("bigint").alias("block"), F.lit(first).cast("bigint").alias("lo"), "hi")
    beyond = every.filter(F.col("lo") > first)
    at = F.explode(F.expr(f"sequence((lo - pmod(lo, {BLOCK})) div {BLOCK}, (hi - pmod(hi, {BLOCK})) div {BLOCK})")).alias("block")
    cut = beyond.select("pipelet", "lo", "hi", at)
    cut = cut.select(
        "pipelet", "block", F.greatest("lo", F.col("block") * BLOCK).alias("lo"), F.least("hi", (F.col("block") + 1) * BLOCK - 1).alias("hi")
    )
    return marks.unionByName(cut)
