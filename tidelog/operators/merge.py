"""Merge increments into a snapshot; remove replayed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark prunes to one candidate per key in each map task (a partial window
    group limit), so a key that holds a third of the rows costs no more than
    any other behind the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def union_inputs(increment: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Both inputs as one, with ``is_increment``."""
    return increment.withColumn("is_increment", F.lit(1)).unionByName(
        snapshot.withColumn("is_increment", F.lit(0))
    )


def _newest_first(df: DataFrame, version: str) -> list[Column]:
    """Newest version first; equal versions by a hash of the row, then by its columns, so that reruns agree.

    Columns with maps at any depth are left out: maps have no order.
    """
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    return [F.desc(version), F.xxhash64(*plain), *(F.col(f"`{c}`") for c in plain)]


def snapshot_merge(
    increment: DataFrame, snapshot: DataFrame, keys: Sequence[str], version: str, unique: bool = True
) -> DataFrame:
    """New snapshot: an increment row replaces the old row of its key.

    Of several increment rows the highest ``version`` stays.  The snapshot is not
    shuffled for a small increment: its rows stay but for keys that the increment
    has.  It has one row per key, as a merge leaves it; if it may have more, say
    ``unique=False``, and the highest version of each key stays.  Null keys are keys.
    """
    new = first_per_key(increment, keys, *_newest_first(increment, version))
    if not unique:
        snapshot = first_per_key(snapshot, keys, *_newest_first(snapshot, version))
    changed = new.select(*(F.col(k).alias(f"_new_{k}") for k in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    return snapshot.join(changed, same, "left_anti").unionByName(new)


def write_snapshot(df: DataFrame, target: str) -> None:
    """Write a snapshot; an existing target is kept under a ``.bak`` name.

    The new one is written beside the target, then both are renamed.  Between the two
    renames readers find no target; if the second fails, the first is undone and an
    error is raised, as it is if the first fails.
    """
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    path = path_of(target.rstrip("/"))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        df.write.parquet(target)
        return
    # the plan may read the target
    new = path_of(f"{path}.new")
    df.write.mode("overwrite").parquet(new.toString())
    n, backup = 0, path_of(f"{path}.bak")
    while fs.exists(backup):
        n, backup = n + 1, path_of(f"{path}.bak{n + 1}")
    if not fs.rename(path, backup):
        raise OSError(f"{path} cannot be renamed to {backup}; the new snapshot is at {new}")
    if not fs.rename(new, path):
        undone = fs.rename(backup, path)
        raise OSError(f"{new} cannot be renamed to {path}; the old one is at {path if undone else backup}")


def dedupe_replay(
    df: DataFrame, keys: Sequence[str] = ("pipelet", "msg_id"), order: Sequence[str] = ()
) -> DataFrame:
    """One row per message.

    A pipe delivers at least once: a crash between writing a row and saving its
    position sends the message again.  ``order`` says which copy stays; without
    it the copies are taken to be equal.
    """
    if not order:
        return df.dropDuplicates(list(keys))
    plain = [c for c, kind in df.dtypes if not kind.startswith("map")]
    return first_per_key(df, keys, *(F.col(c) for c in order), F.xxhash64(*plain))


def dedupe_stream(df: DataFrame, ts: str, delay: str, keys: Sequence[str] = ("pipelet", "msg_id")) -> DataFrame:
    """The same on a stream, with state kept for ``delay`` behind the newest event."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
