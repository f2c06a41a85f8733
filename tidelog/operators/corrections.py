"""Changes of published rows: a log of additions and retractions, merged bucket by bucket.

A log has the rows' columns, ``op`` (``+`` or ``-``) and ``seq``.  Of several entries of a
key the one with the highest ``seq`` holds, an addition before a retraction of the same
``seq``: a row that moves to another partition is a retraction from the one and an
addition to the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.merge import first_per_key
from tidelog.sources.versions import VersionedTable

LOG = ("op", "seq")


def additions(rows: DataFrame, seq: int) -> DataFrame:
    """Rows as entries that add them, or take the place of a row with their key."""
    return rows.select("*", F.lit("+").alias("op"), F.lit(seq).cast("bigint").alias("seq"))


def retractions(rows: DataFrame, seq: int) -> DataFrame:
    """Rows as entries that take them away."""
    return rows.select("*", F.lit("-").alias("op"), F.lit(seq).cast("bigint").alias("seq"))


def difference(before: DataFrame, after: DataFrame, keys: Sequence[str], seq: int) -> DataFrame:
    """The log that makes ``after`` of ``before``: only rows that differ are in it."""
    columns = before.columns
    new, old = after.select(*columns).exceptAll(before), before.exceptAll(after.select(*columns))
    return additions(new, seq).unionByName(retractions(old, seq))


def apply_changes(rows: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows after the changes.

    Rows without entries are not shuffled for a small log.  Null keys are keys.
    """
    last = first_per_key(log, keys, F.desc("seq"), F.col("op"))
    named = last.select(*(F.col(k).alias(f"_l_{k}") for k in keys))
    kept = rows.join(named, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys], "left_anti")
    return kept.unionByName(last.filter("op = '+'").drop(*LOG).select(*rows.columns))


def merge_changes(table: VersionedTable, log: DataFrame, keys: Sequence[str], name: str | None = None) -> int:
    """A version of the table with the changes in it: only the partitions of the log are written.

    A partition that loses all of its rows goes.
    """
    touched = log.select(*table.keys).distinct()
    named = touched.select(*(F.col(k).alias(f"_t_{k}") for k in table.keys))
    on = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in table.keys]
    rows = table.read().join(named, on, "left_semi")
    return table.commit(apply_changes(rows, log, keys), name=name, remove=touched)
