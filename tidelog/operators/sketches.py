"""Mergeable sketches: frequent unclaimed keys, and how fresh partitions are.

A sketch is made in each task, merged in the shuffle, stored as a row's value, and merged
again with those of other days without a look at the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.shared import lookup_join

# -- frequent keys ---------------------------------------------------------------


def tracked_for(share: float) -> int:
    """Keys that a sketch follows so that none of a share of all occurrences is lost.

    A count is off by at most 3.5 / m of all occurrences, m being the tracked keys; the
    sketch lists a key if its count exceeds twice what it may be off.  Half of the share
    is left in hand.
    """
    if not 0 < share <= 1:
        raise ValueError(f"a share is above 0 and at most 1, not {share}")
    return min(1_000_000, math.ceil(14 / share))


def _keys(events: DataFrame, leftovers: str, by: Sequence[str]) -> DataFrame:
    return events.select(*by, F.explode(F.map_keys(leftovers)).alias("key"))


def key_sketches(events: DataFrame, share: float, leftovers: str = "event_loginfo", by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``sketch``, ``n``: what occurs often among the keys that no rule claimed."""
    sketch = F.call_function("approx_top_k_accumulate", F.col("key"), F.lit(tracked_for(share)))
    return _keys(events, leftovers, by).groupBy(*by).agg(sketch.alias("sketch"), F.count("*").alias("n"))


def merged_key_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as those of the whole, or of coarser groups."""
    return sketches.groupBy(*by).agg(F.call_function("approx_top_k_combine", F.col("sketch")).alias("sketch"), F.sum("n").alias("n"))


def candidate_keys(sketches: DataFrame, share: float) -> DataFrame:
    """(key, n): all keys of at least a share of the ``n`` occurrences, and some of less."""
    listed = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(tracked_for(share)))
    return sketches.select(F.inline(listed), "n").select(F.col("item").alias("key"), "n")


def frequent_keys(events: DataFrame, share: float, leftovers: str = "event_loginfo") -> DataFrame:
    """(key, n_rows): unclaimed keys of at least a share of all their occurrences, counted exactly.

    The sketch names candidates, a bounded number of them; only these are counted, so a
    key per user or per request costs no shuffle of its own.
    """
    found = candidate_keys(key_sketches(events, share, leftovers), share)
    keys = lookup_join(_keys(events, leftovers, ()), found, ["key"], how="inner")
    counts = keys.groupBy("key").agg(F.count("*").alias("n_rows"), F.max("n").alias("n"))
    return counts.filter(F.col("n_rows") >= F.col("n") * share).select("key", "n_rows")


# -- freshness -------------------------------------------------------------------

# of ranks, with 99 % confidence: fixed by the sketch's size
_SIZES = {200: 0.0133, 400: 0.0068, 800: 0.0034}


def rank_error(size: int) -> float:
    """How far the rank of a quantile from a sketch of that size may be off."""
    return _SIZES[size]


def freshness(rows: DataFrame, delay: Column, by: Sequence[str], size: int = 200) -> DataFrame:
    """``by``, ``n``, ``sketch`` of the delays, in whole numbers, from when a row was made to when it was published.

    Rows without a delay do not count.
    """
    known = rows.select(*by, delay.cast("bigint").alias("_delay")).filter("_delay is not null")
    sketch = F.call_function("kll_sketch_agg_bigint", F.col("_delay"), F.lit(size))
    return known.groupBy(*by).agg(F.count("*").alias("n"), sketch.alias("sketch"))


def merged_freshness(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of partitions as those of days, or of all."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.call_function("kll_merge_agg_bigint", F.col("sketch")).alias("sketch"))


def freshness_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each sketch and share a row with the ``delay`` that as many rows do not exceed."""
    found = F.call_function("kll_sketch_get_quantile_bigint", F.col("sketch"), F.array(*(F.lit(float(s)) for s in shares)))
    pairs = F.arrays_zip(F.array(*(F.lit(float(s)) for s in shares)).alias("share"), found.alias("delay"))
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.inline(pairs)).toDF(*others, "share", "delay")
