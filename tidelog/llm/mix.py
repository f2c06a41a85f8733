"""Mixing sources to target weights by entropy balancing.

Every document starts at a rate of one copy, may have at most two, and the rates of
a source must give its target in words.  Of all such rates the closest to one, by
the entropy of ``rate / 2``, are ``2 * sigmoid(lambda * size)``: exponentially tilted
by document size, with one ``lambda`` per source.  Newton steps on the convex dual
find it.  They need only how many documents of each size a source has, which is
counted once; a step is one aggregation of those counts.

Rates become whole copies by systematic rounding along a fixed random order.  What a
source is then off its target is made up by the first documents of that order, the
last of them in part; so a source's words are its target, rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import hash_block, packed, running_total, saved

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
LIMIT = 2  # copies of a document, and times a source
NEWTON_STEPS, LARGEST = 60, 1e6
BLOCKS = 512
RATE_UNIT = 1 << 30

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_no, source_size, n_docs, target`` per source.

    Sources are numbered by code point, null last; weights repeat along that order.
    Targets are shares by weight of ``share`` times all words; a source stops at
    ``LIMIT`` times its size, and the others share the excess by weight.  The level
    at which words per weight come to rest is found along the sources in the order
    in which they stop, so no rounds are needed.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    numbered = per.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    cycle = F.array(*map(F.lit, weights))
    weighted = numbered.withColumn("_weight", F.get(cycle, (F.col("source_no") - 1) % len(weights)).cast("double"))
    weighted = weighted.withColumn("_most", (F.col("source_size") * LIMIT).cast("double"))
    by_stop = Window.orderBy(F.col("_most") / F.col("_weight"), "source_no")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    levelled = weighted.withColumn("_level", left / F.sum("_weight").over(onward))
    rests = F.when(F.col("_level") * F.col("_weight") <= F.col("_most"), F.col("_level"))
    levelled = levelled.withColumn("_rest", F.first(rests, ignorenulls=True).over(everything))
    target = F.least(F.col("_most"), F.coalesce(F.col("_rest") * F.col("_weight"), F.col("_most")))
    return levelled.select("source", "source_no", "source_size", "n_docs", target.alias("target"))


def _rate(tilt: Column, x: Column) -> Column:
    return LIMIT / (1 + F.exp(-F.least(F.greatest(tilt * x, F.lit(-500.0)), F.lit(500.0))))


def tilts(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """``source_no, tilt`` that meet the targets; tilts are per average document size.

    ``counts`` has ``source_no, size, n``.  Sources at their limit get the largest
    tilt, those with a target of 0 the smallest.  Newton steps stay within a bracket
    and fall back to halving it.  Terms are added as decimals, so that the result
    does not depend on the order of tasks.
    """
    base = targets.select(
        "source_no", "target", (F.col("source_size") / F.greatest("n_docs", F.lit(1))).alias("unit"), F.col("source_size").alias("total")
    )
    done = (F.col("target") >= LIMIT * F.col("total")) | (F.col("target") <= 0)
    state = base.select(
        "source_no",
        "target",
        F.when(F.col("unit") > 0, F.col("unit")).otherwise(1.0).alias("unit"),
        F.when(~done, 0.0).when(F.col("target") > 0, LARGEST).otherwise(-LARGEST).alias("tilt"),
        F.lit(-LARGEST).alias("low"),
        F.lit(LARGEST).alias("high"),
        done.alias("done"),
    )
    state = saved(state, "tilts")
    for _ in range(NEWTON_STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        x = F.col("size") / F.col("unit")
        rate = _rate(F.col("tilt"), x)
        words = F.col("n") * F.col("size")
        sums = (
            counts.join(state.filter(~F.col("done")).select("source_no", "tilt", "unit"), "source_no")
            .select("source_no", (words * rate).alias("value"), (words * x * rate * (1 - rate / LIMIT)).alias("slope"))
            .groupBy("source_no")
            .agg(*(F.sum(F.col(c).cast("decimal(38,6)")).cast("double").alias(c) for c in ("value", "slope")))
        )
        stepped = state.join(sums, "source_no", "left")
        off = F.col("value") - F.col("target")
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        stepped = stepped.withColumn("_low", low).withColumn("_high", high)
        newton = F.col("tilt") - off / F.when(F.col("slope") > 1e-9, F.col("slope"))
        inside = (newton > F.col("_low")) & (newton < F.col("_high"))
        following = F.when(inside, newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        near = F.abs(off) <= F.greatest(F.lit(0.01), 1e-9 * F.col("target"))
        state = saved(
            stepped.select(
                "source_no",
                "target",
                "unit",
                F.when(F.col("done") | near, F.col("tilt")).otherwise(following).alias("tilt"),
                F.when(F.col("done"), F.col("low")).otherwise(F.col("_low")).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(F.col("_high")).alias("high"),
                (F.col("done") | F.coalesce(near, F.lit(True))).alias("done"),
            ),
            "tilts",
        )
    return state.select("source_no", "tilt", "unit")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``doc_id, row_key, size, source_size, target, taken`` of every document.

    ``taken`` is the number of words the mix takes of a document, repeats counted, at
    most twice its size.  ``row_key`` hashes id, source and text.  Null texts have no
    words, null sources are a source, null ids are ids; every row counts by itself.
    Texts are not shuffled.
    """
    row_key = F.xxhash64("doc_id", "source", "text")
    sizes = saved(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row_key.alias("row_key")), "sizes")
    targets = saved(source_targets(sizes, weights, share), "targets")
    known = F.struct(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("n"))
    keyed = targets.select(known.alias("_source"), "source_no", "source_size", "target")
    rows = sizes.withColumn("_source", known).join(keyed, "_source").drop("_source")
    counts = saved(rows.groupBy("source_no", "size").agg(F.count("*").alias("n")), "counts")
    rows = rows.join(tilts(counts, targets), "source_no")
    rate = F.when(F.col("size") == 0, LIMIT / 2).otherwise(_rate(F.col("tilt"), F.col("size") / F.col("unit")))
    rows = rows.select(
        "doc_id", "row_key", "size", "source_no", "source_size", "target",
        F.round(rate * RATE_UNIT).cast("bigint").alias("rate"),
        hash_block(F.col("row_key"), BLOCKS),
    )
    order = ["row_key", "doc_id", "size"]
    rows = saved(running_total(rows, ["source_no"], "block", order, F.col("rate"), "rates_before"), "rates")
    whole = F.floor((F.col("rates_before") + F.col("rate") + RATE_UNIT // 2) / RATE_UNIT) - F.floor(
        (F.col("rates_before") + RATE_UNIT // 2) / RATE_UNIT
    )
    rows = rows.withColumn("copied", F.least(whole, F.lit(LIMIT)).cast("bigint") * F.col("size"))
    spare = LIMIT * F.col("size") - F.col("copied")
    rows = running_total(rows, ["source_no"], "block", order, F.col("copied"), "copied_before", "source_copied")
    rows = running_total(rows, ["source_no"], "block", order, spare, "spare_before")
    lacking = F.round("target").cast("bigint") - F.col("source_copied")
    rows = rows.withColumn("lacking", lacking).withColumn("more", F.col("lacking") > 0)
    room = F.when(F.col("more"), LIMIT * F.col("size") - F.col("copied")).otherwise(F.col("copied"))
    before = F.when(F.col("more"), F.col("spare_before")).otherwise(F.col("copied_before"))
    change = F.greatest(F.lit(0), F.least(room, F.abs("lacking") - before))
    taken = F.col("copied") + F.when(F.col("more"), change).otherwise(-change)
    return rows.select("doc_id", "row_key", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix itself: whole documents, repeated as often as the mix takes them; columns as before.

    What the mix takes of a document in part is rounded to a whole copy or none, so a
    source may miss its target by half a document.  Empty documents stay, once.
    """
    # equal rows share their copies, the first of them one more each if these do not divide
    taken = mix(docs, weights, share).groupBy("row_key").agg(
        F.sum("taken").alias("all_taken"), F.count("*").alias("many"), F.max("size").alias("size")
    )
    whole = F.floor(F.col("all_taken") / F.greatest("size", F.lit(1)) + 0.5)
    taken = taken.select("row_key", "many", F.when(F.col("size") == 0, F.col("many")).otherwise(F.least(whole, LIMIT * F.col("many"))).alias("copies"))
    rows = packed(docs, "doc_id", "source", "text").withColumn("row_key", F.xxhash64("doc_id", "source", "text"))
    same = Window.partitionBy("row_key").orderBy("doc_id", "source", "text")
    joined = rows.join(taken, "row_key").withColumn("place", F.row_number().over(same))
    each = F.floor(F.col("copies") / F.col("many"))
    own = each + (F.col("place") <= F.col("copies") - each * F.col("many")).cast("int")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), own.cast("int")))).select("row.*")
