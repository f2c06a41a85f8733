"""Which shards have delivered a partition, and what may be published.

A delivery list has one row per partition with the sorted array of its pipelets, of
any number.  The bit mask of a partition, which a bigint holds for pipelets 0 to 62,
is a form of output (``mask_of``), not what decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.clock import key_minutes
from tidelog.operators.buckets import bucket_counts, open_bucket, sealed_buckets

MASK_BITS = 63


def deliveries(df: DataFrame, partition: str = "bucket", pipelet: str = "pipelet") -> DataFrame:
    """(partition, pipelets): all pipelets that delivered it, in order.

    Pairs are made distinct first, so that a hot partition is reduced in each task.
    """
    pairs = df.select(F.col(partition).alias("partition"), F.col(pipelet).cast("bigint").alias("pipelet")).distinct()
    return pairs.groupBy("partition").agg(F.sort_array(F.collect_list("pipelet")).alias("pipelets"))


def mask_of(pipelets: Column) -> Column:
    """One bit per pipelet; NULL if one of them has no bit in a bigint."""
    one = F.lit(1).cast("bigint")
    bits = F.aggregate(
        pipelets, F.lit(0).cast("bigint"), lambda m, p: m.bitwiseOR(F.call_function("shiftleft", one, p.cast("int")))
    )
    return F.when(~F.exists(pipelets, lambda p: ~p.between(0, MASK_BITS - 1)), bits)


def full_mask(n_pipelets: int) -> int:
    """The mask of all pipelets."""
    if not 1 <= n_pipelets <= MASK_BITS:
        raise ValueError(f"a mask holds 1 to {MASK_BITS} pipelets, not {n_pipelets}")
    return (1 << n_pipelets) - 1


def completeness_mask(df: DataFrame, partition: str = "bucket", pipelet: str = "pipelet") -> DataFrame:
    """(partition, mask): deliveries as a bit mask; NULL where a pipelet has no bit."""
    return deliveries(df, partition, pipelet).select("partition", mask_of(F.col("pipelets")).alias("mask"))


def _expected(n_pipelets: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n_pipelets - 1).cast("bigint"))


def unexpected_pipelets(listed: DataFrame, n_pipelets: int) -> DataFrame:
    """(partition, pipelet) of deliveries by pipelets outside ``0..n_pipelets - 1``: error rows."""
    outside = F.filter("pipelets", lambda p: ~p.between(0, n_pipelets - 1))
    return listed.select("partition", F.explode(outside).alias("pipelet"))


def complete_partitions(listed: DataFrame, n_pipelets: int) -> DataFrame:
    """Partitions that exactly the expected pipelets delivered; one too many is an error, not complete."""
    return listed.filter(F.col("pipelets") == _expected(n_pipelets))


def missing_pipelets(listed: DataFrame, n_pipelets: int) -> DataFrame:
    """Add ``missing``, the array of pipelets that have not delivered yet."""
    return listed.withColumn("missing", F.array_except(_expected(n_pipelets), F.col("pipelets")))


def upsert_status(status: DataFrame, delivered: DataFrame) -> DataFrame:
    """Status ``(partition, pipelets)`` after more deliveries ``(partition, pipelet)``."""
    known = status.select("partition", F.explode("pipelets").alias("pipelet"))
    return deliveries(known.unionByName(delivered.select("partition", "pipelet")), "partition")


def is_declared(pipelet: Column, n_pipelets: int) -> Column:
    """Whether a row comes from one of the pipelets ``0..n_pipelets - 1``; rows of others are errors."""
    return F.coalesce(pipelet.between(0, n_pipelets - 1), F.lit(False))


def shard_progress(newest: DataFrame, n_pipelets: int, idle_after: int | None = None) -> DataFrame:
    """One row ``n_pipelets, frontier, idle`` from every pipelet's newest ``bucket`` and its ``first`` one.

    Only declared pipelets count.  ``idle`` lists those whose newest bucket lies more than
    ``idle_after`` minutes behind the newest of all, and those that never showed up in as
    long a time: nobody waits for them.  All others have reached ``frontier``; it is NULL
    while one of them has not shown up.
    """
    known = newest.filter(is_declared(F.col("pipelet"), n_pipelets))
    listed = known.agg(
        F.count("*").alias("n_pipelets"),
        F.max("bucket").alias("last"),
        F.min("first").alias("first"),
        F.collect_list(F.struct(F.col("pipelet").cast("bigint").alias("pipelet"), "bucket")).alias("shards"),
    )
    idle = _idle(F.col("shards"), F.col("first"), F.col("last"), n_pipelets, idle_after)
    active = F.filter("shards", lambda s: ~F.array_contains(F.col("idle"), s["pipelet"]))
    out = listed.select("n_pipelets", "shards", idle.alias("idle"))
    whole = F.size(active) + F.size("idle") == n_pipelets
    return out.select("n_pipelets", F.when(whole, F.array_min(F.transform(active, lambda s: s["bucket"]))).alias("frontier"), "idle")


def _idle(shards: Column, first: Column, last: Column, n_pipelets: int, idle_after: int | None) -> Column:
    if idle_after is None:
        return F.array().cast("array<bigint>")
    seen = F.map_from_entries(shards)
    # one that never showed up is as old as the first bucket of all
    return F.filter(
        _expected(n_pipelets), lambda p: key_minutes(last) - key_minutes(F.coalesce(F.try_element_at(seen, p), first)) > idle_after
    )


def min_progress(df: DataFrame, n_pipelets: int | None = None, idle_after: int | None = None) -> DataFrame:
    """(n_pipelets, frontier): every pipelet has reached ``frontier``.

    With ``n_pipelets`` the declared ones only, as :func:`shard_progress` has it.
    """
    newest = df.groupBy("pipelet").agg(F.max("bucket").alias("bucket"), F.min("bucket").alias("first"))
    if n_pipelets is None:
        return newest.agg(F.count("*").alias("n_pipelets"), F.min("bucket").alias("frontier"))
    return shard_progress(newest, n_pipelets, idle_after).select("n_pipelets", "frontier")


def publishable(df: DataFrame, n_pipelets: int, idle_after: int | None = None) -> DataFrame:
    """(partition, pipelets) of the buckets that all pipelets delivered and sealed.

    Rows of pipelets that were not declared do not count.  Nobody waits for pipelets that
    are idle: their buckets are all sealed, and others need nothing of them.
    """
    own = df.filter(is_declared(F.col("pipelet"), n_pipelets))
    if idle_after is None:
        return complete_partitions(deliveries(sealed_buckets(own)), n_pipelets)
    # lists, with a row per pipelet and bucket
    listed = own.transform(bucket_counts)
    newest = listed.groupBy("pipelet").agg(F.max("bucket").alias("bucket"), F.min("bucket").alias("first"))
    state = shard_progress(newest, n_pipelets, idle_after)
    return complete_but_idle(deliveries(listed), state, n_pipelets)


def complete_but_idle(listed: DataFrame, state: DataFrame, n_pipelets: int) -> DataFrame:
    """Partitions that all but idle pipelets have delivered, and sealed: those before the frontier."""
    known = state.select(F.lit(True).alias("s_one"), *(F.col(c).alias(f"s_{c}") for c in ("frontier", "idle")))
    met = listed.withColumn("s_key", F.lit(True)).join(known, F.col("s_key") == F.col("s_one"))
    lacking = F.array_except(F.array_except(_expected(n_pipelets), F.col("pipelets")), F.col("s_idle"))
    return met.filter((F.size(lacking) == 0) & (F.col("partition") < F.col("s_frontier"))).select(*listed.columns)


def publication_status(df: DataFrame, n_pipelets: int) -> DataFrame:
    """Per partition: the pipelets that delivered, that sealed, and whether it is public."""
    listed = df.transform(bucket_counts).transform(open_bucket)
    # the list has one row per pipelet and bucket
    sealed = F.when(F.col("bucket") < F.col("newest"), F.col("pipelet").cast("bigint"))
    return (
        listed.groupBy(F.col("bucket").alias("partition"))
        .agg(
            F.sort_array(F.collect_list(F.col("pipelet").cast("bigint"))).alias("delivered"),
            F.sort_array(F.collect_list(sealed)).alias("sealed"),
            F.sum("n_rows").alias("n_rows"),
        )
        .withColumn("is_public", F.col("sealed") == _expected(n_pipelets))
    )
