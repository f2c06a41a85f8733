"""Event-time buckets: open, sealed and late ones, and the bucket calendar.

The unit below is the *bucket list*: one row per shard (pipelet) and bucket.
It is bounded by the calendar, not by the data, so windows over it are small
even where one shard or bucket holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.clock import compact, two_digits
from tidelog.shared import lookup_join


def bucket_counts(df: DataFrame) -> DataFrame:
    """Rows per (pipelet, bucket)."""
    return df.groupBy("pipelet", "bucket").agg(F.count("*").alias("n_rows"))


def open_bucket(buckets: DataFrame) -> DataFrame:
    """Add ``newest``, the newest and so still open bucket of the pipelet."""
    w = Window.partitionBy("pipelet")
    return buckets.withColumn("newest", F.max("bucket").over(w))


def all_but_latest(buckets: DataFrame) -> DataFrame:
    """Buckets that a newer one of the same pipelet has sealed."""
    return open_bucket(buckets).filter("bucket < newest").drop("newest")


def sealed_buckets(df: DataFrame) -> DataFrame:
    """(pipelet, bucket, n_rows) of the sealed buckets of a table of rows."""
    return df.transform(bucket_counts).transform(all_but_latest)


def late_flag(df: DataFrame, arrival: tuple[str, ...] = ("arrival", "msg_id")) -> DataFrame:
    """Add ``is_late``: the pipelet had shown a newer bucket before this row.

    The moment a bucket closes is the first arrival of any newer bucket.  It
    comes from the bucket list, so rows are neither sorted nor shuffled.
    """
    moment = F.struct(*arrival)
    first = df.groupBy("pipelet", "bucket").agg(F.min(moment).alias("first"))
    newer = (
        Window.partitionBy("pipelet").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    )
    closes = first.select("pipelet", "bucket", F.min("first").over(newer).alias("_closes"))
    joined = lookup_join(df, closes, ["pipelet", "bucket"])
    return joined.select(*df.columns, F.coalesce(moment > F.col("_closes"), F.lit(False)).alias("is_late"))


def late_rows(df: DataFrame, arrival: tuple[str, ...] = ("arrival", "msg_id")) -> DataFrame:
    """The rows that came after their bucket had closed."""
    return late_flag(df, arrival).filter("is_late").drop("is_late")


def day_calendar(days: DataFrame, width: int, day: str = "event_day") -> DataFrame:
    """All buckets of the given days (``YYYYMMDD``): hour by hour, ``width`` minutes each."""
    hours = days.select(day, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
    minutes = hours.select("*", F.explode(F.sequence(F.lit(0), F.lit(59), F.lit(width))).alias("_m"))
    return minutes.select(
        F.col(day).alias("event_day"),
        two_digits(F.col("_h")).alias("event_hour"),
        two_digits(F.col("_m")).alias("event_minute"),
    )


def day_range(first: Column, last: Column) -> Column:
    """Array of days ``YYYYMMDD`` from first to last."""
    days = F.sequence(first.cast("date"), last.cast("date"), F.expr("INTERVAL 1 DAY"))
    return F.transform(days, lambda d: compact(d, 8))


def bucket_order(buckets: DataFrame) -> DataFrame:
    """Add ``place``: of the list, 1 to its length, by pipelet, then bucket.

    Places within a pipelet are counted pipelet by pipelet; counts, a row per pipelet,
    tell how many entries come before.
    """
    running = Window.orderBy("pipelet").rowsBetween(Window.unboundedPreceding, 0)
    counts = buckets.groupBy("pipelet").agg(F.count("*").alias("n"))
    before = counts.select("pipelet", (F.sum("n").over(running) - F.col("n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("pipelet").orderBy("bucket")) + F.col("_before")
    joined = lookup_join(buckets, before, ["pipelet"])
    return joined.withColumn("place", place.cast("bigint")).drop("_before")


def done_filter(files: DataFrame) -> DataFrame:
    """Entries of the inventory (``state``) that are not marked done."""
    return files.filter(F.coalesce(F.col("state") != "done", F.lit(True)))


def minus_done(buckets: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("pipelet", "bucket")) -> DataFrame:
    """The bucket list less those that the list of done ones has."""
    return buckets.join(done.select(*keys), list(keys), "left_anti")


def partition_gaps(calendar: DataFrame, published: DataFrame) -> DataFrame:
    """Calendar partitions that were never published."""
    return calendar.join(published, ["event_day", "event_hour", "event_minute"], "left_anti")
