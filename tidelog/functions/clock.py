"""Event time and partition keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STAMP = r"^\d{2}-\d{2} ([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"


def two_digits(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def floor_minute(minute: Column, width: int) -> Column:
    """Minute of the hour rounded down to ``width``, two digits.

    It starts again every hour, so a width that does not divide 60 leaves a
    shorter last bucket; ``window()`` would not.
    """
    m = minute.cast("int")
    return two_digits(m - m % F.lit(width))


def compact(ts: Column, digits: int) -> Column:
    """The first ``digits`` of ``YYYYMMDDHHMMSS``.

    By way of the text form: ``date_format`` reads a zone-less timestamp in the
    session's zone, where the hour may not exist.
    """
    return F.substring(F.translate(ts.cast("string"), "-: ", ""), 1, digits)


def bucket_key(ts: Column, width: int) -> Column:
    """``YYYYMMDDHHMM`` of the bucket a timestamp falls into."""
    return F.concat(compact(ts, 10), floor_minute(F.minute(ts), width))


def split_key_parts(key: Column) -> dict[str, Column]:
    """Partition columns of a ``YYYYMMDDHHMM`` key."""
    return {
        "event_day": F.substring(key, 1, 8),
        "event_hour": F.substring(key, 9, 2),
        "event_minute": F.substring(key, 11, 2),
    }


def event_time(date: Column, time: Column, ingest: Column) -> Column:
    """Timestamp (no zone) of ``MM-DD`` and ``HH:MM:SS``.

    The line carries no year: take the latest one that puts the event no more
    than a day after ``ingest``.  NULL if there is no such moment.
    """
    limit = ingest.cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    stamp = F.concat(date, F.lit(" "), time)

    def number(text: Column, position: int) -> Column:
        return F.substring(text, position, 2).try_cast("int")

    def in_year(year: Column) -> Column:
        return F.try_make_timestamp_ntz(
            year, number(date, 1), number(date, 4), number(time, 1), number(time, 4), number(time, 7)
        )

    # as text, stamps of one year compare like the moments themselves
    year = F.year(limit) - F.when(stamp > F.substring(limit.cast("string"), 6, 14), 1).otherwise(0)
    # 29 February may exist in the year before only
    return F.when(stamp.rlike(_STAMP), F.coalesce(in_year(year), in_year(year - 1)))


def epoch_seconds(ts: Column, zone: str = "UTC") -> Column:
    """Seconds since 1970 of a zone-less timestamp read in ``zone``."""
    ts = ts.cast("timestamp_ntz")
    if zone != "UTC":
        ts = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def key_minutes(key: Column) -> Column:
    """Minutes of a bucket key ``YYYYMMDDHHMM`` since 1970, in its own zone."""
    day = F.unix_date(F.to_date(F.substring(key, 1, 8), "yyyyMMdd")).cast("bigint")
    return day * 1440 + F.substring(key, 9, 2).cast("bigint") * 60 + F.substring(key, 11, 2).cast("bigint")
