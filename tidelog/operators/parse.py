"""Log line to field bag.

A line is ``NOTICE: MM-DD HH:MM:SS ... [k=v k=v ...]`` with percent-encoded
values.  A bag is a ``map<string,string>`` in token order: names are
case-sensitive and vary from line to line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import clock, text
from tidelog.shared import computed_once

# fixed values: the line header, and the field list between its brackets.  The
# list starts at the last "[" that a "]" follows on the first physical line, so
# it holds no "[" itself; said that way, the search is linear.
START = "NOTICE: "
LINE = r"(?d)^NOTICE: (\d+-\d+) (\d\d:\d\d:\d\d).*\[([^\[\n]*)\](?s:.*)$"


def parse_header(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``matched``, ``date``, ``time`` and ``payload``."""
    with_line = df.withColumn("_line", text.escape_invalid(body))
    group = {n: F.regexp_extract("_line", LINE, i) for i, n in enumerate(("date", "time", "payload"), 1)}
    parsed = with_line.select(*df.columns, *(c.alias(n) for n, c in group.items()))
    marked = parsed.withColumn("matched", F.coalesce(F.length("date") > 0, F.lit(False)))
    return computed_once(marked, "matched", "date", "time", "payload")


def parse_fields(df: DataFrame) -> DataFrame:
    """Replace the header columns by ``fields``; body tokens override the header's.

    A line without a header has an empty date and time, and nothing else.
    """
    pairs = F.concat_ws("", F.lit("date="), "date", F.lit(" time="), "time", F.lit(" "), "payload")
    pairs = F.when(F.col("matched"), pairs).otherwise("date= time=")
    keep = [c for c in df.columns if c not in ("date", "time", "payload")]
    with_pairs = df.select(*keep, pairs.alias("_pairs"))
    return with_pairs.select(*keep, text.pairs_to_map("_pairs", " ", [text.percent_decode_sql]).alias("fields"))


def cut_raw(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``matched`` and ``fields`` with values as they stand in the line.

    One regular expression per line; values are decoded where they are used.
    """
    line = df.withColumn("_line", text.escape_invalid(body))
    pairs = F.regexp_replace("_line", LINE, "date=$1 time=$2 $3")
    changed = line.withColumn("_pairs", F.when(F.startswith("_line", F.lit(START)), pairs))
    matched = F.coalesce(~F.startswith("_pairs", F.lit(START)), F.lit(False))
    named = changed.select(
        *df.columns,
        matched.alias("matched"),
        F.when(matched, F.col("_pairs")).otherwise("date= time=").alias("_pairs"),
    )
    bag = named.select(*df.columns, "matched", F.expr(text.raw_pairs_sql("_pairs", " ")).alias("fields"))
    return computed_once(bag, "matched", "fields")


# how to read a value of a ``cut_raw`` bag, as SQL text
decoded = text.percent_decode_sql


def cut_notice(df: DataFrame, body: str = "body") -> DataFrame:
    """The same with decoded values: header, fields and decoding in one."""
    raw = cut_raw(df, body)
    return raw.withColumn("fields", F.expr(text.map_values_sql("fields", [decoded])))


def with_event_time(
    df: DataFrame, ingest: Column, fields: str = "fields", decode: text.Sql = decoded
) -> DataFrame:
    """Add ``event_ts`` (NULL if there is no such moment) and ``reason``.

    ``reason`` is NULL for a good line, else why it has no place in the table:
    ``no_header``, ``no_ingest_time``, or ``bad_time``.
    """
    at = df.select(
        "*",
        F.expr(decode(f"{fields}['date']")).alias("_date"),
        F.expr(decode(f"{fields}['time']")).alias("_time"),
    )
    ts = clock.event_time(F.col("_date"), F.col("_time"), ingest)
    reason = (
        F.when(~F.col("matched"), "no_header")
        .when(ingest.isNull(), "no_ingest_time")
        .when(F.col("event_ts").isNull(), "bad_time")
    )
    placed = at.withColumn("event_ts", ts).withColumn("reason", reason).drop("_date", "_time")
    return computed_once(placed, "event_ts", "reason")


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull())


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())
