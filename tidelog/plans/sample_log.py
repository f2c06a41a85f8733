"""Log lines derived from the ``events`` table, for queries, tests and the benchmark.

Every part of a line is a function of an event's columns, so what a pipeline
makes of it can be computed from those columns directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_PIPELETS = 16
GBK_NAMES = ("%B1%B1%BE%A9", "%C9%CF%BA%A3", "%B9%E3%D6%DD")  # 北京, 上海, 广州


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def client_ip() -> Column:
    return _text("10.", F.col("user_id") % 25, ".", F.col("event_id") % 256, ".", F.col("user_id") % 250)


def line() -> Column:
    """The log line of an event."""
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    level = F.when(e % 97 == 0, "WARNING: ").otherwise("NOTICE: ")
    day = F.when(e % 101 == 0, "02-30").otherwise(F.substring(F.col("ts").cast("string"), 6, 5))
    context = F.when(e % 13 == 0, " [ctx] [").otherwise(" [")
    name = F.get(F.array(*(F.lit(n) for n in GBK_NAMES)), (e % 3).cast("int"))
    page = F.when(e % 3 == 0, _text("%2F", kind)).otherwise(
        _text("%2F", kind, "%3Fword%3Dterm+", u, "%26pn%3D", e % 10)
    )
    via = F.when(e % 4 == 0, "").otherwise(_text("http%3A%2F%2Fexample.com%2Fq%2F", e, ".html%3Fa%3D", u))
    fields = [
        ("sale", F.lpad(e.cast("string"), 10, "0")),
        ("kiosk", F.lit("7")),
        ("dup", F.when(e % 11 == 0, "first").otherwise("once")),
        ("buyer", u.cast("string")),
        ("guest", name),
        ("mail", _text("u", u, "%40example.com")),
        ("pass", _text("%22", F.md5(e.cast("string")), "%3Av2%22")),
        ("addr", client_ip()),
        ("device", _text("Agent%252F1.0%20%28", kind, "%29")),
        ("site", F.lit("example.com")),
        ("page", page),
        ("via", via),
        ("gate", F.when(e % 2 == 0, kind).otherwise("")),
        ("block", _text("left%3D%27", e % 100, "%27%20right%3D%27", u, "%27")),
        ("Price", _text("cents%3D", e % 50, "%20fee%3D2")),
        ("price", F.lit("40")),
        ("memo", _text("act%3D%27", kind, "%27%20part%3D%273%27")),
        ("code", (e % 5).cast("string")),
        ("took", _text(e + 1000000000, ".895")),
        ("desk", F.lit("10.9.9.9")),
        ("value", F.col("value").cast("string")),
        ("props", F.url_encode("props")),
        ("eq", F.lit("1=2")),
        ("pct", F.lit("%zz%4")),
    ]
    body = [_text(n, "=", c) for n, c in fields]
    again = F.when(e % 11 == 0, " dup=last flag note=").otherwise(" flag note=")
    return F.concat(
        level,
        day,
        F.substring(F.col("ts").cast("string"), 11, 9),
        _text(" sale * ", e),
        context,
        F.concat_ws(" ", *body),
        again,
        F.lit("]"),
    )


def dealt(events: DataFrame) -> DataFrame:
    """The rows in tasks of equal size, two a core at least.

    An event takes a few bytes of its file and many times the work of reading it: a file
    of few row groups would be the work of few tasks, whatever cores there are.
    """
    n = 2 * events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(n if events.isStreaming else max(n, events.rdd.getNumPartitions()))


def messages_from_events(events: DataFrame) -> DataFrame:
    """``pipelet, msg_id, body, ingest_ts, arrival``; one message in seven arrives late."""
    e = F.col("event_id")
    return dealt(events).select(
        (e % N_PIPELETS).alias("pipelet"),
        e.alias("msg_id"),
        line().alias("body"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ingest_ts"),
        (e + F.when(e % 7 == 0, 50).otherwise(0)).alias("arrival"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(load(spark, sf_dir, "events"))
