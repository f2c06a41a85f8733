"""Frames the queries start from, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.clock import bucket_key, compact, split_key_parts
from tidelog.plans.example import example_application
from tidelog.plans.sample_log import N_PIPELETS, client_ip, load, messages

# what the sample lines stand for, straight from the table
SRC = """
with src as (
  select event_id as msg_id, event_id % 16 as pipelet, ts, user_id, event_type, value, props,
    event_id + case when event_id % 7 = 0 then 50 else 0 end as arrival,
    event_id % 97 = 0 as no_header,
    event_id % 97 <> 0 and event_id % 101 = 0 as bad_time,
    event_id % 97 <> 0 and event_id % 101 <> 0 as good,
    strftime(ts, '%Y%m%d%H') || '00' as bucket,
    strftime(ts, '%Y%m%d') || '0000' as day_bucket,
    strftime(ts, '%Y%m%d%H') || lpad(cast(minute(ts) // 10 * 10 as varchar), 2, '0') as bucket10
  from events)
"""


# why a line has no place in the table; empty for a good one
REASON = "case when no_header then 'no_header' when bad_time then 'bad_time' else '' end as reason"


def unless_no_header(sql: str, otherwise: str = "''") -> str:
    """What a field gives, for all lines: a line without a header has no fields."""
    return f"case when no_header then {otherwise} else {sql} end"


def if_good(sql: str, otherwise: str = "''") -> str:
    """What an event's moment gives, for all lines."""
    return f"case when good then {sql} else {otherwise} end"


def reason() -> Column:
    return F.coalesce("reason", F.lit("")).alias("reason")


def parsed(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    """Every line, parsed."""
    return example_application(**settings).parsed(messages(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    """Typed events of every line, with position and reason."""
    app = example_application(**settings)
    return app.events(app.parsed(messages(spark, sf_dir)), ("pipelet", "msg_id", "reason"))


def rows(spark: SparkSession, sf_dir: str, width: int = 60) -> DataFrame:
    """``pipelet, msg_id, arrival, bucket``, without going through lines."""
    e = F.col("event_id")
    return load(spark, sf_dir, "events").select(
        (e % N_PIPELETS).alias("pipelet"),
        e.alias("msg_id"),
        (e + F.when(e % 7 == 0, 50).otherwise(0)).alias("arrival"),
        bucket_key(F.col("ts"), width).alias("bucket"),
    )


def day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one bucket a day, and its partition columns."""
    day = rows(spark, sf_dir).withColumn("bucket", F.concat(F.substring("bucket", 1, 8), F.lit("0000")))
    return day.select("*", *(c.alias(n) for n, c in split_key_parts(F.col("bucket")).items()))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days on which anything happened."""
    day = compact(F.col("ts"), 8).alias("event_day")
    return load(spark, sf_dir, "events").select(day).distinct()


def ip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(F.col("event_id").alias("msg_id"), client_ip().alias("client_ip"))


def place_text():
    """``<province><city>,<provider>`` of a nation; some have no province."""
    key, region = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    named = F.concat(F.lit("R"), region, F.lit("省N"), key, F.lit("市,ISP"), region)
    return F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("N"), key, F.lit(",ISP"), region)).otherwise(named)


PLACE_SQL = """
  case when n_nationkey % 5 = 0 then '' else 'R' || n_regionkey || '省' end as province,
  case when n_nationkey % 5 = 0 then '' else 'N' || n_nationkey || '市' end as city,
  'ISP' || n_regionkey as provider
"""


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range per nation, with a gap at its upper end."""
    lo = (F.lit(10 << 24) + F.col("n_nationkey") * (1 << 16)).cast("bigint")
    return load(spark, sf_dir, "nation").select(
        lo.alias("lo"), (lo + 200 * 256 - 1).alias("hi"), place_text().alias("ip_place")
    )
