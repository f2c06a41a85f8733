"""Sources and the whole flow, as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.operators import merge
from tidelog.plans.example import example_application
from tidelog.plans.sample_log import N_PIPELETS, load, messages, messages_from_events
from tidelog.shared import scratch_path
from tidelog.sources import pipe
from tidelog.streaming.etl import StreamEtl
from workload import query
from workload.inputs import SRC
from workload.mapping import row_text, row_text_sql


def _events_stream(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    # the table may be a file or a folder
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


@query("scan_pipe", SRC + "select pipelet, msg_id, props as body from src")
def scan_pipe(spark, sf_dir):
    """A pipe read to its present end, with its position kept in a checkpoint."""
    source = pipe.Pipe(
        "parquet",
        f"{sf_dir}/events.parquet*",
        load(spark, sf_dir, "events").schema,
        columns={"pipelet": f"event_id % {N_PIPELETS}", "msg_id": "event_id", "body": "props"},
    )
    out = scratch_path(spark, "pipe")
    stream = pipe.scan_pipe(spark, source, streaming=True)
    sink = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-position")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@query(
    "envelope_check",
    SRC
    + """select msg_id, concat_ws(',', case when msg_id % 17 = 0 then 'err_no' end,
      case when msg_id % 19 = 0 then 'msg_body' end) as missing from src""",
)
def envelope_check(spark, sf_dir):
    """Messages with required fields left out here and there."""
    e = F.col("msg_id")
    envelopes = messages(spark, sf_dir).select(
        e,
        F.when(e % 17 != 0, 0).alias("err_no"),
        F.when(e % 19 != 0, F.col("body").cast("binary")).alias("msg_body"),
        F.col("pipelet").cast("int").alias("pipelet_id"),
    )
    checked = pipe.envelope_check(envelopes, ("err_no", "msg_body"))
    return checked.select("msg_id", F.array_join("missing", ",").alias("missing"))


@query(
    "stream_etl",
    SRC
    + f""", listed as (select distinct pipelet, bucket from src where good),
      frontier as (select min(newest) as f from (select max(bucket) as newest from listed group by pipelet)),
      public as (select bucket from listed where bucket < (select f from frontier) group by 1
        having bit_or(cast(1 as bigint) << pipelet) = 65535)
    select pipelet, msg_id, bucket, {row_text_sql(True)}
    from src where good and bucket in (select bucket from public)""",
)
def stream_etl(spark, sf_dir):
    """Lines to published hours: complete in all pipelets, and sealed by all."""
    app = example_application(width=60)
    etl = StreamEtl(spark, app, scratch_path(spark, "etl"))
    etl.start(messages_from_events(_events_stream(spark, sf_dir)), availableNow=True).awaitTermination()
    published = etl.published()
    return published.select("pipelet", "msg_id", "bucket", row_text(published))


@query("dedupe_stream", SRC + "select pipelet, msg_id, props as body from src")
def dedupe_stream(spark, sf_dir):
    """The stream twice over, once behind the other: each message stays once."""
    e = F.col("event_id")
    one = _events_stream(spark, sf_dir).select(
        (e % N_PIPELETS).alias("pipelet"), e.alias("msg_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("props").alias("body"),
    )
    twice = one.withColumn("ts", F.explode(F.array("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))))
    out = scratch_path(spark, "dedupe")
    sink = merge.dedupe_stream(twice, "ts", "40 days").writeStream.format("parquet")
    sink = sink.option("path", out).option("checkpointLocation", f"{out}-position")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("pipelet", "msg_id", "body")
