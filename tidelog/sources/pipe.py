"""Message pipes: a sharded, positioned stream of log lines.

A pipe is a topic, a pipelet one of its partitions, a message id the offset
within it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.shared import lookup_join

# fixed values: named start points
FROM_FIRST, FROM_CURRENT = -1, -2

# fixed values: fields of a message and whether they are required
ENVELOPE = T.StructType(
    [
        T.StructField("err_no", T.IntegerType(), False),
        T.StructField("err_msg", T.StringType()),
        T.StructField("queue_name", T.StringType()),
        T.StructField("pipe_name", T.StringType()),
        T.StructField("pipelet_id", T.IntegerType()),
        T.StructField("pipelet_msg_id", T.LongType()),
        T.StructField("seq_id", T.IntegerType()),
        T.StructField("msg_body", T.BinaryType()),
        T.StructField("srvtime", T.LongType()),
        T.StructField("timeout", T.IntegerType()),
        T.StructField("msg_flag", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Pipe:
    """Where messages come from: ``kafka``, or a file format and its path.

    ``columns`` maps pipelet, msg_id and body to expressions over the source.
    """

    format: str
    path: str | None = None
    schema: T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)
    columns: dict[str, str] = field(default_factory=dict)
    keep: tuple[str, ...] = ()


KAFKA_COLUMNS = {
    "pipelet": "partition",
    "msg_id": "offset",
    "body": "cast(value as string)",
    "ingest_ts": "timestamp",
}


def scan_pipe(spark: SparkSession, pipe: Pipe, streaming: bool = False) -> DataFrame:
    """Messages as ``pipelet, msg_id, body``, plus the kept columns."""
    reader = (spark.readStream if streaming else spark.read).format(pipe.format).options(**pipe.options)
    if pipe.schema is not None:
        reader = reader.schema(pipe.schema)
    raw = reader.load(pipe.path) if pipe.path else reader.load()
    columns = pipe.columns or (KAFKA_COLUMNS if pipe.format == "kafka" else {})
    return raw.select(*(F.expr(e).alias(n) for n, e in columns.items()), *pipe.keep)


def start_point(saved: Column, quirks: bool = False) -> Column:
    """Where to go on after a saved position (text or number).

    Nothing saved: the first message.  ``-2`` is handed on.  Else the next id;
    ``quirks`` takes a saved ``0`` for nothing saved.
    """
    text = F.trim(saved.cast("string"))
    position = text.try_cast("bigint")
    none = saved.isNull() | (F.length(text) == 0)
    if quirks:
        none = none | (text == "0")
    return (
        F.when(none, F.lit(FROM_FIRST))
        .when(position == FROM_CURRENT, F.lit(FROM_CURRENT))
        .otherwise(F.coalesce(position, F.lit(0)) + 1)
        .cast("bigint")
    )


def is_valid_start(c: Column) -> Column:
    """A named start point or a position."""
    return c.isin(FROM_FIRST, FROM_CURRENT) | (c >= 0)


def new_only(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages at or after their pipelet's ``start``; all, where none is known.

    Every pipelet keeps its position, however many there are; positions are a row
    per pipelet, which adaptive execution sends to the messages if it is small.
    """
    joined = lookup_join(messages, starts.select("pipelet", "start"), ["pipelet"])
    start = F.coalesce(F.col("start"), F.lit(FROM_FIRST))
    wanted = (start != FROM_CURRENT) & (F.col("msg_id") >= start)
    return joined.filter(wanted).drop("start")


def offset_checkpoint(messages: DataFrame) -> DataFrame:
    """(pipelet, msg_id): the last id of every pipelet."""
    return messages.groupBy("pipelet").agg(F.max("msg_id").alias("msg_id"))


def kafka_starting_offsets(topic: str, starts: DataFrame) -> str:
    """``startingOffsets`` text for a topic: one number for each of its pipelets.

    The reader takes this as one option, so it is as long as the topic has partitions.
    """
    # the source's own names for the two ends of a partition
    named = {FROM_FIRST: -2, FROM_CURRENT: -1}
    rows = starts.select("pipelet", "start").toLocalIterator()
    offsets = {str(r["pipelet"]): named.get(r["start"], r["start"]) for r in rows}
    return json.dumps({topic: offsets}, sort_keys=True)


def envelope_check(messages: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Add ``missing``, the required fields a message lacks (empty: valid).

    Without ``required`` the fields that the envelope does not allow to be NULL.
    """
    names = [f.name for f in ENVELOPE if not f.nullable] if required is None else required
    lacks = F.array(*(F.when(F.col(n).isNull(), F.lit(n)) for n in names))
    return messages.withColumn("missing", F.array_compact(lacks))


def decode_body(messages: DataFrame) -> DataFrame:
    """Envelopes as ``pipelet, msg_id, body, reason``: a row for every one.

    ``reason`` is NULL for a good envelope; ``no_err_no``, ``error`` or ``no_body``
    send it to quarantine (``decoded``, ``undecoded``).
    """
    reason = (
        F.when(F.col("err_no").isNull(), "no_err_no").when(F.col("err_no") != 0, "error").when(F.col("msg_body").isNull(), "no_body")
    )
    return messages.select(
        F.col("pipelet_id").alias("pipelet"),
        F.col("pipelet_msg_id").alias("msg_id"),
        F.col("msg_body").cast("string").alias("body"),
        reason.alias("reason"),
    )


def decoded(bodies: DataFrame) -> DataFrame:
    """The good envelopes, as messages."""
    return bodies.filter("reason is null").drop("reason")


def undecoded(bodies: DataFrame) -> DataFrame:
    """The envelopes that hold no message, with the reason."""
    return bodies.filter("reason is not null")
