"""An application: how the lines of one log become rows of one event table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import clock
from tidelog.functions.hooks import Hook, date_time
from tidelog.functions.text import Sql
from tidelog.operators.mapping import Cut, MapRule, apply_rules, conform
from tidelog.operators.parse import cut_raw, decoded, with_event_time


@dataclass(frozen=True)
class Application:
    """What a user declares.

    ``cut`` adds ``matched`` and ``fields`` to messages, with raw values if there
    is a ``decode``; ``rules`` map fields to the columns of ``schema``; ``lookup``
    is a join on the parsed rows whose columns hooks may use.
    """

    name: str
    schema: T.StructType
    rules: tuple[MapRule, ...]
    hooks: Mapping[str, Hook] = field(default_factory=dict)
    cut: Cut = cut_raw
    decode: Sql | None = decoded
    lookup: Cut | None = None
    width: int = 10
    n_pipelets: int = 16
    zone: str = "UTC"
    ingest: str = "ingest_ts"
    leftovers: str = "event_loginfo"

    def parsed(self, messages: DataFrame) -> DataFrame:
        """Messages with ``fields``, ``event_ts`` and ``reason``."""
        decode = self.decode or (lambda x: x)
        return messages.transform(self.cut).transform(with_event_time, F.col(self.ingest), decode=decode)

    def bucket(self) -> dict[str, Column]:
        """``bucket`` and the partition columns of a parsed row."""
        key = clock.bucket_key(F.col("event_ts"), self.width)
        return {"bucket": key, **clock.split_key_parts(key)}

    def events(self, parsed: DataFrame, keep: tuple[str, ...] = (), typed: bool = True) -> DataFrame:
        """Parsed rows as events: ``keep``, declared columns, then undeclared ones."""
        if self.lookup is not None:
            parsed = parsed.transform(self.lookup)
        hooks = {"date_time": date_time(F.col("event_ts"), self.zone), **self.hooks}
        mapped = apply_rules(parsed, self.rules, hooks, keep, self.leftovers, decode=self.decode)
        schema = self.schema
        if not typed:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in schema.fieldNames()])
        return conform(mapped, schema, keep)

    def run(self, messages: DataFrame, keep: tuple[str, ...] = ("pipelet", "msg_id")) -> DataFrame:
        """Messages to partitioned events in one narrow stage, bad lines included.

        A bad line has a ``reason`` and no partition.
        """
        placed = self.parsed(messages).select("*", *(c.alias(n) for n, c in self.bucket().items()))
        return self.events(placed, (*keep, "reason", *self.bucket()))
