"""Cluster-shared scratch space and lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Without one, a local session gets a temporary folder; on a cluster that would be
    another folder on every machine, so it is an error there.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if current is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tidelog-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def computed_once(df: DataFrame, *names: str) -> DataFrame:
    """Move the named columns last, out of reach of filters on them.

    A filter is pushed below a projection by repeating the projection's
    expressions in it, step by step; with costly expressions that would evaluate
    them many times over.  It is not pushed below a generator.
    """
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names))))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    where: Column | None = None,
    salts: int = 1,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join a large side with an aggregated or reference side of unknown size.

    No job runs and no size is assumed here: adaptive execution broadcasts the
    lookup if its measured bytes are few, and splits hot keys of a shuffled join.
    With ``salts`` the shuffle itself spreads a key over as many tasks: the left side
    takes its salt from a hash of ``spread`` (columns that vary within a key), the
    lookup is repeated for every salt.

    ``where`` is a further condition on the joined row, in which the lookup's
    columns have the prefix ``r_``.
    """
    on = list(keys)
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
        lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on.append("_salt")
    # new names, so that a lookup derived from the left side is not taken for it
    right = lookup.select(*(F.col(c).alias(f"r_{c}") for c in lookup.columns))
    condition = where if where is not None else F.lit(True)
    for k in on:
        condition = condition & (F.col(k) == F.col(f"r_{k}"))
    joined = left.join(right, condition, how)
    kept = [c for c in left.columns if c != "_salt"]
    if how in ("left_semi", "left_anti"):
        return joined.select(*kept)
    return joined.select(*kept, *(F.col(f"r_{c}").alias(c) for c in lookup.columns if c not in on))
