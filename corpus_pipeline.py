"""A corpus pipeline of five stages: filter, dedup, decontaminate, mix, shard.

Each stage gets what the one before it kept and returns a frame that is written and
read again.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import decontaminate, minhash, mix, quality, shards
from tidelog.llm.common import saved, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

N_SHARDS = 40


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking, learnt from the labels of those here, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group alike in 80 % of five-word shingles."""
    return minhash.keep_one(docs, minhash.NearDuplicates(shingle=5, percent=80))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what they share with test items; none that is mostly such."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=10, max_coverage=0.5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard``, by their id; copies of one go to one shard."""
    return shards.assign_shards(docs, N_SHARDS).drop("grown_shard")


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
    ("assign_shards", assign_shards),
]

# a ranking and an entropy balance are fitted in steps, which SQL does not express
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
