"""Sharding by jump consistent hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import hash_block, running_total

# fixed values: the generator of the published algorithm, and its word size
MULTIPLIER, WORD = 2862933555777941757, 1 << 64


def jumps(key: str, n_shards: int) -> Column:
    """Where a key's jumps end with ``n_shards`` shards: struct ``b, j``.

    ``b`` is the last stop below ``n_shards``, which is the key's shard; ``j`` is
    the next stop.  A key moves to an added shard only if ``j`` is its number.
    ``key`` is SQL for a whole number; numbers equal modulo 2**64 are one key.
    """
    word = f"cast({WORD} as decimal(38,0))"
    step = "cast(pmod(cast({} * cast(%d as decimal(19,0)) as decimal(38,0)) + 1, %s) as decimal(20,0))" % (MULTIPLIER, word)
    first = step.format(f"cast(pmod(cast({key} as decimal(38,0)), {word}) as decimal(20,0))")
    following = "cast(floor((s.j + 1) * (2147483648D / ((s.k div 8589934592BD) + 1))) as bigint)"
    return F.expr(
        f"aggregate(sequence(1, {n_shards}), named_struct('b', -1L, 'j', 0L, 'k', {first}), "
        f"(s, i) -> if(s.j >= {n_shards}, s, named_struct('b', s.j, 'j', {following}, 'k', {step.format('s.k')})), "
        "s -> named_struct('b', s.b, 'j', s.j))"
    )


def assign_shards(docs: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """Add ``shard`` and ``grown_shard``, the shard once there is one more.

    The key and the number of shards alone decide.  A null key counts as -1.
    """
    return (
        docs.withColumn("_jump", jumps(f"coalesce({key}, -1)", n_shards))
        .withColumn("shard", F.col("_jump.b").cast("int"))
        .withColumn("grown_shard", F.when(F.col("_jump.j") == n_shards, F.lit(n_shards)).otherwise(F.col("shard")))
        .drop("_jump")
    )


def shard_slots(docs: DataFrame, n_shards: int = 40, blocks: int = 512) -> DataFrame:
    """Per document: its size, text checksum, shard, and place within the shard.

    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.  Slots of a shard
    run from 0 without gaps, by a digest of the id, then the id; rows that repeat an
    id have slots of their own.  Texts are not shuffled, and a shard is counted
    through in ``blocks`` parts.  A null text has no bytes, a null id is key -1;
    further columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        hash_block(F.col("doc_id"), blocks),
    )
    rows = assign_shards(rows, n_shards)
    rows = running_total(rows, ["shard"], "block", ["doc_id", "size", "text_crc32"], F.lit(1).cast("bigint"), "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.col("grown_shard").cast("int"))
