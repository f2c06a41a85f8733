"""Token counts: an exact histogram of encoded lengths, and what it answers.

A group's documents are counted by length in tokens.  Sums over the longer and over
the shorter lengths then tell, for every context limit, how many documents fit, how
many tokens there are in all, and how many remain if longer documents are cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import running_total, saved, unused

# lengths whose sums are taken in one task
BLOCK = 4096


def default_vocabulary() -> tuple[str, str]:
    """Path and splitting pattern of the vocabulary that is installed with Python."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def token_lengths(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, name: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text; null texts have none.

    ``vocabulary`` is a file of ranked byte pairs (base 64, space, rank).  The driver
    reads it and sends it to the tasks: a vocabulary does not grow with the corpus.
    Strings of special tokens in a text are ordinary text.
    """
    if vocabulary is None:
        vocabulary, pattern = default_vocabulary()
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    columns = [f for f in docs.schema if f.name != name]
    encoders: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        if not encoders:
            pairs = (line.split() for line in ranks.value.splitlines() if line)
            table = {base64.b64decode(token): int(rank) for token, rank in pairs}
            encoders.append(tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=table, special_tokens={}))
        encode = encoders[0].encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], name])

    kept = [F.col(f"`{f.name}`") for f in columns]
    schema = docs.select(*kept).schema.add(name, "long")
    return docs.select(*kept, F.coalesce("text", F.lit("")).alias(unused("words", docs.columns))).mapInArrow(run, schema)


def length_histogram(docs: DataFrame, by: str = "source", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per group and length that occurs: counts, and sums over shorter and longer ones.

    ``<by>, n_tokens, n_docs``, then ``docs_up_to, tokens_up_to`` of documents no
    longer, ``docs_over, tokens_over`` of longer ones, ``quantile`` (share of documents
    no longer), and ``truncated_total``, the tokens left with ``n_tokens`` as context
    limit.  A null group is a group; an empty text has length 0.
    """
    measured = token_lengths(docs.select(F.col(by).alias(by), "text"), vocabulary, pattern)
    counts = measured.groupBy(by, "n_tokens").agg(F.count("*").alias("n_docs"))
    counts = counts.withColumn("_group", F.coalesce(F.col(by).cast("string"), F.lit(""))).withColumn("_none", F.col(by).isNull())
    # blocks count down, so that what came before is what is longer
    counts = saved(counts.withColumn("_block", -F.floor(F.col("n_tokens") / BLOCK)), "lengths")
    longest_first = [F.col("n_tokens").desc()]
    keys = ["_group", "_none"]
    sums = running_total(counts, keys, "_block", longest_first, F.col("n_docs"), "docs_over")
    sums = running_total(sums, keys, "_block", longest_first, F.col("n_docs") * F.col("n_tokens"), "tokens_over")
    totals = counts.groupBy(*keys).agg(F.sum("n_docs").alias("_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_tokens"))
    sums = sums.join(totals, keys)
    return sums.select(
        by,
        "n_tokens",
        "n_docs",
        (F.col("_docs") - F.col("docs_over")).alias("docs_up_to"),
        (F.col("_tokens") - F.col("tokens_over")).alias("tokens_up_to"),
        "docs_over",
        "tokens_over",
        ((F.col("_docs") - F.col("docs_over")) / F.col("_docs")).alias("quantile"),
        (F.col("_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_total"),
    )


def at_limits(histogram: DataFrame, limits: Sequence[int], by: str = "source") -> DataFrame:
    """Per group and context limit: ``docs_fit, tokens_fit, truncated_total``, for any limits of 0 or more.

    The entry of the longest length within the limit has all that is needed; if there
    is none, every document is longer.
    """
    out = None
    for limit in sorted(set(limits)):
        within = F.when(F.col("n_tokens") <= limit, F.struct("n_tokens", "docs_up_to", "tokens_up_to"))
        best = histogram.groupBy(by).agg(F.max(within).alias("_best"), F.max("docs_up_to").alias("_docs"))
        fit = F.coalesce("_best.docs_up_to", F.lit(0))
        tokens = F.coalesce("_best.tokens_up_to", F.lit(0))
        part = best.select(
            by,
            F.lit(limit).cast("bigint").alias("context_limit"),
            fit.cast("bigint").alias("docs_fit"),
            tokens.cast("bigint").alias("tokens_fit"),
            (tokens + (F.col("_docs") - fit) * limit).cast("bigint").alias("truncated_total"),
        )
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no limits are given")
    return out


def quantiles(histogram: DataFrame, shares: Sequence[float], by: str = "source") -> DataFrame:
    """Per group and share: the smallest length that at least so many documents keep within."""
    first = [F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)]
    pairs = F.array(*(F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, q in enumerate(shares)))
    return histogram.groupBy(by).agg(*first).select(by, F.inline(pairs))
