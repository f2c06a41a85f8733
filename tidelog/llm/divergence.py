"""How far the sources of a language differ in their use of words.

Words are counted as a count vectoriser does it: every document is a sparse vector of
term counts, and a language keeps the terms that enough of its documents have, however
many these are.  Vectors are added up per (language, source), and two groups are
compared on their sparse sums.

A document's vector is added to its group's while it is at hand, in the task that reads
it; what leaves the task is one row per group and term.  The vocabulary stays a table:
nothing that grows with the corpus goes through the driver.

Every kept term gets a group's share ``p = 1 + floor(10**9 * (count + 5) / (N + 5 * V))``,
in whole numbers.  A term that a group does not have has the same ``p`` for all such
terms, so a pair's distance needs only the terms that either has, and their number.

Null text, language and source are empty ones; a text without words belongs to its group
all the same.  Repeated rows count as often as they are there.  Tables without rows give
none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import PART_BYTES, rows_of, saved, text_bytes

# rows that a task gathers before it sends them on
HELD = 300_000
# terms and sources that are compared in one piece
TILE_TERMS, TILE_SOURCES = 2048, 256

_KEPT = np.arange(256, dtype=np.uint8)
_KEPT[65:91] += 32
_KEPT[[*range(65), *range(91, 97), *range(123, 128)]] = 32
# letters in lower case, all other ASCII a space
_LETTERS = _KEPT.tobytes()


@dataclass(frozen=True)
class Audit:
    """``min_docs``: documents of a language that a kept term is in; ``top``: terms reported per group."""

    min_docs: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top: int = 50


def _parts(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, from a bounded part of it at a time."""
    start = 0
    while start < len(text):
        parts = [text[start : start + PART_BYTES].translate(_LETTERS)]
        start += len(parts[0])
        # on to the end of the term that the part cuts
        while start < len(text) and not parts[-1].endswith(b" "):
            more = text[start : start + PART_BYTES].translate(_LETTERS)
            parts.append(more[: more.find(b" ") + 1 or len(more)])
            start += len(parts[-1])
        yield b"".join(parts).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group sums of document vectors: occurrences of a term, and documents that have it."""
    sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def sent():
        for (lang, source), (n, docs) in sums.items():
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]).take(pa.array(np.zeros(size, np.int32))),
                    pa.array([source]).take(pa.array(np.zeros(size, np.int32))),
                    pa.array(list(n), pa.binary()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[t] for t in n], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    held = 0
    for langs, sources, texts in rows_of(batches, "lang", "source", "text"):
        for lang, source, text in zip(langs, sources, texts):
            n, docs = sums.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            own: set[bytes] = set()
            for terms in _parts(text):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            held += len(n) - before
            if held > HELD:
                yield from sent()
                sums.clear()
                held = 0
    yield from sent()


def _grouped(docs: DataFrame) -> tuple[Column, Column]:
    return tuple(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))


def group_vectors(docs: DataFrame, audit: Audit) -> DataFrame:
    """The sparse sums: lang, term, source, ``n`` occurrences, and ``lang_n``, those in the whole language.

    Only terms that ``min_docs`` documents of the language have.
    """
    read = docs.select(*_grouped(docs), text_bytes())
    partial = read.mapInArrow(_counted, "lang string, source string, term binary, n bigint, docs bigint")
    # one shuffle serves the sums and the window
    sums = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    return (
        sums.withColumns({"lang_docs": F.sum("docs").over(whole), "lang_n": F.sum("n").over(whole)})
        .filter(F.col("lang_docs") >= audit.min_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "source", "n", "lang_n")
    )


def _share(n: Column, total: Column, kept: Column, audit: Audit) -> Column:
    """``p``, exact: the product may exceed 64 bits."""
    above = (n.cast("decimal(20,0)") + audit.smoothing) * F.lit(audit.scale).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + kept.cast("decimal(18,0)") * audit.smoothing
    return F.call_function("div", above, below) + 1


def _distances(group: pa.Table) -> pa.Table:
    """Summed differences of every two sources of a tile, over the terms that occur in it."""
    names = group.column("source").combine_chunks().dictionary_encode()
    sources, own = names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    zero, tile = np.zeros((2, len(sources)), np.int64)
    zero[own] = group.column("zero").to_numpy()
    tile[own] = group.column("tile").to_numpy()
    there = group.column("term").is_valid().to_numpy()
    codes = group.column("term").combine_chunks().dictionary_encode()
    n_terms = len(codes.dictionary)
    shares = np.repeat(zero[:, None], n_terms, 1)
    at = codes.indices.fill_null(0).to_numpy(zero_copy_only=False)[there]
    shares[own[there], at] = group.column("p").fill_null(0).to_numpy()[there]
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    a, b, value = [], [], [np.empty(0, np.int64)]
    for k, source in enumerate(sources):
        # within one tile all pairs, between two only those across
        others = [m for m in range(len(sources)) if (m > k if i == j else (tile[k], tile[m]) == (i, j))]
        if others:
            # one order in all blocks
            a += [min(source, sources[m]) for m in others]
            b += [max(source, sources[m]) for m in others]
            # less what a term would add if neither had it, which is added for all terms later
            value.append(np.abs(shares[others] - shares[k]).sum(1) - n_terms * np.abs(zero[others] - zero[k]))
    lang = [group.column("lang")[0].as_py()] * len(a)
    return pa.table({"lang": pa.array(lang, pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "extra": np.concatenate(value)})


def _pairs(vectors: DataFrame, groups: DataFrame, tiles: int) -> DataFrame:
    """lang, source, item, value of all ordered pairs of a language's sources.

    The terms of a language are dealt out in blocks, its sources in tiles; two tiles and
    a block meet in one task.
    """
    blocks = F.ceil(F.col("kept") / TILE_TERMS).cast("int")
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    block = F.pmod(F.xxhash64("term", F.lit(1)), blocks).cast("int")
    rows = vectors.select("lang", "source", "term", "p", "zero", tile.alias("tile"), block.alias("block"))
    # every group is in every block, with or without a term in it
    every = groups.filter("kept > 0").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("p"), "zero", tile.alias("tile"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
    )
    both = rows.unionByName(every).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    both = both.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).drop("other")
    partial = both.groupBy("lang", "block", "i", "j").applyInArrow(_distances, "lang string, a string, b string, extra bigint")
    sums = partial.groupBy("lang", "a", "b").agg(F.sum("extra").alias("extra"))
    sums = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "extra"))
    sums = sums.select(*(F.col(c).alias(f"s_{c}") for c in sums.columns))
    one = groups.select("lang", "source", "kept", "zero")
    two = groups.select(F.col("lang").alias("o_lang"), F.col("source").alias("item"), F.col("zero").alias("o_zero"))
    ends = one.join(two, (F.col("lang") == F.col("o_lang")) & (F.col("source") != F.col("item")))
    met = ends.join(sums, (F.col("lang") == F.col("s_lang")) & (F.col("source") == F.col("s_a")) & (F.col("item") == F.col("s_b")), "left")
    value = F.when(F.col("kept") > 0, F.coalesce("s_extra", F.lit(0)) + F.col("kept") * F.abs(F.col("zero") - F.col("o_zero"))).otherwise(0)
    return met.select("lang", "source", "item", value.cast("bigint").alias("value"))


def divergence(docs: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """lang, source, part, item, value, rank: every other source by its distance, and the terms a group favours.

    Ranks count from 1 for every group and part, by falling value, then by item.  Part
    ``term`` has the terms that the group has, and has more of than its language, up to
    ``audit.top``.
    """
    vectors = saved(group_vectors(docs, audit), "vectors")
    sizes = vectors.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    terms = vectors.groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    groups = docs.select(*_grouped(docs)).distinct().join(sizes, ["lang", "source"], "left").join(langs, ["lang"], "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")))
    zero = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"), audit))
    groups = saved(groups.withColumn("zero", zero), "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    shares = vectors.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("total"), F.col("kept"), audit),
            "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), audit),
        }
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    favoured = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    favoured = favoured.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= audit.top)
    pairs = _pairs(shares, groups, max(1, -(-most // TILE_SOURCES))).withColumn("rank", F.row_number().over(ranked))
    columns = ("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    return pairs.select(*columns).unionByName(favoured.withColumn("part", F.lit("term")))
