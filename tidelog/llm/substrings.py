"""Substring dedup: exact repeats of many words, found by fixed-block anchors.

Each document, as a reference, is cut into non-overlapping blocks of ``block`` words,
which are indexed; as a probe, it looks up the blocks that begin at each of its
words.  Any window of ``window`` words holds at least ``m = (window - block + 1) //
block`` whole reference blocks, so a repeated window always hits.

That is m hits where one would do.  Both sides therefore use, of any m successive
blocks, only the one with the smallest hash: the reference along its blocks, the
probe along each of the ``block`` ways to cut it.  A repeated window holds the same
blocks on both sides, so they choose the same one, and nothing is missed.

Hits are extended: around each, windows are compared by 128-bit hashes, and those
that began in an earlier document cover the repeat, to its full length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, rolling, rows_of, saved, text_bytes, word_hashes


@dataclass(frozen=True)
class Repeats:
    """Windows of this many words, anchored by blocks of this many."""

    window: int = 50
    block: int = 5

    def __post_init__(self):
        if not 1 <= self.block or self.window < 2 * self.block - 1:
            raise ValueError("a window must hold a whole block wherever blocks begin")

    @property
    def run(self) -> int:
        """Blocks that any window holds whole."""
        return (self.window - self.block + 1) // self.block


def run_anchors(hashes: np.ndarray, how: Repeats) -> np.ndarray:
    """For each word that ``how.run`` successive blocks can begin at: where the chosen one begins.

    That is the one with the smallest hash, of equal ones the last.  The hash's last
    bits give way to the block's number, so that a minimum tells both.
    """
    if len(hashes) < how.window:
        return np.empty(0, np.int64)
    last = how.run - 1
    bits = np.uint64((1 << last.bit_length()) - 1)
    blocks = rolling(hashes, how.block) & ~bits
    n = len(blocks) - last * how.block
    least = blocks[:n] | np.uint64(last)
    for k in range(1, how.run):
        np.minimum(least, blocks[k * how.block : k * how.block + n] | np.uint64(last - k), out=least)
    return np.arange(n) + (last - (least & bits).astype(np.int64)) * how.block


def _places(anchors: np.ndarray, n: int) -> np.ndarray:
    """The places below n that are among the anchors, in order."""
    found = np.zeros(n, bool)
    found[anchors] = True
    return np.flatnonzero(found)


def _anchor_rows(docs: DataFrame, how: Repeats, reference: bool) -> DataFrame:
    """``hash, doc_id, at`` of the blocks that documents use as references, or as probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            columns: list[list] = [[np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]]
            for doc_id, hashes in zip(ids, word_hashes(texts), strict=True):
                at = _places(run_anchors(hashes, how)[:: how.block if reference else 1], len(hashes))
                for out, values in zip(columns, (rolling(hashes, how.block)[at], np.full(len(at), doc_id), at), strict=True):
                    out.append(values)
            hashes, owners, places = map(np.concatenate, columns)
            arrays = [pa.array(hashes.view(np.int64)), pa.array(owners), pa.array(places.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["hash", "doc_id", "at"])

    return docs.mapInArrow(run, "hash bigint, doc_id bigint, at int")


def _around(hashes: np.ndarray, at: list[int], how: Repeats) -> np.ndarray:
    """The windows that a document would have found by the anchors at these places."""
    n = len(hashes) - how.window + 1
    found = np.zeros(max(n, 0), bool)
    if n <= 0:
        return np.flatnonzero(found)
    chosen = np.zeros(len(hashes), bool)
    # places may be those of another text with the same id
    places = np.array(at, np.int64)
    chosen[places[places < len(hashes)]] = True
    begins = chosen[run_anchors(hashes, how)]
    # the run of a window's blocks begins at one of the window's first words
    for shift in range(how.block):
        found |= begins[shift : shift + n]
    return np.flatnonzero(found)


def _windows(texts: DataFrame, how: Repeats) -> DataFrame:
    """``h1, h2, doc_id, at`` of the windows around the anchors ``ats`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts_, ats in rows_of(batches, "doc_id", "text", "ats"):
            columns: list[list] = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]]
            for doc_id, hashes, other, at in zip(ids, word_hashes(texts_), word_hashes(texts_, 1), ats, strict=True):
                chosen = _around(hashes, at, how)
                pair = (rolling(x, how.window)[chosen] for x in (hashes, other))
                for out, values in zip(columns, (*pair, np.full(len(chosen), doc_id), chosen), strict=True):
                    out.append(values)
            h1, h2, owners, places = map(np.concatenate, columns)
            arrays = [pa.array(x) for x in (h1.view(np.int64), h2.view(np.int64), owners, places.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "doc_id", "at"])

    return texts.select("doc_id", "text", "ats").mapInArrow(run, "h1 bigint, h2 bigint, doc_id bigint, at int")


def copied_documents(docs: DataFrame, how: Repeats) -> DataFrame:
    """``doc_id`` of documents with all the words, a window or more, of one with a smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            words = word_hashes(texts)
            long = [i for i, w in enumerate(words) if len(w) >= how.window]
            arrays = [
                pa.array([ids[i] for i in long], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(words[i].tobytes()) for i in long], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest"])

    spark = docs.sparkSession
    digests = saved(docs.mapInArrow(run, "doc_id bigint, digest binary"), "digests")
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = saved(first.filter("first_id < last_id").drop("last_id"), "first")
    copies = saved(digests.join(first, "digest").filter("doc_id > first_id").select("doc_id").distinct(), "copies")
    discard(spark, digests, first)
    return copies


def repeated_windows(docs: DataFrame, copies: DataFrame, how: Repeats) -> DataFrame:
    """``doc_id, starts`` of the windows whose words also begin in a document with a smaller id.

    ``docs`` has ``doc_id`` (not null) and ``text`` as bytes.  ``copies`` are left
    out: what they repeat, and what repeats them, is in the documents they copy.
    """
    spark = docs.sparkSession
    index = saved(_anchor_rows(docs, how, True).groupBy("hash").agg(F.min("doc_id").alias("first_id")), "index")
    hits = _anchor_rows(docs, how, False).join(index, "hash").filter("doc_id > first_id").select("hash", "doc_id", "at")
    hits = saved(hits, "hits")
    discard(spark, index)
    own = saved(hits.join(copies, "doc_id", "left_anti"), "hits")
    discard(spark, hits)
    last = saved(own.groupBy("hash").agg(F.max("doc_id").alias("last_id")), "last")
    # a document is a reference for those after it
    references = _anchor_rows(docs, how, True).join(last, "hash").filter("doc_id < last_id").select("doc_id", "at")
    references = references.join(copies, "doc_id", "left_anti")
    ats = own.select("doc_id", "at").unionByName(references).groupBy("doc_id").agg(F.collect_set("at").alias("ats"))
    ats = saved(ats, "ats")
    discard(spark, own, last)
    around = saved(_windows(docs.join(ats, "doc_id"), how), "windows")
    discard(spark, ats)
    first = around.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = saved(first.filter("first_id < last_id").drop("last_id"), "first")
    discard(spark)
    repeats = around.join(first, ["h1", "h2"]).filter("doc_id > first_id")
    starts = saved(repeats.groupBy("doc_id").agg(F.collect_set("at").alias("starts")), "starts")
    discard(spark, around, first)
    return starts


def _spans(starts: list[int], window: int) -> list[list[int]]:
    """Starts of windows as starts and ends of what they cover."""
    out: list[list[int]] = []
    for s in sorted(starts):
        if out and out[-1][1] >= s:
            out[-1][1] = s + window
        else:
            out.append([s, s + window])
    return out


def dedup_substrings(docs: DataFrame, how: Repeats | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` per document.

    A word is removed if it lies in a window whose words also begin in a document
    with a smaller id; ``spans`` are starts and ends of what is removed, in words.
    What is kept is digested with its words joined by one space.  Null texts are
    empty.  An id stands for one text: rows that repeat it are not repeats of each
    other, and if their texts differ, each loses what any of them would.  Rows without
    an id are left as they are.  Further columns are left out.
    """
    how = how or Repeats()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes())
    named = texts.filter("doc_id is not null")
    copies = copied_documents(named, how)
    starts = repeated_windows(named, copies, how)
    # a copy is one span from its first word to its last
    repeats = starts.select(F.col("doc_id").alias("_id"), "starts", F.lit(False).alias("copied")).unionByName(
        copies.select(F.col("doc_id").alias("_id"), F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copied"))
    )
    joined = texts.join(repeats, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "starts", "copied")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts_, starts_, copied_ in rows_of(batches, "doc_id", "text", "starts", "copied"):
            rows = []
            for doc_id, text, at, copied in zip(ids, texts_, starts_, copied_, strict=True):
                words = text.split()
                own = [s for s in at or () if s + how.window <= len(words)]
                spans = [[0, len(words)]] if copied else _spans(own, how.window)
                kept, end = [], 0
                for span in spans:
                    kept += words[end : span[0]]
                    end = span[1]
                kept += words[end:]
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), spans))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<array<int>>")
