"""Words, hashes, running totals and shared tables that the operators have in common."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.shared import scratch_path

# bytes of text that are hashed at once
PART_BYTES = 1 << 19
# bytes of rows that go to Python at once
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """From now on batches that go to Python have at most ``BATCH_BYTES``, if the session allows more.

    Spark's own bound of 64 MB is held several times over, on both sides and by every
    task of an executor at once.
    """
    if spark.conf.get(_BATCH_SETTING, "64m") in ("64m", "67108864", "67108864b", "-1", "-1b"):
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame's rows, written once to the folder that all executors share, with a writer's options."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete what ``saved`` wrote for frames that are used no more.

    Shuffle files of finished steps go as well, once the driver has let go of the
    plans they belong to, which Python and the JVM are asked to do here.
    """
    for df in frames:
        path = spark._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def unused(name: str, columns: Sequence[str]) -> str:
    """A column name that is not taken yet."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """Some columns, and all of a row as the struct ``row``, safe from any other names."""
    return docs.select(*names, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def with_text(row: Column, text: Column, changed: Column, docs: DataFrame) -> Column:
    """The packed row with another text where it has changed, and ``n_chars``, if there, after it."""
    new = row.withField("text", F.when(changed, text).otherwise(row["text"]))
    if "n_chars" in docs.columns:
        n_chars = F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
        new = new.withField("n_chars", n_chars)
    return new


def text_bytes(column: str = "text") -> Column:
    """A text's UTF-8 bytes; those of a null text are empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"")).alias(column)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number's bits spread over all of its bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            factors = np.full(size, _ODD, np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = _INVERSE
            self.down = np.multiply.accumulate(factors)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_BYTE_VALUES = [np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64) for seed in (11, 12)]


def _factors(places: np.ndarray, seed: int) -> np.ndarray:
    """An odd factor for each place in a word, unlike any other's."""
    return mixed((places.astype(np.uint64) + np.uint64(1 + (seed << 40))) * np.uint64(_ODD)) | np.uint64(1)


# those of the first places are kept at hand
_FIRST = [_factors(np.arange(1 << 12), seed) for seed in (0, 1)]


def _hashed(part: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends and hashes of the words in a part of text that cuts no word.

    A word's hash adds up its bytes' values, each times the factor of its place; no
    power of one base stands behind the factors, so no pattern of letters cancels out.
    """
    n = len(part)
    space = np.ones(n + 2, bool)
    space[1:-1] = _SPACES[part]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return ends, np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    places = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    factors = _FIRST[seed][places] if lengths.max() <= len(_FIRST[seed]) else _factors(places, seed)
    sums = np.add.reduceat(_BYTE_VALUES[seed][part[~space[1:-1]]] * factors, first)
    return ends, mixed(sums + lengths.astype(np.uint64))


def _hashes_of_one(text: bytes, seed: int) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    found, start = [], 0
    while start < len(raw):
        end = min(len(raw), start + PART_BYTES)
        while end < len(raw) and not _SPACES[raw[end]]:
            # on to the end of the word, however long
            ahead = _SPACES[raw[end : end + PART_BYTES]]
            end += int(ahead.argmax()) if ahead.any() else len(ahead)
        found.append(_hashed(raw[start:end], seed)[1])
        start = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def word_hashes(texts: Sequence[bytes], seed: int = 0) -> list[np.ndarray]:
    """64-bit hashes of the words of each text; ``seed`` is 0 or 1.

    Words are what ASCII white space divides.  Texts are hashed together, as many as
    make half a megabyte, by prefix sums over their bytes.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        last, size = at, 0
        while last < len(texts) and size + len(texts[last]) < PART_BYTES:
            size += len(texts[last]) + 1
            last += 1
        if last == at:
            out.append(_hashes_of_one(texts[at], seed))
            at += 1
            continue
        some = texts[at:last]
        ends, hashes = _hashed(np.frombuffer(b" ".join(some), np.uint8), seed)
        limits = np.cumsum([len(t) + 1 for t in some])
        out += np.split(hashes, np.searchsorted(ends, limits[:-1]))
        at = last
    return out


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k numbers: a polynomial modulo 2**64, from prefix sums."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _POWERS.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Columns of each batch as lists, for a few hundred rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield tuple(part.column(part.schema.get_field_index(n)).to_pylist() for n in names)


def running_total(
    df: DataFrame, by: Sequence[str], block: str, order: Sequence[Column | str], value: Column, name: str, total: str | None = None
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all earlier rows of the group ``by``.

    Rows are ordered by ``block``, then by ``order``.  A group is not sorted in one
    task: each block is added up by itself, and block totals, few as they are, give
    the sum over the earlier blocks, and ``total``, that of the group, if it is named.
    ``by`` and ``block`` must not be null.
    """
    keys = [*by, block]
    df = df.withColumn("_value", value)
    totals = df.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy(block).rowsBetween(Window.unboundedPreceding, 0)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        *(F.col(k).alias(f"_{k}") for k in keys),
        (F.sum("_total").over(earlier) - F.col("_total")).alias("_start"),
        F.sum("_total").over(whole).alias("_whole"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # said outright, as rows that a join left together by group alone would else stay so
    df = df.repartition(*keys).withColumn("_sum", F.sum("_value").over(inside) - F.col("_value"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    joined = df.join(starts, on).withColumn(name, F.col("_start") + F.col("_sum"))
    if total:
        joined = joined.withColumn(total, F.col("_whole"))
    return joined.drop("_value", "_sum", "_start", "_whole", *(f"_{k}" for k in keys))


def hash_block(key: Column, blocks: int) -> Column:
    """A block from 0 to ``blocks - 1`` by the key's digest."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 4), 16, 10).cast("int") % blocks).alias("block")
