"""A snapshot in files by key range, of which a merge rewrites only those that it changes.

The key's values are cut into slots, and every file lies within one slot.  Of each file the
least and the greatest key, the number of rows and a Bloom filter of its keys are kept.  An
increment's keys meet the files of their slot; ranges and filters leave few candidates,
and the keys of these few are read.  Files that do have keys of the increment are written
anew; keys that no file has go to a file of their own, so that mere additions rewrite
nothing.  A slot of many files becomes one with the merge that would add another.

All of it is one commit of a :class:`VersionedTable`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.merge import _newest_first, first_per_key
from tidelog.shared import lookup_join
from tidelog.sources.versions import VersionedTable

# bits of a filter per key, and bits set for one: a key that is not there passes once in a hundred times
_BITS, _HASHES = 10, 7


def _bits_of(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The bits of keys with two hashes each, a row per key."""
    steps = np.arange(_HASHES, dtype=np.uint64)
    return (a.view(np.uint64)[:, None] + steps * (b.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(size)


@dataclass
class KeyedSnapshot:
    """``schema`` has one row per ``key``; ``version`` orders the rows of an increment."""

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str
    version: str
    rows_per_file: int = 1_000_000
    files_per_slot: int = 8

    @cached_property
    def table(self) -> VersionedTable:
        own = [T.StructField("slot", T.StringType()), T.StructField("file", T.StringType())]
        return VersionedTable(self.spark, self.root, T.StructType([*self.schema, *own]), ("slot", "file"))

    def _stats_schema(self) -> str:
        kind = self.schema[self.key].dataType.simpleString()
        return f"slot string, file string, least {kind}, greatest {kind}, n_keys bigint, bloom binary"

    # -- reading -------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(version).select(*self.schema.fieldNames())

    def files(self, version: int | None = None) -> DataFrame:
        """Slot, file, commit and what is known of the keys, of every file of a version."""
        manifest = self.table.manifest(version)
        if self.table.current() is None:
            return manifest.join(self.spark.createDataFrame([], self._stats_schema()), ["slot", "file"])
        schema = self._stats_schema() + ", commit string"
        known = self.spark.read.schema(schema).parquet(f"{self.root.rstrip('/')}/stats")
        return manifest.join(known, ["slot", "file", "commit"])

    # -- writing -------------------------------------------------------------

    def create(self, rows: DataFrame) -> int:
        """The first version: files of about ``rows_per_file`` rows, a slot each."""
        n = max(1, -(-rows.count() // self.rows_per_file))
        parts = rows.repartitionByRange(n, self.key).withColumn("slot", F.lpad(F.spark_partition_id().cast("string"), 6, "0"))
        return self._commit(parts.withColumn("file", F.concat(F.lit("base-"), "slot")), None)

    def merge(self, increment: DataFrame) -> int:
        """A version in which increment rows replace those of their keys, and new keys are added.

        Of several increment rows of a key the newest counts.  Null keys are left out.
        """
        known = increment.filter(F.col(self.key).isNotNull())
        new = first_per_key(known, [self.key], *_newest_first(known, self.version)).select(*self.schema.fieldNames())
        files = self.files()
        new = new.withColumn("slot", self._slot(files))
        there = self._found(new, files)
        placed = lookup_join(new, there.select(self.key, "file"), [self.key])
        name = uuid.uuid4().hex
        # a slot that would have too many files is written anew as one
        added = placed.filter("file is null").select("slot").distinct().withColumn("more", F.lit(1))
        counts = files.groupBy("slot").agg(F.count("*").alias("n_files"))
        full = counts.join(added, "slot").filter(F.col("n_files") >= self.files_per_slot).select("slot")
        touched = there.select("slot", "file").distinct().unionByName(files.select("slot", "file").join(full, "slot", "left_semi")).distinct()
        whole = full.withColumn("whole", F.lit(True))
        old = lookup_join(self.table.read(), touched, ["slot", "file"], how="left_semi")
        kept = lookup_join(old, new.select(self.key), [self.key], how="left_anti")
        rows = kept.unionByName(placed.select(*kept.columns))
        rows = lookup_join(rows, whole, ["slot"])
        own = F.concat(F.lit(f"{name}-"), "slot")
        rows = rows.withColumn("file", F.when(F.col("whole"), own).otherwise(F.coalesce("file", own))).drop("whole")
        return self._commit(rows, touched, name)

    def _commit(self, rows: DataFrame, remove: DataFrame | None, name: str | None = None) -> int:
        name = name or uuid.uuid4().hex
        # written first, so that what is known of the files is of these rows
        staged = f"{self.root.rstrip('/')}/staged/{name}"
        rows.write.parquet(staged)
        rows = self.spark.read.schema(self.table.schema).parquet(staged)
        self._stats(rows).write.parquet(f"{self.root.rstrip('/')}/stats/commit={name}")
        if remove is not None:
            gone = f"{self.root.rstrip('/')}/staged/{name}-gone"
            remove.write.parquet(gone)
            remove = self.spark.read.schema("slot string, file string").parquet(gone)
        version = self.table.commit(rows, name=name, remove=remove)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root.rstrip('/')}/staged")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return version

    def _hashes(self) -> tuple[Column, Column]:
        return F.xxhash64(self.key).alias("a"), F.xxhash64(self.key, F.lit(1)).alias("b")

    def _stats(self, rows: DataFrame) -> DataFrame:
        def filter_of(group: pa.Table) -> pa.Table:
            a, b = (group.column(c).to_numpy() for c in ("a", "b"))
            size = 8 * -(-_BITS * max(1, len(a)) // 8)
            bits = np.zeros(size, np.uint8)
            bits[_bits_of(a, b, size).ravel().astype(np.int64)] = 1
            one = {c: [group.column(c)[0].as_py()] for c in ("slot", "file")}
            return pa.table({**{c: pa.array(v, pa.string()) for c, v in one.items()}, "bloom": pa.array([np.packbits(bits).tobytes()], pa.binary())})

        # a file has a bounded number of rows
        blooms = rows.select("slot", "file", *self._hashes()).groupBy("slot", "file").applyInArrow(filter_of, "slot string, file string, bloom binary")
        ranges = rows.groupBy("slot", "file").agg(F.min(self.key).alias("least"), F.max(self.key).alias("greatest"), F.count("*").alias("n_keys"))
        return ranges.join(blooms, ["slot", "file"])

    def _slot(self, files: DataFrame) -> Column:
        """The slot of a key: the last one that starts at or before it, else the first."""
        rows = files.groupBy("slot").agg(F.min("least").alias("least")).orderBy("slot").collect()
        names = [r["slot"] for r in rows] or ["000000"]
        starts = [r["least"] for r in rows][1:]
        if not starts:
            return F.lit(names[0])

        @F.pandas_udf("string")
        def slot(keys: pd.Series) -> pd.Series:
            at = np.searchsorted(np.array(starts, dtype=object), keys.to_numpy(dtype=object), side="right")
            return pd.Series(np.array(names, dtype=object)[at])

        return slot(F.col(self.key))

    def _found(self, new: DataFrame, files: DataFrame) -> DataFrame:
        """(key, slot, file) of increment keys that are in a file."""

        def passing(keys: pa.Table, held: pa.Table) -> pa.Table:
            files_ = {"slot": [], "file": []}
            if keys.num_rows:
                a, b = (keys.column(c).to_numpy() for c in ("a", "b"))
                for slot, file, bloom in zip(*(held.column(c).to_pylist() for c in ("slot", "file", "bloom"))):
                    bits = np.unpackbits(np.frombuffer(bloom, np.uint8))
                    if bits[_bits_of(a, b, len(bits)).astype(np.int64)].all(axis=1).any():
                        files_["slot"].append(slot)
                        files_["file"].append(file)
            return pa.table({c: pa.array(v, pa.string()) for c, v in files_.items()})

        ranges = files.select(*(F.col(c).alias(f"f_{c}") for c in ("slot", "file", "least", "greatest")))
        near = new.select("slot", self.key).join(
            ranges, (F.col("slot") == F.col("f_slot")) & F.col(self.key).between(F.col("f_least"), F.col("f_greatest"))
        )
        keys = near.select("slot", F.col("f_file").alias("file"), *self._hashes())
        blooms = files.select("slot", "file", "bloom")
        maybe = keys.groupBy("slot", "file").cogroup(blooms.groupBy("slot", "file")).applyInArrow(passing, "slot string, file string")
        own = lookup_join(self.table.read().select(self.key, "slot", "file"), maybe.distinct(), ["slot", "file"], how="left_semi")
        return lookup_join(own, new.select(self.key), [self.key], how="left_semi")
