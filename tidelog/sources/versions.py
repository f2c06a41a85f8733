"""A partitioned table with versions: readers see whole commits, or nothing of them.

Data lie below ``data/commit=<name>``, where nothing is ever changed.  A version is a
manifest, one row per partition, that says which commit has the partition's rows.  A
commit writes its data, then the manifest, then a marker, which is renamed into place:
that one step makes the version.  What a crash leaves before it is seen by nobody, and
goes with the next :meth:`VersionedTable.vacuum`.

A manifest is bounded by the calendar, not by the data; it is a table, and is not gathered.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.tables import PARTITION_COLUMNS, write_partitioned


class ConcurrentCommit(RuntimeError):
    """Another writer made the version first; nothing was changed."""


@dataclass
class VersionedTable:
    """``schema`` has the rows with their partition columns ``keys``, which are text."""

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: Sequence[str] = PARTITION_COLUMNS
    # called with the name of each step of a commit before it is taken
    on_step: Callable[[str], None] = lambda step: None

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _files(self):
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        return path_of(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path_of

    @property
    def _manifest_schema(self) -> T.StructType:
        keys = [T.StructField(k, T.StringType()) for k in self.keys]
        own = [T.StructField("commit", T.StringType()), T.StructField("n_rows", T.LongType())]
        return T.StructType([*keys, *own])

    # -- versions ----------------------------------------------------------

    def versions(self) -> list[int]:
        """The versions that can be read, oldest first."""
        fs, path_of = self._files()
        folder = path_of(self._path("versions"))
        if not fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> int | None:
        return (self.versions() or [None])[-1]

    def marker(self, version: int) -> dict:
        """``commit`` and ``manifest`` of a version."""
        text = self.spark.read.text(self._path("versions", f"{version:012d}"), wholetext=True).first()
        return json.loads(text["value"])

    def manifest(self, version: int | None = None) -> DataFrame:
        """Partition columns, ``commit``, ``n_rows`` of a version; of the present one without a number."""
        version = self.current() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self._manifest_schema)
        if version not in self.versions():
            raise ValueError(f"there is no version {version}")
        return self.spark.read.schema(self._manifest_schema).parquet(self._path("manifests", self.marker(version)["manifest"]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; later commits do not change them.

        The manifest is joined by partition columns, so that folders of other commits
        are pruned when the query runs.
        """
        manifest = self.manifest(version)
        fs, path_of = self._files()
        if not fs.exists(path_of(self._path("data"))):
            return self.spark.createDataFrame([], self.schema)
        data = [f for f in self.schema if f.name not in self.keys]
        on = ["commit", *self.keys]
        stored = T.StructType([*data, *(T.StructField(k, T.StringType()) for k in on)])
        rows = self.spark.read.schema(stored).parquet(self._path("data"))
        wanted = manifest.select(*(F.col(k).alias(f"_m_{k}") for k in on))
        # a null partition value is one
        same = [F.col(k).eqNullSafe(F.col(f"_m_{k}")) if k != "commit" else F.col(k) == F.col(f"_m_{k}") for k in on]
        return rows.join(wanted, same, "left_semi").select(*self.schema.fieldNames())

    # -- commits -----------------------------------------------------------

    def commit(self, rows: DataFrame, name: str | None = None, remove: DataFrame | None = None) -> int:
        """A version in which ``rows`` take the place of the partitions that they are in.

        Partitions of ``remove`` go.  A ``name`` that has been committed is not committed
        again: a repeated micro-batch changes nothing.  Returns the version.
        """
        name = name or uuid.uuid4().hex
        known = self.versions()
        for version in reversed(known):
            if self.marker(version)["commit"] == name:
                return version
        before = self.manifest()
        self.on_step("data")
        folder = self._path("data", f"commit={name}")
        write_partitioned(rows.select(*self.schema.fieldNames()), folder, self.keys, mode="overwrite")
        data = [f for f in self.schema if f.name not in self.keys]
        stored = T.StructType([*data, *(T.StructField(k, T.StringType()) for k in self.keys)])
        counts = self.spark.read.schema(stored).parquet(folder).groupBy(*self.keys).agg(F.count("*").alias("n_rows"))
        new = counts.select(*self.keys, F.lit(name).alias("commit"), "n_rows")
        gone = new.select(*self.keys)
        if remove is not None:
            gone = gone.unionByName(remove.select(*self.keys))
        gone = gone.distinct().select(*(F.col(k).alias(f"_g_{k}") for k in self.keys))
        kept = before.join(gone, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in self.keys], "left_anti")
        return self._mark(kept.unionByName(new), name, (known or [-1])[-1] + 1)

    def _mark(self, manifest: DataFrame, name: str, version: int) -> int:
        self.on_step("manifest")
        entries = uuid.uuid4().hex
        # text partition values and a row per partition: adaptive execution sees to the files
        manifest.write.parquet(self._path("manifests", entries))
        self.on_step("marker")
        fs, path_of = self._files()
        temporary = path_of(self._path("versions", f".{entries}"))
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps({"commit": name, "manifest": entries}), "utf-8"))
        out.close()
        self.on_step("rename")
        final = path_of(self._path("versions", f"{version:012d}"))
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            # does not replace a marker that is there
            context.rename(temporary, final, options)
        except Exception as e:
            fs.delete(temporary, False)
            if fs.exists(final):
                raise ConcurrentCommit(f"version {version} is there already") from e
            raise
        return version

    def vacuum(self, keep: int = 10) -> None:
        """Forget all versions but the last ``keep``, and delete what no version needs.

        Not to run beside a commit.
        """
        fs, path_of = self._files()
        for version in self.versions()[:-keep]:
            fs.delete(path_of(self._path("versions", f"{version:012d}")), False)
        left = self.versions()
        manifests = {self.marker(v)["manifest"] for v in left}
        commits: set[str] = set()
        for v in left:
            commits.update(r["commit"] for r in self.manifest(v).select("commit").distinct().toLocalIterator())
        for kind, needed in (("manifests", manifests), ("data", {f"commit={c}" for c in commits})):
            folder = path_of(self._path(kind))
            if fs.exists(folder):
                for status in fs.listStatus(folder):
                    if status.getPath().getName() not in needed:
                        fs.delete(status.getPath(), True)


__all__ = ["ConcurrentCommit", "VersionedTable"]
