"""Partitioned event tables, their publication, and SQL text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ("event_day", "event_hour", "event_minute")
_ADD_AT_ONCE = 500


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTITION_COLUMNS,
    mode: str = "append",
    rebalance: bool = True,
) -> None:
    """Write Parquet under ``key=value`` folders.

    ``rebalance`` groups rows by partition first, so that a folder gets few
    files; adaptive execution splits a hot partition over several tasks.  With
    ``mode="overwrite"`` only the partitions in ``df`` are replaced: give whole
    partitions.
    """
    if rebalance:
        df = df.hint("rebalance", *(F.col(k) for k in keys))
    writer = df.write.mode(mode).partitionBy(*keys)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def scan_partitions(
    spark: SparkSession, path: str, keys: Sequence[str] = PARTITION_COLUMNS, schema: T.StructType | None = None
) -> DataFrame:
    """Read a partitioned table with its partition columns as text (``00`` stays ``00``)."""
    schema = schema or spark.read.parquet(path).schema
    data = [f for f in schema if f.name not in keys]
    parts = [T.StructField(k, T.StringType()) for k in keys]
    return spark.read.schema(T.StructType([*data, *parts])).parquet(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of every file under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path")


def parse_bucket_files(files: DataFrame, app: str, name: Column) -> DataFrame:
    """Keep names ``{app}_{pipelet}_{bucket}[.done]``; add pipelet, bucket and state."""
    pattern = rf"^{re.escape(app)}_(\d+)_(\d{{12}})(\.done)?$"
    kept = files.withColumn("file_name", name).filter(F.col("file_name").rlike(pattern))

    def group(i: int) -> Column:
        return F.regexp_extract("file_name", pattern, i)

    return kept.select(
        "*",
        group(1).cast("bigint").alias("pipelet"),
        group(2).alias("bucket"),
        F.when(group(3) == "", "pending").otherwise("done").alias("state"),
    )


def not_uploaded(files: DataFrame, keys: Sequence[str] = ("pipelet", "bucket")) -> DataFrame:
    """Pending entries whose bucket is not marked done."""
    done = files.filter("state = 'done'").select(*keys)
    return files.filter("state != 'done'").join(done, list(keys), "left_anti")


def partition_exists(requested: DataFrame, published: DataFrame, keys: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """The requested partitions that are present."""
    return requested.join(published.select(*keys), list(keys), "left_semi")


def create_event_table(spark: SparkSession, name: str, schema: T.StructType, location: str, replace: bool = False) -> None:
    """External Parquet table with the event columns and text partition columns."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    data = [f for f in schema if f.name not in PARTITION_COLUMNS]
    columns = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in data] + [f"{k} string" for k in PARTITION_COLUMNS]
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{location}'"
    )


def publish_partitions(spark: SparkSession, table: str, location: str, partitions: DataFrame, replace: bool = False) -> None:
    """Make written partitions of an external table visible.

    ``partitions`` has one row per bucket, so it is bounded by the calendar;
    the statements add several hundred at a time.  With ``replace`` those that the table
    has already point to the new location after that.
    """
    batch: list[str] = []
    moved: list[str] = []

    def add() -> None:
        if batch:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(batch))
            for change in moved:
                spark.sql(f"ALTER TABLE {table} {change}")
            batch.clear()
            moved.clear()

    for row in partitions.select(*PARTITION_COLUMNS).toLocalIterator():
        spec = ", ".join(f"{k}='{row[k]}'" for k in PARTITION_COLUMNS)
        folder = "/".join(f"{k}={row[k]}" for k in PARTITION_COLUMNS)
        batch.append(f"PARTITION ({spec}) LOCATION '{location.rstrip('/')}/{folder}'")
        if replace:
            moved.append(f"PARTITION ({spec}) SET LOCATION '{location.rstrip('/')}/{folder}'")
        if len(batch) == _ADD_AT_ONCE:
            add()
    add()


def sql_query(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(statement)


# quoted text, in which a backslash or a doubled quote hides the quote; names; comments; the end of a statement
_QUOTED = re.compile(r"'(?:\\.|''|[^'\\])*'|\"(?:\\.|\"\"|[^\"\\])*\"|`(?:``|[^`])*`", re.S)
_PLAIN = re.compile(r"[^;'\"`/-]+|[/-]")


def split_statements(script: str) -> list[str]:
    """The statements of a script, without comments.

    Statements end with ``;`` outside of quotes and comments.  ``--`` comments run to the
    line end, ``/*`` ones to their ``*/``, and nest; hints ``/*+`` stay.  A quote or a
    comment that does not end is an error.
    """
    statements, current, at = [], [], 0
    while at < len(script):
        if script.startswith("--", at):
            end = script.find("\n", at)
            at = len(script) if end < 0 else end
        elif script.startswith("/*", at):
            start, at = at, _comment_end(script, at)
            current.append(script[start:at] if script.startswith("/*+", start) else " ")
        elif script[at] == ";":
            statements.append("".join(current))
            current, at = [], at + 1
        else:
            found = _QUOTED.match(script, at) or _PLAIN.match(script, at)
            if not found:
                raise ValueError(f"the quote {script[at]} at {at} does not end: {script[at : at + 40]}")
            current.append(found[0])
            at = found.end()
    return [s for s in [*statements, "".join(current)] if s.strip()]


def _comment_end(script: str, at: int) -> int:
    depth, place = 0, at
    for found in re.compile(r"/\*|\*/").finditer(script, at):
        depth += 1 if found[0] == "/*" else -1
        place = found.end()
        if depth == 0:
            return place
    raise ValueError(f"the comment at {at} does not end: {script[at : at + 40]}")


def sql_script(spark: SparkSession, script: str) -> DataFrame | None:
    """Run the statements of a script; the result is that of the last one."""
    result = None
    for statement in split_statements(script):
        result = spark.sql(statement)
    return result


def sql_file(spark: SparkSession, path: str) -> DataFrame | None:
    """Run a script file, from any file system Spark reads."""
    script = spark.read.text(path, wholetext=True).first()
    return sql_script(spark, script["value"] if script else "")
