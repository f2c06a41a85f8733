"""Sinks, table reads, merge and SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import text
from tidelog.operators import merge, progress
from tidelog.operators.mapping import MAP
from tidelog.operators.snapshots import KeyedSnapshot
from tidelog.plans.sample_log import N_PIPELETS, load
from tidelog.shared import scratch_path
from tidelog.sources import delimited, tables
from tidelog.sources.versions import VersionedTable
from workload import query
from workload.inputs import SRC, day_rows

_TEXT_SCHEMA = T.StructType(
    [
        T.StructField("note", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("took", T.LongType()),
        T.StructField("bad_number", T.LongType()),
        T.StructField("params", MAP),
        T.StructField("event_type", T.StringType()),
    ]
)


def _text_rows(spark, sf_dir):
    """Rows for the text form: first column mostly empty, a separator and a newline in it else."""
    e = F.col("event_id")
    note = F.when(e % 3 == 0, F.concat(F.lit("a\x01b\nc"), e.cast("string"))).otherwise("")
    params = F.create_map(F.lit("u"), F.col("user_id").cast("string"), F.lit("t"), F.col("event_type"))
    return load(spark, sf_dir, "events").select(
        note.alias("note"),
        e,
        F.concat((e + 1000000000).cast("string"), F.lit(".895")).alias("took"),
        F.lit("x").alias("bad_number"),
        params.alias("params"),
        "event_type",
    )


_NOTE_SQL = "case when event_id % 3 = 0 then 'ab' || chr(3) || 'c' || event_id else '' end"


@query(
    "write_delimited",
    f"""select {_NOTE_SQL} || '|' || event_id || '|' || (event_id + 1000000000) || '.895|x|u:' || user_id
      || ',t:' || event_type || '|' || event_type as line from events""",
)
def write_delimited(spark, sf_dir):
    """The lines as they lie in the files; an empty first field keeps its separator."""
    path = scratch_path(spark, "text")
    delimited.write_delimited(_text_rows(spark, sf_dir), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.replace("value", F.lit("\x01"), F.lit("|")).alias("line"))


@query(
    "scan_delimited",
    f"""select {_NOTE_SQL} as note, event_id, event_id + 1000000000 as took, cast(-1 as bigint) as bad_number,
      'u:' || user_id || ',t:' || event_type as params, event_type from events""",
)
def scan_delimited(spark, sf_dir):
    """Text written and read back by position, as typed columns."""
    path = scratch_path(spark, "text")
    delimited.write_delimited(_text_rows(spark, sf_dir), path)
    return delimited.scan_delimited(spark, path, _TEXT_SCHEMA).select(
        "note",
        "event_id",
        "took",
        F.coalesce("bad_number", F.lit(-1)).cast("bigint").alias("bad_number"),
        text.map_to_string(F.col("params")).alias("params"),
        "event_type",
    )


@query(
    "write_partitioned",
    SRC
    + """select strftime(ts, '%Y%m%d') as event_day, '00' as event_hour, '00' as event_minute,
      count(*) as n_rows, cast(sum(msg_id) as bigint) as id_sum from src group by 1""",
)
def write_partitioned(spark, sf_dir):
    """Whole days, written twice: a partition is replaced, not doubled."""
    path = scratch_path(spark, "parts")
    for _ in range(2):
        tables.write_partitioned(day_rows(spark, sf_dir), path, mode="overwrite")
    written = tables.scan_partitions(spark, path)
    return written.groupBy(*tables.PARTITION_COLUMNS).agg(
        F.count("*").alias("n_rows"), F.sum("msg_id").alias("id_sum")
    )


@query(
    "scan_partitions",
    SRC
    + """select pipelet, msg_id, strftime(ts, '%Y%m%d') as event_day, '00' as event_hour
      from src where strftime(ts, '%Y%m%d') >= '20240115'""",
)
def scan_partitions(spark, sf_dir):
    """A filter on the partition columns reads only those folders; ``00`` stays text."""
    path = scratch_path(spark, "parts")
    tables.write_partitioned(day_rows(spark, sf_dir), path)
    pruned = tables.scan_partitions(spark, path).filter("event_day >= '20240115' and event_hour = '00'")
    return pruned.select("pipelet", "msg_id", "event_day", "event_hour")


@query(
    "list_bucket_files",
    SRC
    + """select distinct pipelet % 4 as pipelet, day_bucket as bucket,
      case when substr(day_bucket, 8, 1) = '1' then 'done' else 'pending' end as state from src""",
)
def list_bucket_files(spark, sf_dir):
    """Real files, one folder per bucket file name; contents are not read."""
    path = scratch_path(spark, "files")
    rows = day_rows(spark, sf_dir)
    name = F.concat(F.lit("example_"), (F.col("pipelet") % 4).cast("string"), F.lit("_"), F.col("bucket"))
    done = F.when(F.substring("bucket", 8, 1) == "1", ".done").otherwise("")
    named = rows.select("msg_id", F.concat(name, done).alias("file"))
    other = rows.select("msg_id", F.concat(F.lit("other_0_"), F.col("bucket")).alias("file"))
    tables.write_partitioned(named.unionByName(other), path, keys=("file",))
    base = F.regexp_extract("path", "/file=([^/]+)/", 1)
    files = tables.parse_bucket_files(tables.list_files(spark, path), "example", base)
    return files.select("pipelet", "bucket", "state").distinct()


_PUBLIC_DAYS = SRC + """, listed as (select pipelet, day_bucket, count(*) as n from src group by 1, 2),
  opened as (select *, max(day_bucket) over (partition by pipelet) as newest from listed),
  public as (select day_bucket from opened where day_bucket < newest group by 1
    having bit_or(cast(1 as bigint) << pipelet) = 65535)
"""


def _published_table(spark, sf_dir):
    """A table over all written days, of which only the complete ones are public."""
    location, name = scratch_path(spark, "events"), f"events_{uuid.uuid4().hex}"
    rows = day_rows(spark, sf_dir)
    tables.write_partitioned(rows, location)
    tables.create_event_table(spark, name, rows.schema, location)
    public = progress.publishable(rows, N_PIPELETS)
    keys = public.select(
        F.substring("partition", 1, 8).alias("event_day"),
        F.substring("partition", 9, 2).alias("event_hour"),
        F.substring("partition", 11, 2).alias("event_minute"),
    )
    tables.publish_partitions(spark, name, location, keys)
    return name


@query(
    "publish_partition",
    _PUBLIC_DAYS
    + """select pipelet, msg_id, day_bucket as bucket, substr(day_bucket, 1, 8) as event_day from src
      where day_bucket in (select day_bucket from public)""",
)
def publish_partition(spark, sf_dir):
    name = _published_table(spark, sf_dir)
    return spark.table(name).select("pipelet", "msg_id", "bucket", "event_day")


@query(
    "create_event_table",
    _PUBLIC_DAYS
    + """select substr(day_bucket, 1, 8) as event_day, '00' as event_hour, '00' as event_minute from public""",
)
def create_event_table(spark, sf_dir):
    """The partitions the catalog knows of the table."""
    name = _published_table(spark, sf_dir)
    parts = spark.sql(f"SHOW PARTITIONS {name}")

    def value(key):
        return F.regexp_extract("partition", f"{key}=([^/]+)", 1).alias(key)

    return parts.select(*(value(k) for k in tables.PARTITION_COLUMNS))


_BY_TYPE = "select event_type, count(*) as n_events, min(event_id) as first_id from events group by event_type"


def _events_view(spark, sf_dir):
    view = f"events_{uuid.uuid4().hex}"
    load(spark, sf_dir, "events").createOrReplaceTempView(view)
    return view


@query("sql_query", _BY_TYPE)
def sql_query(spark, sf_dir):
    view = _events_view(spark, sf_dir)
    return tables.sql_query(spark, _BY_TYPE.replace("from events", f"from {view}"))


@query("sql_file", "select event_type, n_events from (" + _BY_TYPE + ") where event_type <> ';'")
def sql_file(spark, sf_dir):
    """A script of two statements, read from a file in the shared folder."""
    view = _events_view(spark, sf_dir)
    script = f"""-- counts; by type
    create or replace temporary view {view}_counts as {_BY_TYPE.replace("from events", f"from {view}")};
    select event_type, n_events from {view}_counts where event_type <> ';';
    """
    path = scratch_path(spark, "script")
    spark.createDataFrame([(script,)], "value string").coalesce(1).write.text(path)
    return tables.sql_file(spark, path)


# -- merge ---------------------------------------------------------------

_MERGE_INPUT = """with snapshot as (
    select o_orderkey as k, cast(1 as bigint) as version, o_orderstatus as status, o_totalprice as price from orders),
  increment as (
    select o_orderkey as k, cast(2 as bigint) as version, 'U' as status, o_totalprice as price from orders
      where o_orderkey % 3 = 0
    union all select o_orderkey, 3, 'V', o_totalprice from orders where o_orderkey % 9 = 0
    union all select -1 - o_orderkey, 1, 'N', o_totalprice from orders where o_orderkey % 5 = 0),
  both_inputs as (select *, cast(0 as bigint) as is_increment from snapshot
    union all select *, 1 from increment)
"""


def _merge_inputs(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def side(key, version, status):
        return orders.select(
            key.alias("k"),
            F.lit(version).cast("bigint").alias("version"),
            status.alias("status"),
            F.col("o_totalprice").alias("price"),
        )

    snapshot = side(k, 1, F.col("o_orderstatus"))
    updated = side(k, 2, F.lit("U")).filter(k % 3 == 0)
    again = side(k, 3, F.lit("V")).filter(k % 9 == 0)
    new = side(-1 - k, 1, F.lit("N")).filter(k % 5 == 0)
    return updated.unionByName(again).unionByName(new), snapshot


@query(
    "snapshot_merge",
    _MERGE_INPUT
    + """select k, version, status, price from both_inputs
      qualify row_number() over (partition by k order by is_increment desc, version desc) = 1""",
)
def snapshot_merge(spark, sf_dir):
    """An updated, a twice updated, a new and an untouched part."""
    increment, snapshot = _merge_inputs(spark, sf_dir)
    return merge.snapshot_merge(increment, snapshot, ["k"], "version")


@query("union_inputs", _MERGE_INPUT + "select k, version, status, price, is_increment from both_inputs")
def union_inputs(spark, sf_dir):
    both = merge.union_inputs(*_merge_inputs(spark, sf_dir))
    return both.withColumn("is_increment", F.col("is_increment").cast("bigint"))


@query(
    "write_snapshot",
    """select o_orderkey as k, cast(o_orderkey % 7 as bigint) as version, 'new' as which from orders
      union all select o_orderkey, cast(0 as bigint), 'old' from orders where o_orderkey % 2 = 0""",
)
def write_snapshot(spark, sf_dir):
    """A snapshot replaced by one that is made from it; the old one stays under another name."""
    target = scratch_path(spark, "snapshot")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    merge.write_snapshot(orders.filter("k % 2 = 0").withColumn("version", F.lit(0).cast("bigint")), target)
    old = spark.read.parquet(target)
    increment = orders.withColumn("version", (F.col("k") % 7).cast("bigint"))
    merge.write_snapshot(merge.snapshot_merge(increment, old, ["k"], "version"), target)
    both = ((target, "new"), (f"{target}.bak", "old"))
    new, kept = (spark.read.parquet(path).withColumn("which", F.lit(which)) for path, which in both)
    return new.unionByName(kept)


@query(
    "scan_delimited_empty",
    """select text as only, count(*) as n from (
      select case when event_id % 5 = 0 then '' when event_id % 5 = 1 then 'a\\b' when event_id % 5 = 2 then '"q' || chr(13)
        else event_type end as text from events) group by 1""",
)
def scan_delimited_empty(spark, sf_dir):
    """One text column: empty rows are rows."""
    e = F.col("event_id") % 5
    only = F.when(e == 0, "").when(e == 1, "a\\b").when(e == 2, '"q\r').otherwise(F.col("event_type")).alias("only")
    path = scratch_path(spark, "text")
    rows = load(spark, sf_dir, "events").select(only)
    delimited.write_delimited(rows, path)
    return delimited.scan_delimited(spark, path, rows.schema).groupBy("only").agg(F.count("*").alias("n"))


_DAY = "cast(substr(day_bucket, 7, 2) as bigint)"


@query(
    "publish_versions",
    SRC
    + f""", versions as (
      select 0 as version, day_bucket, msg_id from src where msg_id % 3 <> 0
      union all select 1, day_bucket, msg_id from src where {_DAY} % 5 <> 0 and ({_DAY} % 2 = 0 or msg_id % 3 <> 0))
    select cast(version as bigint) as version, day_bucket as bucket, count(*) as n_rows, cast(sum(msg_id) as bigint) as ids
    from versions group by 1, 2""",
)
def publish_versions(spark, sf_dir):
    """Two versions of a table: even days are replaced, every fifth day goes; both can be read."""
    rows = day_rows(spark, sf_dir).select("msg_id", "bucket", *tables.PARTITION_COLUMNS)
    day = F.col("event_day").substr(7, 2).cast("bigint")
    table = VersionedTable(spark, scratch_path(spark, "versions"), rows.schema)
    table.commit(rows.filter("msg_id % 3 <> 0"))
    table.commit(rows.filter((day % 2 == 0) & (day % 5 != 0)), remove=rows.filter(day % 5 == 0).select(*table.keys).distinct())
    both = table.read(0).withColumn("version", F.lit(0)).unionByName(table.read(1).withColumn("version", F.lit(1)))
    return both.groupBy(F.col("version").cast("bigint").alias("version"), "bucket").agg(
        F.count("*").alias("n_rows"), F.sum("msg_id").alias("ids")
    )


@query(
    "snapshot_files",
    _MERGE_INPUT
    + """select k, version, status, price from both_inputs
      qualify row_number() over (partition by k order by is_increment desc, version desc) = 1""",
)
def snapshot_files(spark, sf_dir):
    """The same merge into files by key range, of which only those with keys of the increment are rewritten."""
    increment, snapshot = _merge_inputs(spark, sf_dir)
    whole = KeyedSnapshot(spark, scratch_path(spark, "snapshot"), snapshot.schema, "k", "version", rows_per_file=5_000)
    whole.create(snapshot)
    # new keys first, which no file has; then those that there are
    whole.merge(increment.filter("k < 0"))
    whole.merge(increment.filter("k >= 0"))
    return whole.read()
