"""Buckets, shards, completeness and lateness."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import clock
from tidelog.functions.clock import bucket_key
from tidelog.operators import buckets, corrections, merge, progress, sketches
from tidelog.operators import ids as id_sets
from tidelog.plans.sample_log import N_PIPELETS, load
from tidelog.shared import scratch_path
from tidelog.sources import pipe
from tidelog.sources.versions import VersionedTable
from tidelog.streaming import shards
from workload import query
from workload.inputs import SRC, day_rows, days, rows

FULL = progress.full_mask(N_PIPELETS)

# one row per pipelet and hour, with the pipelet's newest hour
LISTED = SRC + """, listed as (select pipelet, bucket, count(*) as n_rows from src group by 1, 2),
  opened as (select *, max(bucket) over (partition by pipelet) as newest from listed),
  masks as (select bucket as "partition", bit_or(cast(1 as bigint) << pipelet) as mask from listed group by 1),
  sealed as (select bucket as "partition", bit_or(cast(1 as bigint) << pipelet) as mask
    from opened where bucket < newest group by 1)
"""
# the inventory: every third day is marked done
STATE_SQL = "case when cast(substr(bucket, 7, 2) as bigint) % 3 = 0 then 'done' else 'pending' end"


def _listed(spark, sf_dir):
    return buckets.bucket_counts(rows(spark, sf_dir))


def _masked(listed):
    """Delivery lists with the mask that stands for them."""
    return listed.select("partition", progress.mask_of(F.col("pipelets")).alias("mask"))


def inventory(spark, sf_dir):
    """``pipelet, bucket, state`` of every bucket file."""
    done = F.substring("bucket", 7, 2).cast("int") % 3 == 0
    return _listed(spark, sf_dir).select(
        "pipelet", "bucket", F.when(done, "done").otherwise("pending").alias("state")
    )


@query("bucket_counts", LISTED + "select pipelet, bucket, n_rows from listed")
def bucket_counts(spark, sf_dir):
    return _listed(spark, sf_dir)


@query("open_bucket", LISTED + "select pipelet, bucket, newest, n_rows from opened")
def open_bucket(spark, sf_dir):
    return buckets.open_bucket(_listed(spark, sf_dir))


@query("all_but_latest", LISTED + "select pipelet, bucket, n_rows from opened where bucket < newest")
def all_but_latest(spark, sf_dir):
    return buckets.all_but_latest(_listed(spark, sf_dir))


@query(
    "seal_bucket",
    LISTED + "select pipelet, bucket, cast(bucket < newest as bigint) as is_sealed from opened",
)
def seal_bucket(spark, sf_dir):
    opened = buckets.open_bucket(_listed(spark, sf_dir))
    sealed = (F.col("bucket") < F.col("newest")).cast("bigint")
    return opened.select("pipelet", "bucket", sealed.alias("is_sealed"))


@query(
    "bucket_order",
    LISTED + """select pipelet, bucket, row_number() over (order by pipelet, bucket) as place from
      (select pipelet, bucket from listed)""",
)
def bucket_order(spark, sf_dir):
    return buckets.bucket_order(_listed(spark, sf_dir)).select("pipelet", "bucket", "place")


@query("completeness_mask", LISTED + 'select "partition", mask from masks')
def completeness_mask(spark, sf_dir):
    return progress.completeness_mask(rows(spark, sf_dir))


@query("complete_partitions", LISTED + f'select "partition", mask from masks where mask = {FULL}')
def complete_partitions(spark, sf_dir):
    return _masked(progress.complete_partitions(progress.deliveries(rows(spark, sf_dir)), N_PIPELETS))


@query("full_filter", LISTED + f"""select cast(mask = {FULL} as bigint) as is_full, count(*) as n_partitions
    from masks group by 1""")
def full_filter(spark, sf_dir):
    masks = progress.completeness_mask(rows(spark, sf_dir))
    return masks.groupBy((F.col("mask") == FULL).cast("bigint").alias("is_full")).agg(
        F.count("*").alias("n_partitions")
    )


@query(
    "missing_pipelets",
    LISTED + f"""select "partition", mask, array_to_string(list_filter(range({N_PIPELETS}),
      lambda i: mask & (cast(1 as bigint) << i) = 0), ',') as missing from masks""",
)
def missing_pipelets(spark, sf_dir):
    missing = progress.missing_pipelets(progress.deliveries(rows(spark, sf_dir)), N_PIPELETS)
    joined = F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing")
    return missing.select("partition", progress.mask_of(F.col("pipelets")).alias("mask"), joined)


@query("upsert_status", LISTED + 'select "partition", mask from masks')
def upsert_status(spark, sf_dir):
    """Half of the pipelets delivered before, the others now, some of them again."""
    all_rows = rows(spark, sf_dir)
    status = progress.deliveries(all_rows.filter(F.col("pipelet") < N_PIPELETS // 2))
    again = all_rows.filter(F.col("pipelet") >= N_PIPELETS // 4).select(F.col("bucket").alias("partition"), "pipelet")
    return _masked(progress.upsert_status(status, again))


@query(
    "min_progress",
    LISTED + """select count(*) as n_pipelets, min(newest) as frontier
    from (select pipelet, max(bucket) as newest from listed group by 1)""",
)
def min_progress(spark, sf_dir):
    return progress.min_progress(rows(spark, sf_dir))


@query("publishable", LISTED + f'select "partition", mask from sealed where mask = {FULL}')
def publishable(spark, sf_dir):
    return _masked(progress.publishable(rows(spark, sf_dir), N_PIPELETS))


@query(
    "publication_status",
    LISTED
    + f"""select m."partition", m.mask as delivered, coalesce(s.mask, 0) as sealed, n.n_rows,
      cast(coalesce(s.mask, 0) = {FULL} as bigint) as is_public
    from masks m left join sealed s on s."partition" = m."partition"
    join (select bucket, cast(sum(n_rows) as bigint) as n_rows from listed group by 1) n on n.bucket = m."partition" """,
)
def publication_status(spark, sf_dir):
    status = progress.publication_status(rows(spark, sf_dir), N_PIPELETS)
    masks = (progress.mask_of(F.col(n)).alias(n) for n in ("delivered", "sealed"))
    return status.select("partition", *masks, "n_rows", F.col("is_public").cast("bigint").alias("is_public"))


LATE = SRC + """, flagged as (select *, coalesce(bucket < max(bucket) over (partition by pipelet
    order by arrival, msg_id rows between unbounded preceding and 1 preceding), false) as is_late from src)
"""


@query("late_flag", LATE + "select pipelet, msg_id, arrival, bucket, cast(is_late as bigint) as is_late from flagged")
def late_flag(spark, sf_dir):
    return buckets.late_flag(rows(spark, sf_dir)).withColumn("is_late", F.col("is_late").cast("bigint"))


@query("late_rows", LATE + "select pipelet, msg_id, arrival, bucket from flagged where is_late")
def late_rows(spark, sf_dir):
    return buckets.late_rows(rows(spark, sf_dir))


@query("tumbling_bucket", SRC + "select bucket10 as bucket, count(*) as n_rows, cast(sum(cast(value as decimal(18, 2))) as double) as total from src group by 1")
def tumbling_bucket(spark, sf_dir):
    table = load(spark, sf_dir, "events").withColumn("bucket", bucket_key(F.col("ts"), 10))
    # two decimals, so that the sum does not depend on its order
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return table.groupBy("bucket").agg(F.count("*").alias("n_rows"), total.alias("total"))


@query(
    "partition_calendar",
    """with days as (select distinct strftime(ts, '%Y%m%d') as event_day from events)
    select event_day, lpad(cast(h as varchar), 2, '0') as event_hour, lpad(cast(m * 10 as varchar), 2, '0') as event_minute
    from days, range(24) as t1(h), range(6) as t2(m)""",
)
def partition_calendar(spark, sf_dir):
    return buckets.day_calendar(days(spark, sf_dir), 10)


@query(
    "partition_gaps",
    LISTED
    + f"""select strftime(d, '%Y%m%d') as event_day, strftime(d, '%H') as event_hour, '00' as event_minute
    from (select unnest(generate_series((select date_trunc('day', min(ts)) from events),
        (select date_trunc('day', max(ts)) + interval 23 hour from events), interval 1 hour)) as d)
    where strftime(d, '%Y%m%d%H') || '00' not in (select "partition" from sealed where mask = {FULL})""",
)
def partition_gaps(spark, sf_dir):
    """Hours between the first and the last day that were never published."""
    from tidelog.functions.clock import split_key_parts

    span = load(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    all_days = span.select(F.explode(buckets.day_range(F.col("a"), F.col("b"))).alias("event_day"))
    public = progress.publishable(rows(spark, sf_dir), N_PIPELETS)
    published = public.select(*(c.alias(n) for n, c in split_key_parts(F.col("partition")).items()))
    return buckets.partition_gaps(buckets.day_calendar(all_days, 60), published)


# -- positions and replays ------------------------------------------------

# the saved position of a pipelet: none, a named one, or half way
_SAVED = """, saved as (select pipelet, case when pipelet = 3 then null when pipelet = 4 then '-2'
    else cast(max(msg_id) // 2 as varchar) end as saved from src group by 1),
  starts as (select pipelet, saved, case when saved is null then -1 when saved = '-2' then -2
    else cast(saved as bigint) + 1 end as start from saved)
"""


def _starts(spark, sf_dir):
    last = pipe.offset_checkpoint(rows(spark, sf_dir))
    half = F.floor(F.col("msg_id") / 2).cast("string")
    saved = F.when(F.col("pipelet") == 3, F.lit(None)).when(F.col("pipelet") == 4, "-2").otherwise(half)
    return last.select("pipelet", saved.alias("saved")).withColumn("start", pipe.start_point(F.col("saved")))


@query(
    "resume_offset",
    SRC + _SAVED + """select pipelet, coalesce(saved, '') as saved, cast(start as bigint) as start,
      cast(start >= -2 as bigint) as is_valid from starts""",
)
def resume_offset(spark, sf_dir):
    starts = _starts(spark, sf_dir)
    valid = pipe.is_valid_start(F.col("start")).cast("bigint")
    return starts.select("pipelet", F.coalesce("saved", F.lit("")).alias("saved"), "start", valid.alias("is_valid"))


@query(
    "new_only",
    SRC + _SAVED + """select src.pipelet, msg_id from src join starts on starts.pipelet = src.pipelet
      where start <> -2 and msg_id >= start""",
)
def new_only(spark, sf_dir):
    return pipe.new_only(rows(spark, sf_dir).select("pipelet", "msg_id"), _starts(spark, sf_dir))


@query("offset_checkpoint", SRC + "select pipelet, max(msg_id) as msg_id from src group by 1")
def offset_checkpoint(spark, sf_dir):
    return pipe.offset_checkpoint(rows(spark, sf_dir))


@query("dedupe_replay", SRC + "select pipelet, msg_id, arrival, bucket from src")
def dedupe_replay(spark, sf_dir):
    """One message in ten came again, later; the first copy stays."""
    first = rows(spark, sf_dir)
    again = first.filter(F.col("msg_id") % 10 == 0).withColumn("arrival", F.col("arrival") + 1000)
    return merge.dedupe_replay(first.unionByName(again), order=["arrival"])


# -- the bucket inventory ------------------------------------------------


@query("done_filter", LISTED + f"select pipelet, bucket from listed where {STATE_SQL} = 'pending'")
def done_filter(spark, sf_dir):
    return buckets.done_filter(inventory(spark, sf_dir)).select("pipelet", "bucket")


@query("not_uploaded", LISTED + f"select pipelet, bucket from listed where {STATE_SQL} = 'pending'")
def not_uploaded(spark, sf_dir):
    """Candidates less the done marks, which are entries of their own."""
    from tidelog.sources.tables import not_uploaded as pending

    files = inventory(spark, sf_dir)
    candidates = files.withColumn("state", F.lit("pending"))
    marks = files.filter("state = 'done'")
    return pending(candidates.unionByName(marks)).select("pipelet", "bucket")


@query("minus_done", LISTED + f"select pipelet, bucket from listed where {STATE_SQL} = 'pending'")
def minus_done(spark, sf_dir):
    files = inventory(spark, sf_dir)
    return buckets.minus_done(files.select("pipelet", "bucket"), files.filter("state = 'done'"))


_NAMES = """, names as (select pipelet, bucket, 'example_' || pipelet || '_' || case when pipelet = 5
    then substr(bucket, 1, 6) else bucket end || case when pipelet = 6 then '.done' when pipelet = 7 then '.tmp'
    else '' end as name from listed)
"""


@query(
    "name_filter",
    LISTED + _NAMES + """select name, pipelet, bucket, case when name like '%.done' then 'done' else 'pending' end as state
    from names where pipelet not in (5, 7)""",
)
def name_filter(spark, sf_dir):
    """Names with a 12-digit bucket; other names in the folder do not count."""
    from tidelog.sources.tables import parse_bucket_files

    p = F.col("pipelet")
    key = F.when(p == 5, F.substring("bucket", 1, 6)).otherwise(F.col("bucket"))
    suffix = F.when(p == 6, ".done").when(p == 7, ".tmp").otherwise("")
    names = _listed(spark, sf_dir).select(F.concat(F.lit("example_"), p.cast("string"), F.lit("_"), key, suffix).alias("name"))
    return parse_bucket_files(names, "example", F.col("name")).select("name", "pipelet", "bucket", "state")


@query(
    "partition_exists",
    LISTED
    + f"""select strftime(cast(d as timestamp), '%Y%m%d') as event_day, lpad(cast(h as varchar), 2, '0') as event_hour,
      '00' as event_minute
    from (select distinct cast(ts as date) as d from events), range(24) as t(h)
    where strftime(cast(d as timestamp), '%Y%m%d') || lpad(cast(h as varchar), 2, '0') || '00'
      in (select "partition" from masks where mask = {FULL})""",
)
def partition_exists(spark, sf_dir):
    from tidelog.functions.clock import split_key_parts
    from tidelog.sources.tables import partition_exists as exists

    requested = buckets.day_calendar(days(spark, sf_dir), 60)
    complete = progress.complete_partitions(progress.deliveries(rows(spark, sf_dir)), N_PIPELETS)
    published = complete.select(*(c.alias(n) for n, c in split_key_parts(F.col("partition")).items()))
    return exists(requested, published)


# -- more pipelets than a mask has bits -------------------------------------

MANY = 200
_MANY = """with src as (select event_id as msg_id, event_id % 200 as pipelet, strftime(ts, '%Y%m%d') || '0000' as bucket from events),
  listed as (select distinct pipelet, bucket from src),
  opened as (select *, max(bucket) over (partition by pipelet) as newest from listed),
  delivered as (select bucket as "partition", list_sort(list(pipelet)) as p from listed group by 1)
"""


def _many_rows(spark, sf_dir):
    """Days as buckets, 200 pipelets."""
    day = F.concat(F.substring(bucket_key(F.col("ts"), 60), 1, 8), F.lit("0000"))
    e = F.col("event_id")
    return load(spark, sf_dir, "events").select((e % MANY).alias("pipelet"), e.alias("msg_id"), day.alias("bucket"))


def _joined(c):
    return F.array_join(F.col(c).cast("array<string>"), ",").alias(c)


@query("deliveries_many", _MANY + """select "partition", array_to_string(p, ',') as pipelets from delivered""")
def deliveries_many(spark, sf_dir):
    return progress.deliveries(_many_rows(spark, sf_dir)).select("partition", _joined("pipelets"))


@query(
    "missing_pipelets_many",
    _MANY + """select "partition", array_to_string(list_filter(range(200), lambda i: not list_contains(p, i)), ',') as missing
      from delivered""",
)
def missing_pipelets_many(spark, sf_dir):
    missing = progress.missing_pipelets(progress.deliveries(_many_rows(spark, sf_dir)), MANY)
    return missing.select("partition", _joined("missing"))


@query("unexpected_pipelets", _MANY + 'select bucket as "partition", pipelet from listed where pipelet >= 150')
def unexpected_pipelets(spark, sf_dir):
    """150 pipelets were declared, 200 deliver."""
    return progress.unexpected_pipelets(progress.deliveries(_many_rows(spark, sf_dir)), 150)


@query(
    "upsert_status_many",
    _MANY + """select "partition", array_to_string(p, ',') as pipelets from delivered""",
)
def upsert_status_many(spark, sf_dir):
    all_rows = _many_rows(spark, sf_dir)
    status = progress.deliveries(all_rows.filter("pipelet < 120"))
    again = all_rows.filter("pipelet >= 60").select(F.col("bucket").alias("partition"), "pipelet")
    return progress.upsert_status(status, again).select("partition", _joined("pipelets"))


@query(
    "publishable_many",
    _MANY + """select bucket as "partition" from opened where bucket < newest group by 1 having count(*) = 200""",
)
def publishable_many(spark, sf_dir):
    return progress.publishable(_many_rows(spark, sf_dir), MANY).select("partition")


@query(
    "new_only_many",
    _MANY + """select pipelet, msg_id from src join (select pipelet, max(msg_id) // 2 as saved from src group by 1) s
      using (pipelet) where msg_id > saved""",
)
def new_only_many(spark, sf_dir):
    """Every one of 200 pipelets goes on from the middle."""
    messages = _many_rows(spark, sf_dir).select("pipelet", "msg_id")
    half = F.floor(F.col("msg_id") / 2).cast("string")
    starts = pipe.offset_checkpoint(messages).select("pipelet", pipe.start_point(half).alias("start"))
    return pipe.new_only(messages, starts)


# -- strays, idle pipelets, corrections --------------------------------------

IDLE_AFTER = 3 * 1440
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
# pipelet 3 falls silent after the tenth day; two pipelets were never declared
_IDLE = SRC + f""", seen as (
    select case when msg_id % 50 = 49 then null when msg_id % 50 = 48 then 99 else pipelet end as pipelet, day_bucket as bucket
    from src where pipelet <> 3 or day_bucket <= (select strftime(min(ts) + interval 10 day, '%Y%m%d') || '0000' from src)),
  listed as (select distinct pipelet, bucket from seen where pipelet between 0 and {N_PIPELETS - 1}),
  newest as (select p as pipelet, coalesce((select max(bucket) from listed l where l.pipelet = p), (select min(bucket) from listed)) as newest
    from range({N_PIPELETS}) as r(p)),
  state as (select pipelet, newest, date_diff('minute', strptime(newest, '%Y%m%d%H%M'),
    strptime((select max(bucket) from listed), '%Y%m%d%H%M')) > {IDLE_AFTER} as idle from newest),
  public as (select b.bucket as "partition" from (select distinct bucket from listed) b cross join state s
    left join listed l on l.bucket = b.bucket and l.pipelet = s.pipelet
    group by 1 having bool_and(s.idle or (l.pipelet is not null and b.bucket < s.newest)))
"""


def _with_strays(spark, sf_dir):
    """``pipelet, bucket, msg_id`` by day."""
    e = F.col("msg_id")
    day = day_rows(spark, sf_dir).select("pipelet", "bucket", "msg_id")
    first = load(spark, sf_dir, "events").agg(F.date_format(F.min("ts") + F.expr("INTERVAL 10 DAY"), "yyyyMMdd").alias("d")).first()["d"]
    own = day.filter((F.col("pipelet") != 3) | (F.col("bucket") <= f"{first}0000"))
    pipelet = F.when(e % 50 == 49, F.lit(None)).when(e % 50 == 48, 99).otherwise(F.col("pipelet"))
    return own.select(pipelet.cast("bigint").alias("pipelet"), "bucket", "msg_id")


@query("publishable_idle", _IDLE + 'select "partition" from public')
def publishable_idle(spark, sf_dir):
    """Undeclared pipelets, rows without one, and one that falls silent: nobody waits for them."""
    return progress.publishable(_with_strays(spark, sf_dir), N_PIPELETS, IDLE_AFTER).select("partition")


@query("seal_bucket_stream", _IDLE + 'select "partition" from public')
def seal_bucket_stream(spark, sf_dir):
    """The same from a stream, with the progress of every pipelet in Spark's state store."""
    rows = _with_strays(spark, sf_dir)
    days_seen = rows.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).first()
    place = F.floor((clock.key_minutes(F.col("bucket")) - clock.key_minutes(F.lit(days_seen["a"]))) / (7 * 1440))
    held, path, out = (scratch_path(spark, n) for n in ("held", "pipe", "sealed"))
    rows.withColumn("week", F.least(place, F.lit(4))).write.partitionBy("week").parquet(held)
    held_rows = spark.read.schema(T.StructType([*rows.schema, T.StructField("week", T.LongType())])).parquet(held)
    # five weeks, one micro-batch each, in the order of time; timers have a batch of their own behind the last
    idle_batches = spark.conf.get(NO_DATA)
    for week in range(5):
        held_rows.filter(F.col("week") == week).drop("week").write.mode("append").parquet(path)
        sealed = shards.sealed_stream(spark.readStream.schema(rows.schema).parquet(path), N_PIPELETS, IDLE_AFTER)
        try:
            spark.conf.set(NO_DATA, idle_batches if week == 4 else "false")
            sink = sealed.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-position")
            running = sink.trigger(availableNow=True).start()
        finally:
            spark.conf.set(NO_DATA, idle_batches)
        running.awaitTermination()
    return shards.publishable_after(spark.read.schema(shards.SEALED).parquet(out), N_PIPELETS).select("partition")


@query(
    "late_corrections",
    LATE
    + """, live as (select * from flagged where not (is_late and msg_id % 2 = 0) and msg_id % 41 <> 0),
      moved as (select day_bucket, case when msg_id % 43 = 0 then -msg_id else msg_id end as msg_id from live)
    select day_bucket as bucket, count(*) as n_rows, cast(sum(msg_id) as bigint) as ids from moved group by 1""",
)
def late_corrections(spark, sf_dir):
    """Published days after a log of late rows, retractions and changed rows.

    Of the late rows half are added, and later retracted, row by row; the rest stay.
    """
    hours = buckets.late_flag(rows(spark, sf_dir))
    day = F.concat(F.substring("bucket", 1, 8), F.lit("0000"))
    flagged = hours.withColumn("bucket", day).withColumn("ids", F.col("msg_id"))
    flagged = flagged.select("*", *(c.alias(n) for n, c in clock.split_key_parts(F.col("bucket")).items()))
    schema = flagged.drop("is_late").schema
    table = VersionedTable(spark, scratch_path(spark, "public"), schema)
    table.commit(flagged.filter("not is_late").drop("is_late"))
    late = flagged.filter("is_late").drop("is_late")
    even = late.filter("msg_id % 2 = 0")
    log = corrections.additions(late, 1).unionByName(corrections.retractions(even, 2))
    corrections.merge_changes(table, log, ("pipelet", "msg_id"))
    now = table.read()
    wrong = now.filter("msg_id % 41 = 0")
    changed = now.filter("msg_id % 43 = 0 and msg_id % 41 <> 0").withColumn("ids", -F.col("msg_id"))
    log = corrections.retractions(wrong, 3).unionByName(corrections.additions(changed, 3))
    corrections.merge_changes(table, log, ("pipelet", "msg_id"))
    return table.read().groupBy("bucket").agg(F.count("*").alias("n_rows"), F.sum("ids").alias("ids"))


# -- sets of ids ----------------------------------------------------------------

# a third of all messages in one pipelet, and holes in some; ids within a pipelet
_IDS = """with ids as (
    select case when event_id % 3 = 0 then 0 else 1 + event_id % 5 end as pipelet,
      case when event_id % 3 = 0 then event_id // 3 else event_id // 15 end as msg_id from events),
  held as (select distinct pipelet, msg_id from ids where not (pipelet % 2 = 0 and msg_id % 500 between 100 and 104)),
  numbered as (select *, msg_id - row_number() over (partition by pipelet order by msg_id) as island from held),
  runs as (select pipelet, min(msg_id) as lo, max(msg_id) as hi from numbered group by pipelet, island)
"""


def _ids(spark, sf_dir):
    e = F.col("event_id")
    hot = e % 3 == 0
    ids = load(spark, sf_dir, "events").select(
        F.when(hot, 0).otherwise(1 + e % 5).cast("bigint").alias("pipelet"),
        F.floor(e / F.when(hot, 3).otherwise(15)).cast("bigint").alias("msg_id"),
    )
    return ids.filter(~((F.col("pipelet") % 2 == 0) & (F.col("msg_id") % 500).between(100, 104)))


@query("offset_intervals", _IDS + "select pipelet, lo, hi from runs")
def offset_intervals(spark, sf_dir):
    """Which ids are there, as intervals."""
    return id_sets.intervals(_ids(spark, sf_dir))


@query(
    "offset_gaps",
    _IDS + """select pipelet, hi + 1 as lo, following - 1 as hi from
      (select *, lead(lo) over (partition by pipelet order by lo) as following from runs) where following is not null""",
)
def offset_gaps(spark, sf_dir):
    return id_sets.gaps(id_sets.intervals(_ids(spark, sf_dir)))


@query("offset_low_water", _IDS + "select pipelet, min_by(hi, lo) as msg_id from runs group by 1")
def offset_low_water(spark, sf_dir):
    """Up to where nothing is missing."""
    return id_sets.low_water(id_sets.intervals(_ids(spark, sf_dir)))


@query(
    "dedupe_intervals",
    """select event_id % 16 as pipelet, event_id // 16 as msg_id, min(event_id // 3000) as part from events group by 1, 2""",
)
def dedupe_intervals(spark, sf_dir):
    """A pipe in parts of 3,000 messages, each part with a tenth of the one before: every message stays once.

    What has been seen is kept as intervals of ids, written after each round.  A round takes
    eight parts, of a long pipe as many more as keep the number of rounds within ``ROUNDS``.
    """
    e = F.col("event_id")
    table = load(spark, sf_dir, "events")
    named = ((e % 16).alias("pipelet"), F.floor(e / 16).alias("msg_id"), F.floor(e / 3000).alias("part"))
    schema = table.select(*named).schema

    def parts(first, last):
        # by id, so that files and row groups of other parts are passed over
        return table.filter(e.between(first * 3000, last * 3000 + 2999)).select(*named)

    ends = table.agg(F.floor(F.max(e) / 3000)).first()[0]
    upto = (ends or 0) + 2
    at_once = max(PARTS_AT_ONCE, -(-upto // ROUNDS))
    out, state = scratch_path(spark, "kept"), id_sets.nothing_seen(spark)
    for part in range(0, upto, at_once):
        again = parts(part - at_once, part + at_once - 2).filter(F.col("msg_id") % 10 == 0)
        batch = parts(part, part + at_once - 1).unionByName(again)
        new = merge.first_per_key(id_sets.unseen(batch, state), ("pipelet", "msg_id"), F.col("part"))
        new.write.mode("append").parquet(out)
        path = scratch_path(spark, "seen")
        id_sets.absorb(state, batch).write.parquet(path)
        state = spark.read.schema(id_sets.SEEN).parquet(path)
    return spark.read.schema(schema).parquet(out)


# -- freshness --------------------------------------------------------------------

_DELAY = "(msg_id * 7919 % 9973) * 3 + case when msg_id % 7 = 0 then 60000 else 0 end"
_SHARES = (0.5, 0.9, 0.99)


@query(
    "freshness",
    SRC
    + f"""select coalesce(day_bucket, 'all') as bucket, cast(count(*) as bigint) as n, cast(q as double) as share, cast(1 as bigint) as within
    from src, (select unnest([{", ".join(map(str, _SHARES))}]) as q) group by grouping sets ((day_bucket, q), (q))""",
)
def freshness(spark, sf_dir):
    """Quantiles of delays from stored sketches, by day and for all days, and whether they keep their bound.

    ``within`` holds if the exact share of rows up to the quantile, or below it, is not
    further from the asked one than the sketch's error.
    """
    rows = day_rows(spark, sf_dir).select("bucket", F.expr(_DELAY).cast("bigint").alias("delay"))
    path = scratch_path(spark, "sketches")
    sketches.freshness(rows, F.col("delay"), ["bucket"]).write.parquet(path)
    stored = spark.read.parquet(path)
    both = stored.unionByName(sketches.merged_freshness(stored).withColumn("bucket", F.lit("all")))
    found = sketches.freshness_quantiles(both, _SHARES).withColumnRenamed("delay", "quantile")
    every = rows.unionByName(rows.withColumn("bucket", F.lit("all")))
    named = found.select(F.col("bucket").alias("q_bucket"), "share", "n", "quantile")
    met = every.join(named, F.col("bucket") == F.col("q_bucket"))
    counted = met.groupBy("bucket", "share", "n").agg(
        F.count_if(F.col("delay") < F.col("quantile")).alias("below"), F.count_if(F.col("delay") <= F.col("quantile")).alias("upto")
    )
    # a rank is a whole number of rows
    off = sketches.rank_error(200) * F.col("n") + 1
    within = (F.col("below") - off <= F.col("share") * F.col("n")) & (F.col("share") * F.col("n") <= F.col("upto") + off)
    return counted.select("bucket", "n", "share", within.cast("bigint").alias("within"))


PARTS_AT_ONCE = 8
ROUNDS = 16


__all__ = ["FULL", "LISTED", "day_rows"]
