"""Parsing and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.functions import clock, hooks, text
from tidelog.operators import parse
from tidelog.plans.example import example_application
from tidelog.plans.sample_log import load, messages
from workload import query
from workload.inputs import PLACE_SQL, REASON, SRC, if_good, parsed, place_text, reason, unless_no_header


@query(
    "parse_header",
    SRC
    + """select msg_id, cast(not no_header as bigint) as matched,
      case when no_header then '' when bad_time then '02-30' else strftime(ts, '%m-%d') end as date,
      case when no_header then '' else strftime(ts, '%H:%M:%S') end as time,
      case when no_header then '' else 'sale=' || lpad(cast(msg_id as varchar), 10, '0') end as first_token,
      case when no_header then '' else 'note=' end as last_token
    from src""",
)
def parse_header(spark, sf_dir):
    lines = parse.parse_header(messages(spark, sf_dir))
    return lines.select(
        "msg_id",
        F.col("matched").cast("bigint").alias("matched"),
        "date",
        "time",
        F.substring_index("payload", " ", 1).alias("first_token"),
        F.substring_index("payload", " ", -1).alias("last_token"),
    )


_FIELDS = {
    "buyer": "cast(user_id as varchar)",
    "code": "cast(msg_id % 5 as varchar)",
    "eq": "'1'",
    "flag": "''",
    "pct": "'%zz%4'",
    "props": "props",
    "val": "cast(value as varchar)",
}


@query(
    "parse_fields",
    SRC
    + f"select msg_id, {', '.join(f'{unless_no_header(sql)} as {n}' for n, sql in _FIELDS.items())}, "
    + f"cast({unless_no_header('28', '2')} as bigint) as n_fields from src",
)
def parse_fields(spark, sf_dir):
    lines = parse.parse_fields(parse.parse_header(messages(spark, sf_dir)))
    f = F.col("fields")
    return lines.select(
        "msg_id",
        *(F.coalesce(f["value" if n == "val" else n], F.lit("")).alias(n) for n in _FIELDS),
        F.size(f).cast("bigint").alias("n_fields"),
    )


@query(
    "dup_key_last_wins",
    SRC
    + f"""select msg_id, {unless_no_header("case when msg_id % 11 = 0 then 'last' else 'once' end")} as dup,
      cast({unless_no_header("5", "0")} as bigint) as position from src""",
)
def dup_key_last_wins(spark, sf_dir):
    lines = parse.cut_notice(messages(spark, sf_dir))
    return lines.select(
        "msg_id",
        F.coalesce(F.col("fields")["dup"], F.lit("")).alias("dup"),
        F.array_position(F.map_keys("fields"), "dup").cast("bigint").alias("position"),
    )


@query("percent_decode", "select doc_id, text as decoded, md5(text) as digest from documents")
def percent_decode(spark, sf_dir):
    """Whole texts, encoded and decoded again."""
    encoded = load(spark, sf_dir, "documents").select("doc_id", F.url_encode("text").alias("encoded"))
    decoded = encoded.select("doc_id", text.percent_decode(F.col("encoded")).alias("decoded"))
    return decoded.withColumn("digest", F.md5("decoded"))


@query(
    "quarantine_unparsed",
    SRC
    + """select reason, count(*) as n_lines, min(msg_id) as first_id, max(msg_id) as last_id
    from (select msg_id, case when no_header then 'no_header' else 'bad_time' end as reason from src where not good)
    group by reason""",
)
def quarantine_unparsed(spark, sf_dir):
    lines = parse.quarantined(example_application().parsed(messages(spark, sf_dir)))
    return lines.groupBy("reason").agg(
        F.count("*").alias("n_lines"), F.min("msg_id").alias("first_id"), F.max("msg_id").alias("last_id")
    )


def _hook(spark, sf_dir, hook, ins, outs):
    """Outputs of one hook over the decoded fields of every line."""
    lines = parsed(spark, sf_dir)
    picked = lines.select(
        "msg_id",
        reason(),
        "event_ts",
        *(F.expr(f"coalesce({parse.decoded(f"fields['{n}']")}, '')").alias(n) for n in ins),
    )
    with text.java_charsets(spark):
        values = hook({n: F.col(n) for n in ins}, outs)
        return picked.select("msg_id", "reason", *(values[n].alias(n) for n in outs))


_UID = unless_no_header("cast(user_id as varchar)")


@query("copy", SRC + f"select msg_id, {REASON}, {_UID} as a, {_UID} as b from src")
def copy(spark, sf_dir):
    """Two inputs, two outputs: the last input fills both."""
    return _hook(spark, sf_dir, hooks.copy, ("sale", "buyer"), ("a", "b"))


@query(
    "copy_decode",
    SRC + f"""select msg_id, {REASON}, {unless_no_header("'Agent/1.0 (' || event_type || ')'")} as device from src""",
)
def copy_decode(spark, sf_dir):
    return _hook(spark, sf_dir, hooks.copy_decode, ("device",), ("device",))


_NAME_SQL = unless_no_header("case msg_id % 3 when 0 then '北京' when 1 then '上海' else '广州' end")


@query("copy_decode_utf8", SRC + f"select msg_id, {REASON}, {_NAME_SQL} as guest from src")
def copy_decode_utf8(spark, sf_dir):
    return _hook(spark, sf_dir, hooks.copy_decode_utf8, ("guest",), ("guest",))


@query(
    "transcode",
    SRC + f"select msg_id, {REASON}, {_NAME_SQL} as name, cast({unless_no_header('2', '0')} as bigint) as n_chars from src",
)
def transcode(spark, sf_dir):
    """Bytes to text; the bytes alone are no valid UTF-8."""
    raw = F.expr(f"coalesce({parse.decoded("fields['guest']")}, '')").alias("raw")
    name = parsed(spark, sf_dir).select("msg_id", reason(), raw)
    with text.java_charsets(spark):
        named = name.select("msg_id", "reason", text.transcode(F.col("raw")).alias("name"))
    return named.withColumn("n_chars", F.char_length("name").cast("bigint"))


_TIMES = {
    "year": if_good("strftime(ts, '%Y')"),
    "month": unless_no_header("case when bad_time then '02' else strftime(ts, '%m') end"),
    "time": unless_no_header("strftime(ts, '%H:%M:%S')"),
    "timestamp": if_good("cast(cast(floor(epoch(ts)) as bigint) as varchar)"),
    "day": unless_no_header("case when bad_time then '30' else strftime(ts, '%d') end"),
}


@query("date_time", SRC + f"select msg_id, {REASON}, {', '.join(f'{sql} as {n}' for n, sql in _TIMES.items())} from src")
def date_time(spark, sf_dir):
    times = _hook(spark, sf_dir, hooks.date_time(F.col("event_ts")), ("date", "time"), tuple(_TIMES))
    return times.select("msg_id", "reason", *(F.coalesce(n, F.lit("")).alias(n) for n in _TIMES))


@query(
    "ip_geo",
    SRC
    + f"""select msg_id, '10.' || (user_id % 25) || '.' || (msg_id % 256) || '.' || (user_id % 250) as ip,
      {PLACE_SQL} from src join nation on n_nationkey = user_id % 25""",
)
def ip_geo(spark, sf_dir):
    """Parse the lookup text of the nation an event is assigned to."""
    from workload.inputs import client_ip

    nation = load(spark, sf_dir, "nation").withColumn("place", place_text())
    joined = load(spark, sf_dir, "events").join(nation, F.col("user_id") % 25 == F.col("n_nationkey"))
    values = hooks.ip_geo(F.col("place"))({"client_ip": client_ip()}, ())
    return joined.select(F.col("event_id").alias("msg_id"), *(c.alias(n) for n, c in values.items()))


@query(
    "visitor_id_clean",
    SRC + f"select msg_id, {REASON}, {unless_no_header('md5(cast(msg_id as varchar))')} as holder from src",
)
def visitor_id_clean(spark, sf_dir):
    return _hook(spark, sf_dir, hooks.clean_visitor_id, ("pass",), ("holder",))


@query(
    "kv_string_to_map",
    SRC
    + f"""select msg_id, {REASON}, {unless_no_header("cast(msg_id % 100 as varchar)")} as "left",
      {_UID} as "right", cast({unless_no_header("2", "0")} as bigint) as n_keys from src""",
)
def kv_string_to_map(spark, sf_dir):
    blocks = _hook(spark, sf_dir, hooks.copy_kv_map, ("block",), ("block",))
    return blocks.select(
        "msg_id",
        "reason",
        *(F.coalesce(F.col("block")[n], F.lit("")).alias(n) for n in ("left", "right")),
        F.size("block").cast("bigint").alias("n_keys"),
    )


@query(
    "map_to_string",
    SRC + f"""select msg_id, {REASON}, {unless_no_header("'cents:' || (msg_id % 50) || ',fee:2'")} as price from src""",
)
def map_to_string(spark, sf_dir):
    prices = _hook(spark, sf_dir, hooks.copy_kv_map, ("Price",), ("price",))
    return prices.select("msg_id", "reason", text.map_to_string(F.col("price")).alias("price"))


_PARAMS_SQL = """case when contains(url, '?') then array_to_string(list_transform(
  string_split(split_part(url, '?', 2), '&'), lambda x: split_part(x, '=', 1) || ':' || split_part(x, '=', 2)), ',')
  else '' end"""


@query(
    "url_split",
    f"""select page_id, 'h' || url as url, 'h' as hostname, split_part(url, '?', 1) as path,
      {_PARAMS_SQL} as params,
      case when contains(url, 'page=') then split_part(split_part(split_part(url, 'page=', 2), '&', 1), '=', 1)
        else '' end as query
    from pages""",
)
def url_split(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    values = hooks.url_split(query_param="page")({"host": F.col("h"), "url": F.col("url")}, ())
    split = pages.withColumn("h", F.lit("h")).select("page_id", *(c.alias(n) for n, c in values.items()))
    params = text.map_to_string("params").alias("params")
    return split.select("page_id", "url", "hostname", "path", params, "query")


def _with_referer(sql: str) -> str:
    return unless_no_header(f"case when msg_id % 4 = 0 then '' else {sql} end")


@query(
    "referer_split",
    SRC
    + f"""select msg_id, {REASON},
      {_with_referer("'http://example.com/q/' || msg_id || '.html?a=' || user_id")} as referer,
      {_with_referer("'/q/' || msg_id || '.html'")} as path,
      {_with_referer("'a:' || user_id")} as params,
      {_with_referer("'example.com'")} as hostname
    from src""",
)
def referer_split(spark, sf_dir):
    outs = ("referer", "path", "params", "hostname")
    parts = _hook(spark, sf_dir, hooks.referer_split(referer="via"), ("via",), outs)
    params = text.map_to_string(F.col("params")).alias("params")
    return parts.select("msg_id", "reason", "referer", "path", params, "hostname")


@query(
    "sanitize",
    """select doc_id, replace(replace(text, chr(1), ''), chr(10), chr(3)) as clean from documents""",
)
def sanitize(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", text.sanitize(F.col("text")).alias("clean"))


@query(
    "floor_minute",
    """select event_id, lpad(cast(minute(ts) // 7 * 7 as varchar), 2, '0') as by_7,
      lpad(cast(minute(ts) // 10 * 10 as varchar), 2, '0') as by_10,
      lpad(cast(minute(ts) // 60 * 60 as varchar), 2, '0') as by_60
    from events""",
)
def floor_minute(spark, sf_dir):
    minute = F.minute("ts")
    widths = (clock.floor_minute(minute, w).alias(f"by_{w}") for w in (7, 10, 60))
    return load(spark, sf_dir, "events").select("event_id", *widths)


@query(
    "split_key_parts",
    SRC
    + """select distinct bucket10 as bucket, strftime(ts, '%Y%m%d') as event_day, strftime(ts, '%H') as event_hour,
      lpad(cast(minute(ts) // 10 * 10 as varchar), 2, '0') as event_minute from src""",
)
def split_key_parts(spark, sf_dir):
    keys = load(spark, sf_dir, "events").select(clock.bucket_key(F.col("ts"), 10).alias("bucket")).distinct()
    return keys.select("bucket", *(c.alias(n) for n, c in clock.split_key_parts(F.col("bucket")).items()))
