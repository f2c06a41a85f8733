"""The rule language, user code, and the typed event row."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import text
from tidelog.functions.hooks import HookResult, date_time, from_udf, url_split
from tidelog.operators.enrich import ip_range_join
from tidelog.operators.mapping import MapRule, apply_rules, conform
from tidelog.operators.parse import decoded
from tidelog.plans.example import (
    COMMON_FIELDS,
    EVENT_COLUMNS,
    example_application,
    rules_from_text,
    schema_from_text,
)
from tidelog.plans.sample_log import load, messages
from workload import query
from workload.inputs import PLACE_SQL, REASON, SRC, events, if_good, ip_events, ip_ranges, parsed, reason, unless_no_header

_URL = unless_no_header("""'/' || event_type || case when msg_id % 3 = 0 then ''
  else '?word=term ' || user_id || '&pn=' || (msg_id % 10) end""")
_FULL_URL = unless_no_header(f"'example.com' || {_URL}")
_PARAMS = unless_no_header("case when msg_id % 3 = 0 then '' else 'word:term ' || user_id || ',pn:' || (msg_id % 10) end")
_QUERY = unless_no_header("case when msg_id % 3 = 0 then '' else 'term ' || user_id end")
_AGENT = unless_no_header("'Agent/1.0 (' || event_type || ')'")
_TIME = unless_no_header("strftime(ts, '%H:%M:%S')")
_MONTH = unless_no_header("case when bad_time then '02' else strftime(ts, '%m') end")
_DAY = unless_no_header("case when bad_time then '30' else strftime(ts, '%d') end")


def _map(spark, sf_dir, rules):
    """Rules over every line; position, reason and all outputs as text."""
    lines = parsed(spark, sf_dir).withColumn("reason", reason())
    keep = ("msg_id", "reason")
    mapped = apply_rules(lines, rules, {"date_time": date_time(F.col("event_ts"))}, keep, decode=decoded)
    outs = [n for rule in rules for n in rule.columns]
    return conform(mapped, T.StructType([T.StructField(n, T.StringType()) for n in outs]), keep)


@query(
    "map_rules",
    SRC
    + f"""select msg_id, {REASON}, {unless_no_header("lpad(cast(msg_id as varchar), 10, '0')")} as sale,
      {_TIME} as at_time, {_FULL_URL} as page, {_AGENT} as device from src""",
)
def map_rules(spark, sf_dir):
    rules = [
        MapRule(("sale",), ("sale",)),
        MapRule(("date", "time"), ("at_time=time",), "date_time"),
        MapRule(("site", "page"), ("page",), url_split(host="site", url="page")),
        MapRule(("device",), ("device",), "copy_decode"),
    ]
    return _map(spark, sf_dir, rules).select("msg_id", "reason", "sale", "at_time", "page", "device")


@query(
    "rule_consume",
    SRC
    + f"""select msg_id, {REASON}, {unless_no_header("cast(user_id as varchar)")} as first_buyer, '' as second_buyer,
      {unless_no_header("case when msg_id % 5 = 0 then '0' else '' end")} as no_error,
      {unless_no_header("case when msg_id % 5 = 0 then '' else cast(msg_id % 5 as varchar) end")} as error
    from src""",
)
def rule_consume(spark, sf_dir):
    """A later rule finds nothing where an earlier one applied."""

    def when_zero(ins, outs):
        return HookResult({outs[0]: ins["code"]}, ins["code"] == "0")

    rules = [
        MapRule(("buyer",), ("first_buyer",)),
        MapRule(("buyer",), ("second_buyer",)),
        MapRule(("code",), ("no_error",), when_zero),
        MapRule(("code",), ("error",)),
    ]
    return _map(spark, sf_dir, rules).drop("event_loginfo")


@query(
    "rule_multi_out",
    SRC
    + f"""select msg_id, {REASON}, {if_good("strftime(ts, '%Y')")} as year, {_MONTH} as month,
      {_DAY} as day_of_month, {unless_no_header("'example.com'")} as site,
      {unless_no_header("'/' || event_type")} as path, {_PARAMS} as params, {_QUERY} as search, {_FULL_URL} as whole
    from src""",
)
def rule_multi_out(spark, sf_dir):
    """Rules with names of their own: parts by place, or by name."""
    rules = [
        MapRule(("date", "time"), ("year", "month", "day_of_month=day"), "date_time"),
        MapRule(
            ("site", "page"),
            ("whole", "site", "path", "params", "search"),
            url_split(host="site", url="page"),
        ),
    ]
    return _map(spark, sf_dir, rules).select("msg_id", "reason", *(n for rule in rules for n in rule.columns))


_LEFT = unless_no_header("""'kiosk:7,dup:' || case when msg_id % 11 = 0 then 'last' else 'once' end
  || ',mail:u' || user_id || '@example.com,price:40,value:'
  || cast(value as varchar) || ',props:' || props || ',eq:1,pct:%zz%4,flag:,note:'""")


@query("leftover_map", SRC + f"select msg_id, {REASON}, {_LEFT} as event_loginfo from src")
def leftover_map(spark, sf_dir):
    """Unclaimed fields in the order of the line; ``price`` is not ``Price``."""
    mapped = events(spark, sf_dir)
    return mapped.select("msg_id", reason(), text.map_to_string(F.col("event_loginfo")).alias("event_loginfo"))


def _with_referer(sql: str) -> str:
    return unless_no_header(f"case when msg_id % 4 = 0 then '' else {sql} end")


# the columns of the example application that a sample line fills, as text
_FILLED = {
    "sale": unless_no_header("lpad(cast(msg_id as varchar), 10, '0')"),
    "sold_year": if_good("strftime(ts, '%Y')"),
    "sold_month": _MONTH,
    "sold_day": _DAY,
    "sold_time": _TIME,
    "sold_at": if_good("cast(cast(floor(epoch(ts)) as bigint) as varchar)"),
    "address": unless_no_header("'10.' || (user_id % 25) || '.' || (msg_id % 256) || '.' || (user_id % 250)"),
    "holder": unless_no_header("md5(cast(msg_id as varchar))"),
    "buyer": unless_no_header("cast(user_id as varchar)"),
    "guest": unless_no_header("case msg_id % 3 when 0 then '北京' when 1 then '上海' else '广州' end"),
    "page": _FULL_URL,
    "site": unless_no_header("'example.com'"),
    "page_path": unless_no_header("'/' || event_type"),
    "page_params": _PARAMS,
    "search": _QUERY,
    "via": _with_referer("'http://example.com/q/' || msg_id || '.html?a=' || user_id"),
    "via_path": _with_referer("'/q/' || msg_id || '.html'"),
    "via_params": _with_referer("'a:' || user_id"),
    "via_site": _with_referer("'example.com'"),
    "device": _AGENT,
    "code": unless_no_header("cast(msg_id % 5 as varchar)"),
    "took": unless_no_header("(msg_id + 1000000000) || '.895'"),
    "block": unless_no_header("'left:' || (msg_id % 100) || ',right:' || user_id"),
    "event_loginfo": _LEFT,
    "shop_price": unless_no_header("'cents:' || (msg_id % 50) || ',fee:2'"),
    "shop_memo": unless_no_header("'act=' || chr(39) || event_type || chr(39) || ' part=' || chr(39) || '3' || chr(39)"),
    "shop_gate": unless_no_header("case when msg_id % 2 = 0 then event_type else '' end"),
    "shop_desk": unless_no_header("'10.9.9.9'"),
}
# the same where the table's types differ from text
_TYPED = _FILLED | {
    "sold_month": "cast(month(ts) as varchar)",
    "sold_day": "cast(day(ts) as varchar)",
    "took": unless_no_header("cast(msg_id + 1000000000 as varchar)"),
}


def event_names() -> list[str]:
    """Declared columns, then undeclared outputs in rule order."""
    outs = [n for rule in rules_from_text(COMMON_FIELDS) for n in rule.columns]
    return list(dict.fromkeys([*schema_from_text(EVENT_COLUMNS).fieldNames(), *outs]))


def row_text_sql(typed: bool) -> str:
    filled = _TYPED if typed else _FILLED
    return f"concat_ws('|', {', '.join(f'cast({filled.get(n, chr(39) * 2)} as varchar)' for n in event_names())}) as row_text"


def row_text(mapped):
    """All columns of an event in order, as one text; NULL is empty."""
    types = {f.name: f.dataType for f in mapped.schema}

    def cell(n):
        return text.map_to_string(n) if isinstance(types[n], T.MapType) else F.coalesce(F.col(n).cast("string"), F.lit(""))

    return F.concat_ws("|", *(F.coalesce(cell(n), F.lit("")) for n in event_names())).alias("row_text")


@query("event_schema", SRC + f"select msg_id, {REASON}, {row_text_sql(False)} from src")
def event_schema(spark, sf_dir):
    """All declared columns in order, then the undeclared ones, as one text."""
    app = example_application()
    mapped = app.events(parsed(spark, sf_dir), ("msg_id", "reason"), typed=False)
    return mapped.select("msg_id", reason(), row_text(mapped))


@query(
    "schema_cast",
    SRC
    + f"""select msg_id, {REASON}, cast({if_good("year(ts)", "-1")} as bigint) as sold_year,
      cast({unless_no_header("case when bad_time then 2 else month(ts) end", "-1")} as bigint) as sold_month,
      cast({if_good("floor(epoch(ts))", "-1")} as bigint) as sold_at,
      cast({unless_no_header("msg_id % 5", "-1")} as bigint) as code,
      cast({unless_no_header("msg_id + 1000000000", "-1")} as bigint) as took,
      cast({unless_no_header("user_id", "-1")} as bigint) as buyer,
      cast({unless_no_header("msg_id % 100", "-1")} as bigint) as left_block, cast(28 as bigint) as n_declared
    from src""",
)
def schema_cast(spark, sf_dir):
    """Text to the table's types; ``left_block`` through a map of bigints."""
    typed = events(spark, sf_dir)
    n_declared = len(schema_from_text(EVENT_COLUMNS))
    numbers = ("sold_year", "sold_month", "sold_at", "code", "took", "buyer")
    return typed.select(
        "msg_id",
        reason(),
        *(F.coalesce(n, F.lit(-1)).cast("bigint").alias(n) for n in numbers),
        F.coalesce(F.col("block")["left"], F.lit(-1)).cast("bigint").alias("left_block"),
        F.lit(n_declared).cast("bigint").alias("n_declared"),
    )


@query(
    "user_hook",
    SRC
    + f"""select msg_id, {REASON}, {unless_no_header("case when msg_id % 5 = 0 then '' else event_type end")} as kind,
      {unless_no_header("case when msg_id % 5 = 0 then '' else cast(length(event_type) as varchar) end")} as size
    from src""",
)
def user_hook(spark, sf_dir):
    """Opaque code as a vectorised function; it refuses lines without an error."""

    @F.pandas_udf("kind string, size string, ok boolean")
    def describe(memo: pd.Series, code: pd.Series) -> pd.DataFrame:
        kind = memo.fillna("").str.extract(r"act='([^']*)'")[0]
        return pd.DataFrame({"kind": kind, "size": kind.fillna("").str.len().astype(str), "ok": code.notna() & (code != "0")})

    rules = [MapRule(("memo", "code"), ("kind", "size"), from_udf(describe, ok="ok"))]
    return _map(spark, sf_dir, rules).select("msg_id", "reason", "kind", "size")


@query(
    "user_cut",
    """select event_id as msg_id, regexp_extract(props, '"k": (\\d+)', 1) as k, event_type as kind, '' as other
    from events""",
)
def user_cut(spark, sf_dir):
    """A parser of the user's own: a JSON column instead of log lines."""

    def cut_json(df):
        bag = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("kind"), F.col("event_type")))
        return df.select(F.col("event_id").alias("msg_id"), bag.alias("fields"))

    rules = [MapRule(("k",), ("k",)), MapRule(("kind",), ("kind",)), MapRule(("absent",), ("other",))]
    mapped = apply_rules(load(spark, sf_dir, "events").transform(cut_json), rules, keep=("msg_id",))
    return mapped.select("msg_id", "k", "kind", F.coalesce("other", F.lit("")).alias("other"))


@query(
    "ip_range_join",
    f"""with ranges as (
      select 10 * 16777216 + n_nationkey * 65536 as lo, 10 * 16777216 + n_nationkey * 65536 + 51199 as hi, {PLACE_SQL}
      from nation),
    ips as (
      select event_id as msg_id,
        10 * 16777216 + (user_id % 25) * 65536 + (event_id % 256) * 256 + (user_id % 250) as ip
      from events)
    select msg_id, coalesce(province, '') as province, coalesce(city, '') as city, coalesce(provider, '') as provider
    from ips left join ranges on ip between lo and hi""",
)
def ip_range_lookup(spark, sf_dir):
    from tidelog.functions.hooks import ip_place

    found = ip_range_join(ip_events(spark, sf_dir), ip_ranges(spark, sf_dir), F.col("client_ip"), ("ip_place",))
    parts = ip_place(F.coalesce("ip_place", F.lit("")))
    return found.select("msg_id", *(c.alias(n) for n, c in parts.items()))


def _placed(column: str) -> str:
    name = {"provider": "network"}.get(column, column)
    return unless_no_header(f"case when msg_id % 256 < 200 then {column} else '' end") + f" as {name}"


@query(
    "map_rules_with_lookup",
    SRC
    + f"""select msg_id, {REASON}, {", ".join(map(_placed, ("province", "city", "provider")))},
      {if_good("bucket10")} as bucket
    from (select src.*, {PLACE_SQL} from src join nation on n_nationkey = user_id % 25)""",
)
def map_rules_with_lookup(spark, sf_dir):
    """The whole application, from line to event, with the address lookup in it."""

    def lookup(df):
        ip = F.expr(decoded("fields['addr']"))
        return ip_range_join(df, ip_ranges(spark, sf_dir), ip, ("ip_place",))

    app = example_application(lookup=lookup)
    return app.run(messages(spark, sf_dir)).select(
        "msg_id", reason(), "province", "city", "network", F.coalesce("bucket", F.lit("")).alias("bucket")
    )


# nested ranges: all, a tenth of the networks each, and the nations' own
_NESTED = f"""ranges as (
    select 0::bigint as lo, 4294967295::bigint as hi, 'world' as place
    union all select 10 * 16777216 + k * 5 * 65536, 10 * 16777216 + (k * 5 + 6) * 65536 - 1, 'zone' || k from range(5) as t(k)
    union all select 10 * 16777216 + n_nationkey * 65536, 10 * 16777216 + n_nationkey * 65536 + 51199, 'nation' || n_nationkey from nation),
  ips as (select event_id as msg_id, 10 * 16777216 + (user_id % 25) * 65536 + (event_id % 256) * 256 + (user_id % 250) as ip from events)"""
_NARROWEST = "arg_min(place, [hi - lo, lo])"


def _nested_ranges(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    k, base = F.col("n_nationkey"), 10 << 24
    zone = nation.filter("n_nationkey < 5").select(
        (F.lit(base) + k * 5 * 65536).cast("bigint").alias("lo"), (F.lit(base) + (k * 5 + 6) * 65536 - 1).cast("bigint").alias("hi"),
        F.concat(F.lit("zone"), k.cast("string")).alias("place"),
    )
    own = nation.select(
        (F.lit(base) + k * 65536).cast("bigint").alias("lo"), (F.lit(base) + k * 65536 + 51199).cast("bigint").alias("hi"),
        F.concat(F.lit("nation"), k.cast("string")).alias("place"),
    )
    return zone.unionByName(own).unionByName(spark.sql("select 0L as lo, 4294967295L as hi, 'world' as place"))


@query(
    "ip_nested_ranges",
    f"with {_NESTED} select msg_id, {_NARROWEST} as place from ips join ranges on ip between lo and hi group by 1",
)
def ip_nested_ranges(spark, sf_dir):
    """Ranges inside of ranges: the narrowest one, once."""
    found = ip_range_join(ip_events(spark, sf_dir), _nested_ranges(spark, sf_dir), F.col("client_ip"), ("place",))
    return found.select("msg_id", "place")


@query(
    "ip_long_addresses",
    f"with {_NESTED} select msg_id, {_NARROWEST} as place from ips join ranges on ip between lo and hi group by 1",
)
def ip_long_addresses(spark, sf_dir):
    """The same with addresses of 128 bits, below a prefix of their own."""
    from tidelog.operators.enrich import ip_text_join

    def long(c):
        high, low = F.hex(F.floor(c / 65536)), F.hex(F.pmod(c, F.lit(65536)))
        return F.lower(F.concat(F.lit("2001:db8::"), high, F.lit(":"), low))

    ranges = _nested_ranges(spark, sf_dir).select(long(F.col("lo")).alias("lo"), long(F.col("hi")).alias("hi"), "place")
    e, u = F.col("event_id"), F.col("user_id")
    ip = (F.lit(10 << 24) + (u % 25) * 65536 + (e % 256) * 256 + u % 250).cast("bigint")
    events = load(spark, sf_dir, "events").select(e.alias("msg_id"), long(ip).alias("ip"))
    return ip_text_join(events, ranges, F.col("ip"), ("place",)).select("msg_id", "place")


@query(
    "leftover_discovery",
    SRC
    + """, keys as (
      select unnest(['kiosk', 'dup', 'mail', 'price', 'value', 'props', 'eq', 'pct', 'flag', 'note']) as key from src where not no_header
      union all select 'user' || user_id from src)
    select key, count(*) as n_rows from keys group by 1 having count(*) >= 0.01 * (select count(*) from keys)""",
)
def leftover_discovery(spark, sf_dir):
    """Keys that no rule claims and that are often there; every user has a key of their own as well."""
    from tidelog.operators.sketches import frequent_keys

    app = example_application()
    lines = app.parsed(messages(spark, sf_dir).join(load(spark, sf_dir, "events").select(F.col("event_id").alias("msg_id"), "user_id"), "msg_id"))
    mapped = app.events(lines, ("user_id",))
    own = F.create_map(F.concat(F.lit("user"), F.col("user_id").cast("string")), F.lit(""))
    return frequent_keys(mapped.select(F.map_concat("event_loginfo", own).alias("event_loginfo")), 0.01)
