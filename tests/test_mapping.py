from __future__ import annotations

import ipaddress
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_parse import GOLDEN, messages
from tidelog.functions import text
from tidelog.functions.hooks import HookResult, referer_split, url_split
from tidelog.operators import parse
from tidelog.operators.enrich import ip_key, ip_range_join, ip_text_join, ip_to_long, overlapping_ranges
from tidelog.operators.mapping import MapRule, apply_rules, conform
from tidelog.plans.example import EVENT_COLUMNS, example_application, schema_from_text, wide_application


def bag(spark, **fields):
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in fields.items())
    return spark.sql(f"select map({pairs}) as fields")


def run(df, *rules):
    out = apply_rules(df, rules).withColumn("event_loginfo", text.map_to_string("event_loginfo"))
    return out.first().asDict()


def test_consumed_fields_are_gone_for_later_rules(spark):
    row = run(bag(spark, a="1", b="2"), MapRule(("a",), ("x",)), MapRule(("a", "b"), ("y", "z")), MapRule(("a",), ("w",)))
    assert row == {"x": "1", "y": "2", "z": "2", "w": None, "event_loginfo": ""}


def test_refusing_rule_leaves_everything(spark):
    def refuse(ins, outs):
        return HookResult({outs[0]: F.lit("no")}, F.lit(False))

    row = run(bag(spark, a="1"), MapRule(("a",), ("x",)), MapRule(("b",), ("x",), refuse))
    assert row["x"] == "1"
    row = run(bag(spark, a="1"), MapRule(("a",), ("x",), refuse), MapRule(("a",), ("y",)))
    assert row == {"x": None, "y": "1", "event_loginfo": ""}
    row = run(bag(spark, a="1"), MapRule(("a",), ("x",), refuse))
    assert row == {"x": None, "event_loginfo": "a:1"}


def test_hooks_fill_a_rules_outputs(spark):
    df = bag(spark, host="h", url="/p?word=x&y=1")

    def outs(*names):
        return run(df, MapRule(("host", "url"), names, url_split()))

    assert outs("a", "b") == {"a": "h/p?word=x&y=1", "b": "h", "event_loginfo": ""}
    assert outs("q=query", "p=path") == {"q": "x", "p": "/p", "event_loginfo": ""}
    assert outs("a", "q=query", "p") == {"a": "h/p?word=x&y=1", "q": "x", "p": "/p", "event_loginfo": ""}
    assert MapRule((), ("a", "q=query")).columns == ("a", "q")
    for wrong in (("q=nothing",), tuple("abcdef")):
        with pytest.raises(ValueError, match="has the parts url, hostname"):
            outs(*wrong)


def model(rules, fields):
    """Rules one after the other on a dict; a hook refuses rows without an even last input."""
    left, event = dict(fields), {}
    for ins, outs, refuses in rules:
        values = [left.get(n) for n in ins]
        if refuses and not (values[-1] is not None and int(values[-1]) % 2 == 0):
            continue
        event |= {n: values[-1] for n in outs}
        for n in ins:
            left.pop(n, None)
    return event, left


def if_even(ins, outs):
    last = list(ins.values())[-1]
    return HookResult({n: last for n in outs}, last.cast("int") % 2 == 0)


@pytest.mark.parametrize("seed", range(4))
def test_rules_with_refusing_hooks_against_a_model(spark, seed):
    rng = random.Random(seed)
    names = "abcdef"
    drawn = [(tuple(rng.sample(names, rng.randint(1, 2))), tuple(rng.sample("uvwxyz", rng.randint(1, 2))), rng.random() < 0.6) for _ in range(9)]
    rows = [(i, {n: str(rng.randrange(10)) for n in names if rng.random() < 0.8}) for i in range(40)]
    df = spark.createDataFrame(rows, "i bigint, fields map<string,string>")
    rules = [MapRule(ins, outs, if_even if refuses else "copy") for ins, outs, refuses in drawn]
    for r in apply_rules(df, rules, keep=("i",)).collect():
        event, left = model(drawn, rows[r.i][1])
        got = {k: v for k, v in r.asDict().items() if k not in ("i", "event_loginfo")}
        assert {k: v for k, v in got.items() if v is not None} == {k: v for k, v in event.items() if v is not None}
        assert r.event_loginfo == left


def test_refusing_rules_are_layers_not_a_projection_each(spark):
    """45 rules, of which ten may refuse a row: two of them share a field."""
    fields = {f"f{i}": str(i) for i in range(45)}
    rules = [MapRule((f"f{i}",), (f"o{i}",), if_even if i % 5 == 0 else "copy") for i in range(44)]
    rules.append(MapRule(("f0", "f5"), ("o44",), if_even))
    df = spark.createDataFrame([(fields,)] * 3, "fields map<string,string>")
    start = time.perf_counter()
    out = apply_rules(df, rules)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project [") <= 6 and time.perf_counter() - start < 20
    row = out.first()
    assert row.o0 == "0" and row.o5 is None and row.o6 == "6" and row.o44 is None
    assert sorted(row.event_loginfo) == sorted(f"f{i}" for i in (5, 15, 25, 35, 44))


def test_later_rule_overwrites_an_output(spark):
    row = run(bag(spark, a="1", b="2"), MapRule(("a",), ("x",)), MapRule(("b",), ("x",)))
    assert row["x"] == "2"


def test_claimed_and_left_keys_are_all_keys(spark):
    app = example_application()
    parsed = app.parsed(messages(spark, [GOLDEN]))
    claimed = {n for r in app.rules for n in r.ins}
    keys = set(parsed.select(F.map_keys("fields").alias("k")).first().k)
    left = set(app.events(parsed).select(F.map_keys("event_loginfo").alias("k")).first().k)
    assert left == keys - claimed


def test_event_table_shape(spark):
    schema = schema_from_text(EVENT_COLUMNS)
    app = example_application()
    events = app.events(app.parsed(messages(spark, [GOLDEN])))
    assert events.columns == [*schema.fieldNames(), "shop_price", "shop_memo", "shop_gate", "shop_desk"]
    assert {f.dataType.simpleString() for f in schema} == {"string", "bigint", "map<string,string>", "map<string,bigint>"}
    row = events.first()
    assert (row.sale, row.buyer, row.coupon, row.block) == ("0000000001", 42, "", {"left": 12, "right": 34})


def test_wide_plans(spark):
    app = wide_application()
    assert len(app.rules) == 45 and len(app.schema) == 100
    events = app.run(messages(spark, [GOLDEN, "junk"]))
    assert events.count() == 2 and len(events.columns) > 120


def test_names_need_no_escaping(spark):
    odd = "it's \\ %"
    df = spark.createDataFrame([({odd: "1", "b": "2"},)], "fields map<string,string>")

    def refuse(ins, outs):
        return HookResult({outs[0]: F.lit("no")}, F.lit(False))

    row = run(df, MapRule((odd,), ("x",), refuse), MapRule((odd,), ("y",)))
    assert row == {"x": None, "y": "1", "event_loginfo": "b:2"}
    assert _url(spark, url_split(query_param="a'.\\E"), host="h", url="/p?a'.\\E=7")["query"] == "7"


def test_conform_casts(spark):
    df = spark.sql("select '1376910002.895' as a, 'x' as b, 'k:1,l:z' as c, '9007199254740993' as d")
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in "abd"]
        + [T.StructField("c", T.MapType(T.StringType(), T.LongType())), T.StructField("e", T.StringType())]
    )
    row = conform(df, schema).first()
    assert (row.a, row.b, row.d, row.c, row.e) == (1376910002, None, 9007199254740993, {"k": 1, "l": None}, "")


def _url(spark, hook, **ins):
    df = spark.createDataFrame([tuple(ins.values())], ", ".join(f"{n} string" for n in ins))
    out = df.select(*(c.alias(n) for n, c in hook({n: F.col(n) for n in ins}, ()).items()))
    maps = [n for n in out.columns if n == "params"]
    return out.select(*(text.map_to_string(n).alias(n) if n in maps else n for n in out.columns)).first().asDict()


def test_url_without_parameters(spark):
    assert _url(spark, url_split(), host="h", url="/p")["params"] == ""
    assert _url(spark, url_split(quirks=True), host="h", url="/p")["params"] == ":"


def test_url_parameters(spark):
    row = _url(spark, url_split(), host="h", url="/p?word=a=b&x=1&word=c&y?z")
    assert row == {
        "url": "h/p?word=a=b&x=1&word=c&y?z",
        "hostname": "h",
        "path": "/p",
        "params": "word:c,x:1,y:",
        "query": "c",
    }
    assert _url(spark, url_split(), host="h", url="/p?password=1")["query"] == ""
    assert _url(spark, url_split(), host="h", url="/p?word=1&word")["query"] == ""


def test_referer(spark):
    row = _url(spark, referer_split(), refer="http://e.com/a/b?x=1#f")
    assert (row["hostname"], row["path"]) == ("e.com", "/a/b")
    row = _url(spark, referer_split(quirks=True), refer="http://e.com/a/b?x=1")
    assert (row["hostname"], row["path"]) == ("", "")


def test_visitor_id(spark):
    df = spark.sql("""select '"\\'0123456789ABCDEF0123456789ABCDEF:v2\\'"' as x""")
    assert df.select(text.visitor_id_clean("x").alias("x")).first().x == "0123456789ABCDEF0123456789ABCDEF"


def test_ip_to_long(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("256.1.1.1",), ("x",), ("255.255.255.255",)], "ip string")
    got = [r.n for r in df.select(ip_to_long(F.col("ip")).alias("n")).collect()]
    assert got == [16909060, None, None, 4294967295]


def test_ip_range_join_both_ways(spark):
    """Ranges over several blocks, within one, and a gap; broadcast or salted."""
    ranges = [(0, 70000, "a"), (70001, 70005, "b"), (200000, 4294967295 - 10, "c")]
    dim = spark.createDataFrame(ranges, "lo bigint, hi bigint, place string")
    values = [0, 65535, 65536, 70000, 70001, 70006, 199999, 200000, 3000000000, 4294967290]
    rows = [(i, ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i bigint, ip string")
    want = [next((p for lo, hi, p in ranges if lo <= v <= hi), None) for v in values]
    for salts in (1, 4):
        got = ip_range_join(df, dim, F.col("ip"), ("place",), prefix_bits=12, salts=salts, spread=("i",))
        assert [r.place for r in got.orderBy("i").collect()] == want
    assert overlapping_ranges(dim, 12).count() == 0
    wrong = dim.union(spark.sql("select 70003L, 300000L, 'd'"))
    assert {(r.lo, r.next_lo) for r in overlapping_ranges(wrong, 12).collect()} == {(70001, 70003), (70003, 200000)}


def narrowest(ranges, v):
    found = [(hi - lo, lo, p) for lo, hi, p in ranges if lo is not None and hi is not None and lo <= v <= hi]
    return min(found)[2] if found else None


def test_the_narrowest_range_counts(spark):
    """Nested, overlapping, repeated and empty ranges: a row in, a row out."""
    rng = random.Random(4)
    ranges = [(0, 2**32 - 1, "all"), (None, 5, "x"), (9, 8, "none"), (100, 200, "b"), (100, 200, "a"), (150, 250, "c")]
    ranges += [(lo, lo + rng.choice([0, 3, 500, 70_000, 3_000_000]), f"r{i}") for i, lo in enumerate(rng.sample(range(200_000), 60))]
    dim = spark.createDataFrame(ranges, "lo bigint, hi bigint, place string")
    values = [*rng.sample(range(300_000), 300), 0, 100, 150, 200, 201, 250, 2**32 - 1]
    rows = [(i, ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))) for i, v in enumerate(values)] + [(-1, "x"), (-2, None)]
    df = spark.createDataFrame(rows, "i bigint, ip string")
    want = {i: narrowest(ranges, v) for i, v in enumerate(values)} | {-1: None, -2: None}
    got = ip_range_join(df, dim, F.col("ip"), ("place",)).collect()
    assert len(got) == len(rows) and {r.i: r.place for r in got} == want
    as_text = [(None if lo is None else str(ipaddress.ip_address(lo)), str(ipaddress.ip_address(hi)), p) for lo, hi, p in ranges if hi < 2**32]
    by_text = ip_text_join(df, spark.createDataFrame(as_text, "lo string, hi string, place string"), F.col("ip"), ("place",)).collect()
    assert len(by_text) == len(rows) and {r.i: r.place for r in by_text} == want


def test_ip_keys(spark):
    good = ["1.2.3.4", "::", "::1", "1::", "2001:db8::8:800:200C:417A", "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33", "fe80::1:2:3"]
    bad = ["1.2.3", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "g::", ":::", "12345::", "1:2:3:4:5:6:7:8::", "", "::1.2.3.400"]
    df = spark.createDataFrame([(x,) for x in [*good, *bad, None]], "ip string")
    got = {r.ip: r.k for r in df.select("ip", ip_key(F.col("ip")).alias("k")).collect()}
    for x in good:
        address = ipaddress.ip_address(x)
        number = int(address) if address.version == 6 else (0xFFFF << 32) + int(address)
        assert got[x] == f"{number:032x}", x
    assert all(got[x] is None for x in [*bad, None])


def test_ranges_of_long_addresses(spark):
    rng = random.Random(6)
    base = int(ipaddress.ip_address("2001:db8::"))
    ranges = [(base, base + 2**96 - 1, "doc")]
    for i in range(200):
        lo = base + rng.getrandbits(95)
        ranges.append((lo, lo + rng.getrandbits(rng.choice([0, 64, 90])), f"r{i}"))
    values = [r[0] for r in ranges] + [r[1] for r in ranges] + [base + rng.getrandbits(95) for _ in range(200)] + [1]
    text = lambda v: str(ipaddress.IPv6Address(v))
    dim = spark.createDataFrame([(text(lo), text(hi), p) for lo, hi, p in ranges], "lo string, hi string, place string")
    df = spark.createDataFrame([(i, text(v)) for i, v in enumerate(values)], "i bigint, ip string")
    got = ip_text_join(df, dim, F.col("ip"), ("place",)).collect()
    assert len(got) == len(values) and {r.i: r.place for r in got} == {i: narrowest(ranges, v) for i, v in enumerate(values)}
    none = ip_text_join(df, dim.limit(0), F.col("ip"), ("place",)).collect()
    assert len(none) == len(values) and all(r.place is None for r in none)


def test_quarantined_lines_still_have_rows(spark):
    out = example_application().run(messages(spark, ["junk", GOLDEN]))
    rows = {r.msg_id: r for r in out.collect()}
    assert rows[0].reason == "no_header" and rows[0].bucket is None
    assert rows[1].reason is None and rows[1].bucket == "202408191900"
    assert parse.accepted(out).count() == 1
