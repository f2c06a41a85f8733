"""Lines, fields and text functions against small Python models."""

from __future__ import annotations

import datetime as dt
import random
import re
from urllib.parse import quote_from_bytes, unquote_to_bytes

import pytest
from pyspark.sql import functions as F

from tidelog.functions import clock, text
from tidelog.operators import parse
from tidelog.plans.example import example_application

INGEST = dt.datetime(2024, 8, 19, 20, 0)

GOLDEN = (
    "NOTICE: 08-19 19:00:02 sale * 101 [sale=0000000001 kiosk=7 buyer=42 guest=%B1%B1%BE%A9 mail=a%40example.com "
    "pass=0123456789ABCDEF0123456789ABCDEF%3Av2 addr=10.1.2.3 device=Agent%2F1.0%20%28X%29 site=example.com "
    "page=%2Fsearch%3Fword%3Dspark%26pn%3D2 via=http%3A%2F%2Fexample.com%2Fq%2F1.html%3Fa%3D1 gate= "
    "block=left%3D%2712%27%20right%3D%2734%27 Price=cents%3D38%20fee%3D2 price=40 memo=act%3D%27sold%27%20part%3D%273%27 "
    "code=0 took=1000000002.895 desk=10.9.9.9 note=]"
)


def messages(spark, lines, ingest=INGEST):
    rows = [(i % 2, i, line, ingest) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "pipelet bigint, msg_id bigint, body string, ingest_ts timestamp_ntz")


def bags(spark, lines):
    """Fields of each line as ordered pairs."""
    df = parse.cut_notice(messages(spark, lines)).orderBy("msg_id")
    rows = df.select("matched", F.map_keys("fields").alias("k"), F.map_values("fields").alias("v")).collect()
    return [(r.matched, list(zip(r.k, r.v, strict=True))) for r in rows]


def model_bag(line: str):
    """What a line's bag should be, on characters."""
    m = re.match(r"NOTICE: (\d+-\d+) (\d\d:\d\d:\d\d)(.*)\[(.*)\]", line, re.ASCII)
    if not m:
        return False, [("date", ""), ("time", "")]
    bag = {"date": m[1], "time": m[2]}
    for token in m[4].split(" "):
        k, *rest = token.split("=")
        bag[k] = unquote_to_bytes((rest[0] if rest else "").replace("+", " ")).decode("utf8", "replace")
    return True, list(bag.items())


def test_golden_line(spark):
    app = example_application()
    row = app.run(messages(spark, [GOLDEN])).select(
        "*",
        text.map_to_string("page_params").alias("params"),
        text.map_to_string("via_params").alias("via_text"),
        text.map_to_string("block").alias("block_text"),
        text.map_to_string("shop_price").alias("price"),
        F.array_join(F.map_keys("event_loginfo"), " ").alias("left"),
    ).first()
    want = {
        "sold_month": 8,
        "sold_day": 19,
        "sold_time": "19:00:02",
        "event_day": "20240819",
        "event_hour": "19",
        "event_minute": "00",
        "guest": "北京",
        "holder": "0123456789ABCDEF0123456789ABCDEF",
        "page": "example.com/search?word=spark&pn=2",
        "page_path": "/search",
        "search": "spark",
        "params": "word:spark,pn:2",
        "via_text": "a:1",
        "via_path": "/q/1.html",
        "device": "Agent/1.0 (X)",
        "block_text": "left:12,right:34",
        "buyer": 42,
        "price": "cents:38,fee:2",
        "shop_memo": "act='sold' part='3'",
        "took": 1000000002,
        "left": "kiosk mail price note",
    }
    assert {k: row[k] for k in want} == want


EDGES = [
    "no header at all",
    "NOTICE: 08-19 19:00:02 x [a=1 [b=2]",
    "NOTICE: 08-19 19:00:02 x [k=1=2]",
    "NOTICE: 08-19 19:00:02 x [k]",
    "NOTICE: 08-19 19:00:02 x [a=1  b=2]",
    "NOTICE: 08-19 19:00:02 x [k=1 j=3 k=2 k]",
    "NOTICE: 08-19 19:00:02 x [time=20:00:00 a=1]",
    "NOTICE: 08-19 19:00:02 x [v=%zz w=%4 x=%]",
    "NOTICE: 08-19 19:00:02 x [v=a+b Price=1 price=2]",
    "NOTICE: 08-19 19:00:02 x []",
    "NOTICE: 08-19 19:00:02 x [a] tail] more",
    "NOTICE: 08-19 19:00:02 x [a=1] y [b=2] z [c",
    "NOTICE: 08-19 19:00:02 x a=1]",
    "NOTICE: 08-19 19:00:02 x\n[a=1]",
    "NOTICE: 8-19 19:00:02 x [a=é b=%C3%A9]",
    "",
]


def test_edge_lines(spark):
    for line, got in zip(EDGES, bags(spark, EDGES), strict=True):
        assert got == model_bag(line), line


def test_random_lines(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", "=", " ", "[", "]", "%41", "%2", "+", "é", "k=1", "%C3%A9", ":"]
    lines = [
        "NOTICE: 01-02 03:04:05 [" + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) + "]"
        for _ in range(400)
    ]
    for line, got in zip(lines, bags(spark, lines), strict=True):
        assert got == model_bag(line), line


def test_keep_last_setting_gives_the_same(spark):
    before = bags(spark, EDGES)
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    try:
        assert bags(spark, EDGES) == before
    finally:
        spark.conf.unset("spark.sql.mapKeyDedupPolicy")


def test_percent_decode_is_byte_exact(spark):
    rng = random.Random(3)
    raw = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    rows = [(i, quote_from_bytes(b)) for i, b in enumerate(raw)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", text.percent_decode("x").alias("x"))
    got = {r.i: bytes(r.x) for r in df.select("i", F.col("x").cast("binary").alias("x")).collect()}
    assert [got[i] for i in range(len(raw))] == raw


def test_decoding_twice_then_transcoding(spark):
    rows = [("%B1%B1%BE%A9", "北京"), ("%25B1%25B1", "北"), ("plain", "plain"), ("%2541+b", "A b"), ("%FF", "?")]
    once = spark.createDataFrame(rows, "x string, want string").select("want", text.percent_decode("x").alias("x"))
    with text.java_charsets(spark):
        got = once.select("want", text.decode_transcode("x").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_undecodable_line_keeps_its_bytes(spark):
    line = b"NOTICE: 08-19 19:00:02 x [un=\xb1\xb1 a=1]"
    df = messages(spark, ["x"]).withColumn("body", F.lit(line).cast("string"))
    row = parse.cut_notice(df).select(F.col("fields")["un"].cast("binary").alias("un"), F.col("fields")["a"].alias("a")).first()
    assert bytes(row.un) == b"\xb1\xb1" and row.a == "1"


def test_kv_map_of_gbk_bytes(spark):
    raw = "msg='".encode() + "成功".encode("gbk") + b"' n='1' n='2' bare"
    df = spark.range(1).select(F.lit(raw).cast("string").alias("x"))
    with text.java_charsets(spark):
        got = df.select(text.kv_string_to_map("x").alias("m")).select(text.map_to_string("m").alias("m")).first()
    assert got.m == "msg:成功,n:2,bare:"


@pytest.mark.parametrize(
    ("stamp", "ingest", "want"),
    [
        ("12-31 23:59:00", dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2023, 12, 31, 23, 59)),
        ("01-01 00:01:00", dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1, 0, 1)),
        ("08-19 19:00:02", INGEST, dt.datetime(2024, 8, 19, 19, 0, 2)),
        ("02-29 10:00:00", dt.datetime(2025, 3, 5), dt.datetime(2024, 2, 29, 10, 0)),
        ("02-30 10:00:00", INGEST, None),
        ("08-19 99:99:99", INGEST, None),
        ("8-19 10:00:00", INGEST, None),
        ("08-19 10:00:60", INGEST, None),
    ],
)
def test_event_time(spark, stamp, ingest, want):
    df = spark.createDataFrame([(*stamp.split(" "), ingest)], "d string, t string, i timestamp_ntz")
    assert df.select(clock.event_time(F.col("d"), F.col("t"), F.col("i")).alias("ts")).first().ts == want


def test_epoch_of_a_zone(spark):
    df = spark.range(1).select(F.lit("2024-08-19 19:00:02").cast("timestamp_ntz").alias("ts"))
    row = df.select(clock.epoch_seconds(F.col("ts")).alias("utc"), clock.epoch_seconds(F.col("ts"), "Asia/Shanghai").alias("cn")).first()
    assert row.utc - row.cn == 8 * 3600


def test_bucket_does_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in New York on that day."""
    df = spark.range(1).select(F.lit("2024-03-10 02:30:15").cast("timestamp_ntz").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(clock.bucket_key(F.col("ts"), 10).alias("b")).first().b == "202403100230"
        parsed = example_application().parsed(messages(spark, [GOLDEN.replace("08-19 19", "03-10 02")]))
        assert parsed.first().event_ts == dt.datetime(2024, 3, 10, 2, 0, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_quarantine_and_main_make_up_all_lines(spark):
    lines = [GOLDEN, "junk", GOLDEN.replace("08-19", "02-30"), GOLDEN.replace("19:00:02", "99:99:99")]
    parsed = example_application().parsed(messages(spark, lines))
    reasons = [r.reason for r in parsed.orderBy("msg_id").select("reason").collect()]
    assert reasons == [None, "no_header", "bad_time", "bad_time"]
    assert parse.accepted(parsed).count() + parse.quarantined(parsed).count() == len(lines)


def test_string_to_map(spark):
    rows = [("a:1,b:2", "a:1,b:2"), ("", ""), ("a:1,a:2", "a:2"), ("u:x:y", "u:x:y")]
    df = spark.createDataFrame(rows, "x string, want string").select("want", text.string_to_map("x").alias("m"))
    assert all(r.got == r.want for r in df.select("want", text.map_to_string("m").alias("got")).collect())


POLICIES = ("EXCEPTION", "LAST_WIN")


@pytest.mark.parametrize("built", POLICIES)
@pytest.mark.parametrize("run", POLICIES)
def test_repeated_keys_do_not_depend_on_the_session(spark, built, run):
    name = "spark.sql.mapKeyDedupPolicy"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, built)
        bag = parse.cut_notice(messages(spark, ["NOTICE: 08-19 19:00:02 x [a=1 b=2 a=3]"])).select("fields")
        spark.conf.set(name, run)
        assert bag.first().fields == {"date": "08-19", "time": "19:00:02", "a": "3", "b": "2"}
    finally:
        spark.conf.set(name, before)


def test_a_line_without_ingest_time_says_so(spark):
    app = example_application()
    rows = app.run(messages(spark, [GOLDEN, "junk"], ingest=None)).orderBy("msg_id").collect()
    assert [r.reason for r in rows] == ["no_ingest_time", "no_header"]
