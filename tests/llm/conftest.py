from __future__ import annotations

import pytest
from pyspark.sql import functions as F

# names that the operators use inside
CLASHING = (
    "row_key block shard slot size id a b hash at starts ats class bands score spans items n_words part copy edited "
    "fingerprint next_text rate target taken rates_before room_before _bytes _row _text _range _key _gone _words _copies "
    "n_tokens _group held_out conv_id"
).split()

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
REPEAT = " ".join(f"passage{i}" for i in range(70))
ROWS = [
    (1, "Alpha beta gamma. Delta epsilon!\nZeta eta theta", "en", "b"),
    (2, None, "en", "b"),
    (3, "", None, None),
    (4, " \t\n ", "en", "a"),
    (5, LONG, "en", "a"),
    (6, LONG, "en", None),
    (7, f"one two {REPEAT} three", "en", "a"),
    (8, f"four {REPEAT} five six", "en", "c"),
    (8, f"four {REPEAT} five six", "en", "c"),
    (9, "word", "en", "c"),
    (10, "Word", "en", ""),
    (None, "no id at all here", "en", "a"),
    (11, "日本語 テキスト 😀 é\x00\x0b end", "ja", "é"),
    (12, "x" * 50_000, "en", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, repeated and long texts, and further columns."""
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    return df.select("*", *(F.lit("x").alias(n) for n in CLASHING)).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    """The same columns without rows."""
    return odd.limit(0)


@pytest.fixture(scope="session")
def items(spark):
    texts = [(1, REPEAT.upper()), (2, "gamma, delta epsilon"), (3, None), (None, "zeta ETA theta"), (5, "..."), (2, "gamma, delta epsilon")]
    return spark.createDataFrame(texts, "item_id bigint, text string").withColumn("doc_id", F.lit("x"))


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 13)] + [(None, 1, 0), (1, None, 0), (2, 5, 0), (77, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("x"))
