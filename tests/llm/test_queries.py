"""The registered queries against their SQL, or against a plain version."""

from __future__ import annotations

import collections
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import compare, database
from tidelog.llm import lengths, licenses
from tidelog.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) == ""


def _texts(spark, sf_dir=SF_DIR):
    return [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_quality_holds_for_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op3_quality"](spark, sf_dir).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert sum(rows[r.doc_id].predicted == r.quality for r in labels) >= 0.97 * len(labels)


def _water_level(sizes):
    """Targets in rounds, as they are defined."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2.0 * sizes[s] if over else unit * weight[s]
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over or open_
    return target


def test_mix_meets_its_targets(spark):
    rows = QUERIES["op4_mix"](spark, SF_DIR).collect()
    words = {i: (s, len(t.encode().split())) for i, s, t in _texts(spark)}
    sizes, taken = collections.Counter(), collections.Counter()
    for s, n in words.values():
        sizes[s] += n
    target = _water_level(sizes)
    for r in rows:
        source, n = words[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[source]) and 0 <= r.taken <= 2 * n
        assert r.target == pytest.approx(target[source])
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = QUERIES["op4_mix"](spark, SF_DIR)
    assert sorted(again.collect()) == sorted(rows)


def test_token_lengths(spark):
    import base64

    import tiktoken

    path, pattern = lengths.default_vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    by = collections.defaultdict(list)
    for _, source, text in _texts(spark):
        by[source].append(len(encode(text)))
    histogram = QUERIES["op6_token_lengths"](spark, SF_DIR).cache()
    seen = set()
    for r in histogram.collect():
        all_, n = by[r.source], r.n_tokens
        seen.add((r.source, n))
        assert r.n_docs == all_.count(n)
        assert (r.docs_up_to, r.tokens_up_to) == (sum(x <= n for x in all_), sum(x for x in all_ if x <= n))
        assert (r.docs_over, r.tokens_over) == (sum(x > n for x in all_), sum(x for x in all_ if x > n))
        assert r.truncated_total == sum(min(x, n) for x in all_)
        assert r.quantile == pytest.approx(sum(x <= n for x in all_) / len(all_))
    assert seen == {(s, n) for s, x in by.items() for n in x}
    for r in lengths.at_limits(histogram, [0, 77, 500, 10**6]).collect():
        assert r.truncated_total == sum(min(x, r.context_limit) for x in by[r.source])
        assert r.docs_fit == sum(x <= r.context_limit for x in by[r.source])
    for r in lengths.quantiles(histogram, [0.5, 1.0]).collect():
        x = sorted(by[r.source])
        assert r.n_tokens == x[-(-len(x) * int(r.share * 2) // 2) - 1]


def test_licenses_are_found_where_they_stand(spark):
    rows = collections.defaultdict(list)
    for r in QUERIES["op10_licenses"](spark, SF_DIR).collect():
        rows[r.doc_id].append(r)
    lines = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("line")}
    for doc_id, _, text in _texts(spark):
        want = sorted((text.index(v), k) for k, v in lines.items() if v in text)
        got = sorted((r.start_char, r.license) for r in rows[doc_id] if r.coverage == 1.0)
        assert got == want
        for r in rows[doc_id]:
            assert text[r.start_char : r.end_char] in licenses.TEMPLATES[r.license] or r.coverage < 1


def test_pipeline(spark):
    """Each stage against what it is to do with what it gets."""
    from tidelog.llm import decontaminate, minhash

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.count()
        if name != "assign_shards":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out[name] = docs
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in out["quality_filter"].collect()}
    right = [(i in kept) == (q == 1) for i, q in labels.items()]
    assert sum(right) >= 0.95 * len(right)
    sets = {}
    for r in out["quality_filter"].collect():
        sets[r.doc_id] = set(minhash.shingles([r.text.encode()], 5)[0].tolist())
    left = {r.doc_id for r in out["near_dedup"].collect()}
    for i in sets:
        alike = [j for j in sets if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert (i in left) <= (not alike)
        if i not in left:
            assert any(100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in sets if j != i)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    clean = decontaminate.report(out["near_dedup"], items).filter("not contaminated").select("doc_id")
    same = out["near_dedup"].join(clean, "doc_id").exceptAll(out["benchmark_decontamination"].join(clean, "doc_id"))
    assert same.count() == 0
    sharded = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, sharded.collect())) == sorted(map(str, out["assign_shards"].collect()))
    assert sharded.filter(F.col("shard").isNull() | ~F.col("shard").between(0, 39)).count() == 0
