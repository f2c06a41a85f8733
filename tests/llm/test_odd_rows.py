"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LONG, REPEAT, ROWS
from tidelog.llm import chat, common, decontaminate, fingerprint, lengths, licenses, minhash, mix, quality, shards, substrings

N = len(ROWS)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_fingerprints(odd, none):
    got = fingerprint.fingerprint_edits(odd, ranges=3)
    by = rows(got)
    assert got.count() == N
    assert by[2].fingerprint == by[3].fingerprint and by[2].n_chars == by[3].n_chars == 0
    assert by[5].fingerprint == by[6].fingerprint and by[9].fingerprint != by[10].fingerprint
    # after 12 come 11, 10 and so on; the row without an id is the last
    assert by[12].edited_sha256 == hashlib.sha256(("x" * 25_000 + ROWS[12][1][:25_000]).encode()).hexdigest()
    assert by[None].edited_sha256 == hashlib.sha256(("no id at " + "x" * 8).encode()).hexdigest()
    assert by[10].edited_sha256 == hashlib.sha256(b"Wowo").hexdigest()
    assert by[3].near_next == 1.0 and by[6].near_next == 1.0 and 0.6 < by[5].near_edited < 0.7
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in by.values())
    assert fingerprint.fingerprint_edits(none).count() == 0
    one = rows(fingerprint.fingerprint_edits(odd.filter("doc_id = 9")))
    assert one[9].near_next == 1.0


def test_any_number_of_ranges_gives_the_same(odd):
    first = sorted(map(str, fingerprint.fingerprint_edits(odd, ranges=1).collect()))
    assert first == sorted(map(str, fingerprint.fingerprint_edits(odd, ranges=50).collect()))


@pytest.mark.parametrize("k", [1, 2, 5])
def test_near_duplicates(odd, none, k):
    got = minhash.near_duplicates(odd, minhash.NearDuplicates(shingle=k))
    by = rows(got)
    assert got.count() == N
    assert [by[i].n_shingles for i in (2, 3, 4, 9)] == [0, 0, 0, 1]
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[10].component_id == 9  # letters' case does not count
    assert by[8].component_id == (7 if k < 5 else 7 if 66 * 100 >= 80 * 76 else 8)
    assert by[None].component_id is None and by[None].kept
    assert all(by[i].component_id == i for i in (2, 3, 4))
    assert minhash.near_duplicates(none).count() == 0


def test_near_dedup_keeps_columns(odd, none):
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 6").count() == 0 and kept.filter("doc_id is null").count() == 1
    assert minhash.keep_one(none).count() == 0


def test_quality(odd, none, labels):
    got = quality.classify(odd, labels)
    assert got.count() == N and got.filter("score is null or score < 0 or score > 1 or predicted is null or held_out is null").count() == 0
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert quality.classify(none, labels).count() == 0
    unlearnt = rows(quality.classify(odd, labels.limit(0)))
    assert all(r.score == 0.5 and r.predicted == 1 for r in unlearnt.values())


def test_mix(odd, none):
    got = mix.mix(odd)
    assert got.count() == N and got.filter("taken > 2 * size or taken < 0").count() == 0
    source = {r[0]: r[3] for r in ROWS}
    per, target = collections.Counter(), {}
    for r in got.collect():
        per[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(per[s] - target[s]) <= 1 for s in target)
    mixed = mix.mixed_documents(odd)
    assert mixed.columns == odd.columns
    # whole texts only; of each source as much as it shall have, to half of its longest
    assert {r.text for r in mixed.select("text").distinct().collect()} <= {r[1] for r in ROWS}
    sizes = collections.defaultdict(int)
    for r in mixed.collect():
        sizes[r.source] += len((r.text or "").split())
    longest = {s: max(len((r[1] or "").split()) for r in ROWS if r[3] == s) for s in target}
    assert all(abs(sizes[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
    assert mixed.filter("n_chars <> length(text)").count() == 0
    assert mix.mix(none).count() == 0 and mix.mixed_documents(none).count() == 0


def test_shards(odd, none):
    got = shards.shard_slots(odd, 5, blocks=3)
    by = {}
    for r in got.collect():
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 5) and 0 <= r.shard < 5
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == N
    two = rows(got)
    assert (two[2].size, two[2].text_crc32, two[3].size) == (16, 0, 16)
    assert shards.shard_slots(none).count() == 0
    assert shards.assign_shards(odd.drop("shard"), 7).count() == N


def test_jumps_are_even_and_move_little(spark):
    keys = spark.range(20_000).select((F.col("id") * 7919).alias("doc_id"))
    last = None
    for n in (10, 11, 12):
        now = {r.doc_id: r.shard for r in shards.assign_shards(keys, n).collect()}
        counts = [list(now.values()).count(s) for s in range(n)]
        assert max(counts) < 1.15 * min(counts)
        if last:
            moved = [k for k in now if now[k] != last[k]]
            assert all(now[k] == n - 1 for k in moved) and abs(len(moved) - 20_000 / n) < 300
        last = now


def test_lengths(odd, none):
    got = lengths.length_histogram(odd)
    assert got.agg(F.sum("n_docs")).first()[0] == N
    assert got.filter("source is null").agg(F.sum("n_docs")).first()[0] == 2
    assert got.filter("source = ''").count() == 1
    assert lengths.length_histogram(none).count() == 0


def test_decontamination(odd, none, items):
    by = rows(decontaminate.report(odd, items))
    assert (by[7].n_words, by[7].n_hit, by[7].n_items) == (73, 70, 1) and by[8].contaminated
    assert (by[1].n_hit, by[1].n_items) == (6, 2)
    assert by[1].items_sha256 == hashlib.sha256(b",2").hexdigest()
    assert (by[2].n_words, by[2].contaminated, by[2].items_sha256) == (0, False, hashlib.sha256(b"").hexdigest())
    assert by[12].n_words == 1 and not by[None].contaminated
    assert decontaminate.report(none, items).count() == 0
    assert decontaminate.report(odd, items.limit(0)).filter("contaminated").count() == 0
    small = sorted(map(str, decontaminate.find_spans(odd, items, block_words=25).select("doc_id", "n_words", "spans", "items").collect()))
    assert small == sorted(map(str, decontaminate.find_spans(odd, items).select("doc_id", "n_words", "spans", "items").collect()))


def test_decontaminated_texts(odd, items):
    kept = decontaminate.decontaminate(odd, items, max_coverage=0.8)
    assert kept.columns == odd.columns
    by = rows(kept)
    assert 7 not in by and 8 not in by
    assert by[1].text == "Alpha beta !\n" if by[1].text.endswith("\n") else by[1].text.startswith("Alpha beta ")
    assert by[5].text == LONG and by[2].text is None
    half = rows(decontaminate.decontaminate(odd, items, max_coverage=1.0))
    assert half[7].text == "one two  three" and half[7].n_chars == 14


def test_substrings(odd, none):
    got = substrings.dedup_substrings(odd)
    by = rows(got)
    assert got.count() == N
    assert (by[6].n_removed, by[5].n_removed) == (30_000, LONG.count(" ") + 1 - 30_000)
    assert (by[7].n_removed, by[8].n_removed, by[8].spans) == (0, 70, [[1, 71]])
    assert by[8].kept_sha256 == hashlib.sha256(b"four five six").hexdigest()
    assert by[2].kept_sha256 == hashlib.sha256(b"").hexdigest() and by[None].n_removed == 0
    assert substrings.dedup_substrings(none).count() == 0


def test_licenses(spark, none):
    apache = licenses.TEMPLATES["Apache-2.0 notice"]
    changed = apache.replace("use this file", "use that same file").replace("is distributed", "").upper()
    texts = [(1, f"one two {apache} end"), (2, None), (3, ""), (4, f"é {changed}"), (5, "Released under the MIT License."), (5, "MIT")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("license", F.lit("x"))
    got = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(1, "Apache-2.0 notice"), (4, "Apache-2.0 notice"), (5, "MIT line")]
    by = {r.doc_id: r for r in got}
    assert (by[1].coverage, by[1].start_word, by[1].start_char) == (1.0, 2, 8)
    assert texts[0][1][by[1].start_char : by[1].end_char] == apache.rstrip(".")
    assert 0.9 < by[4].coverage < 1 and by[4].start_char == 2
    many = spark.createDataFrame([(1, "x Released under the MIT License. y " * 50)], "doc_id bigint, text string")
    assert licenses.scan_licenses(many).count() == 50
    assert licenses.scan_licenses(none).count() == 0
    assert licenses.scan_licenses(docs, {}).count() == 0


def test_chat(spark):
    turns = [
        (1, 1, "assistant", "two\\"), (1, 0, "user", "a </turn>\n<turn>user\nb"), (1, 1, "assistant", "two\\"),
        (1, None, None, None), (None, 0, "assistant", "### x"), (2, 0, "us\ner", ""),
    ]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit("x"))
    by = rows(chat.read_back(chat.format_conversations(df)), "conv_id")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = "\n\n" + "user\na </turn>\n<turn>user\nb\n" + 2 * "assistant\ntwo\\\n"
    assert (by[1].n_turns, by[1].turns_sha256) == (4, digest(want))
    assert (by[1].loss_chars, by[1].loss_sha256) == (8, digest("two\\two\\"))
    assert by[None].loss_sha256 == digest("### x") and by[2].turns_sha256 == digest("us\ner\n\n")
    assert by[2].loss_chars == 0
    assert chat.format_conversations(df.limit(0)).count() == 0
    text = chat.format_conversations(df).filter("conv_id = 2").first().formatted
    assert text == "<turn>us\\\ner\n</turn>\n" and by[2].formatted_chars == len(text)


def test_long_conversations_come_in_parts(spark, monkeypatch):
    turns = spark.range(400).selectExpr("7 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('\\\\\\\\</turn>é', 2000) as text")
    parts = chat.format_conversations(turns)
    assert parts.count() > 5
    row = chat.read_back(parts).first()
    plain = turns.first().text
    assert row.n_turns == 400 and row.loss_chars == 200 * len(plain)
    assert row.loss_sha256 == hashlib.sha256((plain * 200).encode()).hexdigest()


def test_pipeline_stages_take_anything(spark, odd, none, tmp_path, items, labels):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd.drop("shard"), none.drop("shard")):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "assign_shards":
                assert docs.columns == odd.drop("shard").columns
        assert docs.columns[-1] == "shard"
        docs.collect()


def test_passages_of_any_length(spark):
    """Windows of 50 words: 49 repeated words stay, 50 go."""
    texts = [(1, f"a {REPEAT} b")] + [(i, f"c{i} " + " ".join(REPEAT.split()[:n]) + f" d{i}") for i, n in ((2, 49), (3, 50), (4, 53))]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    by = rows(substrings.dedup_substrings(df))
    assert [by[i].n_removed for i in (1, 2, 3, 4)] == [0, 0, 50, 53]


def thue_morse(n):
    """A word of n letters, and the same with its letters exchanged."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [64, 1024, 4096, 1 << 13])
def test_patterns_of_letters_do_not_collide(spark, n):
    a, b = thue_morse(n)
    for seed in (0, 1):
        (x,), (y,) = common.word_hashes([a.encode(), b.encode()], seed)
        assert x != y
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {1, 2}
    long = spark.createDataFrame([(1, f"{a} {REPEAT}"[: -len(REPEAT.split()[-1])]), (2, f"{b} {' '.join(REPEAT.split()[:48])}")], "doc_id bigint, text string")
    assert [r.n_removed for r in substrings.dedup_substrings(long).collect()] == [0, 0]


def test_hashes_do_not_depend_on_where_a_word_stands():
    words = [b"one", b"x" * 5000, "é日本".encode(), b"one"]
    (all_,) = common.word_hashes([b" \t".join(words)])
    assert all_[0] == all_[3] and len(set(all_.tolist())) == 3
    assert [int(h[0]) for h in common.word_hashes(words)] == all_.tolist()


def test_an_id_with_two_texts(spark):
    rows = [(1, REPEAT), (2, f"a b c {REPEAT}"), (2, "short"), (2, f"{REPEAT} x y z"), (3, "short")]
    got = substrings.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string"), substrings.Repeats(window=50)).collect()
    assert len(got) == 5 and [r.n_removed for r in got if r.doc_id in (1, 3)] == [0, 0]
    assert next(r for r in got if r.doc_id == 2 and r.n_words == 1).n_removed == 0
    assert all(r.n_removed >= 70 for r in got if r.doc_id == 2 and r.n_words > 1)


def test_signatures_of_long_sets_are_those_of_their_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (3, 1000, 1, 50)]
    whole = minhash.signatures_of(sets, 24)
    monkeypatch.setattr(minhash, "CHUNK", 64)
    assert (minhash.signatures_of(sets, 24) == whole).all()


def test_near_duplicates_against_all_pairs(spark):
    """Texts of one pattern, some alike enough, of several sizes."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = list(base[: 20 + int(rng.integers(0, 20))])
        for at in rng.integers(0, len(words), int(rng.integers(0, 4))):
            words[at] = f"own{i}" if rng.random() < 0.6 else f"w{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[j : j + 2]) for j in range(len(t.split()) - 1)} for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), minhash.NearDuplicates(shingle=2, bands=1, rows=6))
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: root(i) for i in range(len(rows))}
