"""Source divergence against a plain version."""

from __future__ import annotations

import collections
import re

import pytest

from tests.llm.conftest import LONG, ROWS
from tidelog.llm import divergence
from tidelog.llm.divergence import Audit

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    data = (text or "").encode()
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in t).decode() for t in TERM.findall(data)]


def plain(rows, audit):
    """Rows as the definitions give them, with dense vectors."""
    docs = [(lang or "", source or "", terms(text)) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= audit.min_docs)

        def shares(some):
            count = collections.Counter(t for d in some for t in d[2])
            total = sum(count[t] for t in kept)
            return {t: 1 + audit.scale * (count[t] + audit.smoothing) // (total + audit.smoothing * len(kept)) for t in kept}, count

        q, _ = shares(own)
        sources = sorted({d[1] for d in own})
        p = {s: shares([d for d in own if d[1] == s]) for s in sources}
        for s in sources:
            mine, count = p[s]
            pairs = [(sum(abs(mine[t] - p[o][0][t]) for t in kept), o) for o in sources if o != s]
            favoured = [(mine[t] - q[t], t) for t in kept if count[t] and mine[t] > q[t]]
            for part, found in (("pair", pairs), ("term", favoured)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(found, 1) if part == "pair" or r <= audit.top]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


@pytest.mark.parametrize("audit", [Audit(min_docs=1), Audit(min_docs=2, top=3), Audit(min_docs=100)])
def test_odd_rows(odd, audit):
    assert got(divergence.divergence(odd, audit)) == plain(ROWS, audit)


def test_no_rows(none):
    assert divergence.divergence(none).count() == 0


def test_many_sources_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE_SOURCES", 3)
    monkeypatch.setattr(divergence, "TILE_TERMS", 4)
    words = "one two three four five six seven eight nine ten eleven twelve Twelve".split()
    rows = [(i, " ".join(words[(i * k) % 13] for k in range(1, 1 + i % 6)), "x" if i % 3 else None, f"s{i % 10}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    audit = Audit(min_docs=3)
    assert got(divergence.divergence(df, audit)) == plain(rows, audit)


def test_ties_rank_by_item(spark):
    rows = [(i, "b a c", "x", s) for i, s in enumerate("zyx")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    found = got(divergence.divergence(df, Audit(min_docs=1)))
    assert [(r[1], r[3], r[4], r[5]) for r in found] == [("x", "y", 0, 1), ("x", "z", 0, 2), ("y", "x", 0, 1), ("y", "z", 0, 2), ("z", "x", 0, 1), ("z", "y", 0, 2)]


@pytest.mark.parametrize("size", [1, 7, 100])
def test_parts_cut_no_term(monkeypatch, size):
    monkeypatch.setattr(divergence, "PART_BYTES", size)
    for text in ("", "a", "  ", "One, two;THREE  é日本 " * 5, "x" * 300, LONG[:999]):
        assert [t.decode() for part in divergence._parts(text.encode()) for t in part] == terms(text)


def test_sums_are_the_same_if_sent_early(odd, monkeypatch):
    want = got(divergence.divergence(odd, Audit(min_docs=1)))
    monkeypatch.setattr(divergence, "HELD", 2)
    assert got(divergence.divergence(odd, Audit(min_docs=1))) == want
