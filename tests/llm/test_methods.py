"""What the methods promise, on small inputs and against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import chat, decontaminate, fingerprint, licenses, minhash, substrings
from tidelog.llm import common
from tidelog.llm.common import rolling, word_hashes


def test_rolling_hashes_depend_on_content_alone():
    (h,) = word_hashes([b"a b c a b c d"])
    r = rolling(h, 3)
    assert r[0] == r[3] and len(set(r.tolist())) == 4
    assert len(rolling(h, 8)) == 0


@pytest.mark.parametrize("part", [1, 7, 40, 1 << 19])
def test_words_hash_alike_wherever_they_stand(monkeypatch, part):
    rng = random.Random(1)
    texts = [b"", b" ", b"one", b" one\ttwo\x0bone \n", "é\u00a0x é".encode(), b"w" * 100 + b" one"]
    texts += [b"".join(rng.choice([b"a", b"b", b" ", b"\r"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    monkeypatch.setattr(common, "PART_BYTES", part)
    known = {}
    for seed in (0, 1):
        for text, hashes in zip(texts, word_hashes(texts, seed), strict=True):
            assert len(hashes) == len(text.split())
            for word, h in zip(text.split(), hashes.tolist(), strict=True):
                assert known.setdefault((seed, word), h) == h
    assert len(set(known.values())) == len(known)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for common in (40, 150, 600):
        a = rng.integers(0, 1 << 63, common + 50, dtype=np.uint64)
        b = np.concatenate([a[:common], rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
        found = minhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], len(a)), 2, 256)
        errors.append(abs((found[0] == found[1]).mean() - common / (common + 100)))
    assert max(errors) < 0.1


def _plain_signature(element, places):
    """One element's signature by the shuffle that ranks stand for."""
    out, order = [0] * places, list(range(places))
    for rank in range(places):
        with np.errstate(over="ignore"):
            drawn = int(minhash.mixed(np.array([element], np.uint64) + np.uint64((rank + 1) * minhash._GOLDEN % (1 << 64)))[0])
        pick = rank + ((drawn >> 32) * (places - rank) >> 32)
        order[rank], order[pick] = order[pick], order[rank]
        out[order[rank]] = rank << 32 | drawn & 0xFFFFFFFF
    return out


@pytest.mark.parametrize("n", [1, 3, 40])
def test_early_stopping_changes_nothing(n):
    elements = np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64)
    plain = np.min([_plain_signature(e, 32) for e in elements.tolist()], axis=0)
    found = minhash.signatures(np.concatenate([elements, elements[:1]]), np.array([0] * n + [1]), 2, 32)
    assert found[0].tolist() == plain.tolist() and found[1].tolist() == _plain_signature(int(elements[0]), 32)


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = minhash.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5))
    got = {r.id: r.component for r in found.collect()}
    assert all(got.get(x, x) == root(x) for x in parent)


def test_links_beyond_the_drawn_member_are_found(spark):
    """A chain: neighbours are alike, ends are not, whatever members buckets draw."""
    words = [f"w{i}" for i in range(260)]
    texts = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs, minhash.NearDuplicates(shingle=1, percent=80)).collect()
    assert {r.component_id for r in got} == {0}


def test_links_that_no_bucket_holds_are_found(spark):
    """Pairs at 80 % with one band, which most of them do not share."""
    texts = []
    for i in range(30):
        common = [f"c{i}x{j}" for j in range(80)]
        texts += [(2 * i + e, " ".join([*common, *(f"o{2 * i + e}x{j}" for j in range(10 + (i % 2) * e))])) for e in (0, 1)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = minhash.near_duplicates(docs, minhash.NearDuplicates(shingle=1, percent=80, bands=1, rows=6)).collect()
    # of even pairs 80 of 100 elements are common, of odd ones 80 of 101
    want = {2 * i + e: 2 * i if i % 2 == 0 else 2 * i + e for i in range(30) for e in (0, 1)}
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("percent", [30, 80, 93])
def test_alike_sets_name_a_common_cell(spark, percent):
    """Sets of all sizes, each with one that is just alike enough, or larger, or smaller."""
    rng, rows = random.Random(percent), []
    for n in [*range(1, 70), 127, 128, 300]:
        words = [f"w{rng.randrange(3000)}" for _ in range(2 * n)]
        whole = list(dict.fromkeys(words))[:n]
        fewer = whole[: -(percent * len(whole) // -100)]
        gone = (100 - percent) * len(whole) // (100 + percent)
        changed = [*whole[gone:], *(f"x{n}y{i}" for i in range(gone))]
        rows += [(3 * n + i, " ".join(x)) for i, x in enumerate((whole, fewer, changed))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    how = minhash.NearDuplicates(shingle=1, percent=percent)
    known = spark.sparkContext.broadcast(minhash.levels(docs, how))
    named = {r.id: set(r.cells) for r in minhash.cells(docs, how, known).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    for i in range(0, len(rows), 3):
        a = rows[i][0]
        for b in (a + 1, a + 2):
            assert 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
            assert named[a] & named[b]


def test_unlike_texts_do_not_meet_by_chance(spark, monkeypatch):
    """Few words give few shingles: all texts have rare ones in common with others, ever more as texts become more."""
    kept = {}

    def counted(df, name):
        out = common.saved(df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(minhash, "saved", counted)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(80)}" for _ in range(60)) for _ in range(800)]
    # copies that lost four words; one band of twelve rows leaves most of them to the exact join
    texts += [" ".join([*t.split()[:56], "own"]) for t in texts[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = minhash.near_duplicates(docs, minhash.NearDuplicates(shingle=2, bands=1, rows=12)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i if i < 800 else i - 800 for i in range(820)}
    # before there were blocks, 800 texts with 13 elements each met
    assert 0 < kept["elements"] <= 60 * 13


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9), max_size=4), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30), st.integers(1, 4))
def test_automaton(items, words, width):
    auto = decontaminate.Automaton([(str(i), x) for i, x in enumerate(items)], width)
    hit, found = set(), set()
    for number, item in enumerate(items):
        n = min(width, len(item))
        for start in range(len(item) - n + 1) if n else ():
            for at in range(len(words) - n + 1):
                if words[at : at + n] == item[start : start + n]:
                    hit |= set(range(at, at + n))
                    found.add(number)
    spans, owners = auto.hits(words)
    assert {p for a, b in spans for p in range(a, b)} == hit and owners == found
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(0, 8), st.integers(0, 40), st.integers(0, 40))
def test_a_repeated_window_has_an_anchor_in_common(block, more, left, right):
    how = substrings.Repeats(window=2 * block - 1 + more, block=block)
    rng = np.random.default_rng(left * 41 + right)
    common = rng.integers(0, 4, how.window, dtype=np.uint64)
    reference = np.concatenate([rng.integers(10, 14, left, dtype=np.uint64), common, rng.integers(10, 14, 9, dtype=np.uint64)])
    probe = np.concatenate([rng.integers(20, 24, right, dtype=np.uint64), common, rng.integers(20, 24, 7, dtype=np.uint64)])
    index = np.unique(substrings.run_anchors(reference, how)[:: how.block])
    known = set(rolling(reference, how.block)[index].tolist())
    at = np.unique(substrings.run_anchors(probe, how))
    hits = [a for a in at.tolist() if int(rolling(probe, how.block)[a]) in known]
    assert right in substrings._around(probe, hits, how).tolist() if hits else False
    shared = set(rolling(probe, how.block)[hits].tolist())
    own = [a for a in index.tolist() if int(rolling(reference, how.block)[a]) in shared]
    assert left in substrings._around(reference, own, how).tolist()


def test_alignment_follows_insertions_and_gaps():
    template = list(range(100, 130))
    words = [1, 2, *template[:10], 7, 8, *template[10:18], *template[20:], 3]
    assert licenses.align(template, words, 2) == (28, 2, 32)
    assert licenses.align(template, [], 0) == (0, 0, 0)


# -- templates ---------------------------------------------------------------


def render(template, **variables):
    return "".join(t for t, _ in chat.compile_template(template)(**variables))


def test_template_language():
    assert render("a{{ 'b' ~ (1 + 1) }}c") == "ab2c"
    assert render("{% for x in xs %}{{ loop.index }}{{ x }}{% if loop.last %}.{% else %},{% endif %}{% endfor %}", xs=["a", "b"]) == "1a,2b."
    assert render("{% for x in xs %}[{{ x }}]{% if loop.last %}.{% endif %}{% endfor %}", xs=["a", None, "b", None]) == "[a][][b][]."
    assert render("{% if a == 1 %}x{% elif a in b %}y{% endif %}", a=2, b=[2]) == "y"
    with pytest.raises(chat.TemplateError):
        render("{{ 'b' + 1 }}")
    assert render("{% set y = x | upper %}{{ y }}{{ z }}", x="q") == "Q"
    assert render("{% if not x or (y and x < 3) %}t{% else %}f{% endif %}", x=2, y=True) == "t"
    assert render("{{ m.a['b'] }}{{ m.none }}", m={"a": {"b": "deep"}}) == "deep"


def test_constants_are_folded():
    tree = chat.fold(chat.parse("a{{ 'b' | upper }}{% if 1 < 2 %}c{% else %}{{ x }}{% endif %}d{% if false %}e{% endif %}"))
    assert tree == (chat.Emit(chat.Const("aBcd")),)


@pytest.mark.parametrize("bad", ["{% for x %}{% endfor %}", "{% if a %}", "{{ a.b( }}", "{{ a | nothing }}", "{% endfor %}", "{{ }}", "{% import os %}", "{{ 'a }}"])
def test_bad_templates(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_templates_reach_no_attributes():
    for value in ("text", object(), [].append):
        with pytest.raises(chat.TemplateError):
            render("{{ x.__class__ }}", x=value)
    assert render("{{ x.__class__ }}", x={}) == ""


def test_generation_marks():
    run = chat.compile_template("u{% generation %}{{ x }}!{% endgeneration %}v")
    assert [p for p in run(x="a")] == [("u", False), ("a", True), ("!", True), ("v", False)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\<>/turn#é\n", max_size=40))
def test_escapes_are_undone(text):
    for escape in (chat.escape, chat.escape_line):
        assert chat.unescape(escape(text)) == text
    kept = [m[0] for m in chat._MARK.finditer(chat.escape(text))]
    assert not {"<turn>", "</turn>"} & set(kept)


def test_differing_branches_locate_edits(spark):
    lines = [f"line {i} of a text that has more words than eight of them in all. And a second sentence {i}." for i in range(60)]
    edited = list(lines)
    edited[7] = lines[7].replace("second", "third")
    edited[31] = "quite another line"
    added = [*lines[:20], "a line in between", *lines[20:]]
    cases = {
        "equal": ("\n".join(lines), "\n".join(lines), [], []),
        "edited": ("\n".join(edited), "\n".join(lines), [7, 31], [[2], [0]]),
        "added": ("\n".join(added), "\n".join(lines), [20], [[0]]),
        "removed": ("\n".join(lines), "\n".join(added), [], []),
        "empty": ("", "\n".join(lines), [0], [[]]),
        "null": (None, "", [], []),
    }
    df = spark.createDataFrame([(k, a, b) for k, (a, b, *_) in cases.items()], "name string, a string, b string")
    for c in ("a", "b"):
        df = fingerprint.fingerprint(df, c, f"f{c}")
    df = fingerprint.differences(df, "fa", "fb", "differs").select("name", "fa", "fb", "differs")
    for r in df.collect():
        *_, want, pieces = cases[r.name]
        assert [x.line for x in r.differs.lines] == want and [x.pieces for x in r.differs.lines] == pieces, r.name
        # few of some dozen sections
        assert (r.fa == r.fb) == (not r.differs.sections) or r.name == "removed"
        if r.name == "edited":
            assert 1 <= len(r.differs.sections) <= 4
    moved = spark.createDataFrame([("\n".join(lines[::-1]), "\n".join(lines))], "a string, b string")
    for c in ("a", "b"):
        moved = fingerprint.fingerprint(moved, c, f"f{c}")
    got = fingerprint.differences(moved, "fa", "fb", "differs").first().differs
    assert got.sections and got.lines == []


def test_edited_notices_are_found():
    """One word replaced, dropped or added, with four fifths of the template left: nine in ten are found, as what they are."""
    rng = random.Random(10)
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    names = list(licenses.TEMPLATES)
    for t, text in enumerate(licenses.TEMPLATES.values()):
        words = text.split()
        found = tried = 0
        for _ in range(60):
            at, kind = rng.randrange(len(words)), rng.choice(["replace", "drop", "add"])
            new = [*words[:at], *(["edited"] if kind != "drop" else []), *words[at + (kind != "add") :]]
            left, size = (len(word_hashes([" ".join(w).encode().translate(licenses._NORMAL)])[0]) for w in (new, words))
            if (left - (kind != "drop")) < 0.8 * size:
                continue
            tried += 1
            doc = f"some words before {' '.join(new)} and some after"
            got = scanner.scan(word_hashes([doc.encode().translate(licenses._NORMAL)])[0])
            found += any(m.template == t or m.matched == size - (kind != "add") for m in got)
        assert not tried or found >= 0.9 * tried, (names[t], found, tried)


def test_near_licenses_are_told_apart():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for t, (name, text) in enumerate(licenses.TEMPLATES.items()):
        got = scanner.scan(word_hashes([f"x y {text} z".encode().translate(licenses._NORMAL)])[0])
        assert [m.template for m in got] == [t], name
    assert scanner.scan(word_hashes([b"released under mit license"])[0])
