"""Main text of pages: markup, repeats within a host, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import extraction
from tidelog.llm.extraction import Boilerplate, article_runs, article_tokens, host_notices, read_page, repeated_places, run_owners

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style></head><body class="no-sidebar">
<header><h1>Site name</h1></header><nav><ul><li>home<li>news</ul></nav><div class="page with-header">
<main><h1>Title &amp; more</h1><article class="post"><p>One <b>two</b>&nbsp; three<br>four<p>five <span class="ad">buy</span> six
<script>if (a<b) "</p>"</script><ul><li>x<li>y</ul><aside>zz</aside><div class="share-bar">share</div><pre> a
 b</pre><table><tr><td>1<td>2<tr><td>3</table><form>sign up</form><section id="comments"><article class="comment">c1</article></section>
<footer>written by</footer></article></main></div><div class="cookieBanner">c</div><!-- <p>no --><footer>&copy; x</footer>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "Title & more\nOne two three four\nfive six\nx\ny\na b\n1\n2\n3"),
        ('<div class="post"><p>a&lt;b</p>x<5 y <b>t</div><div>other</div>', "a<b\nx<5 y t"),
        ("<article>cut here <p", "cut here"),
        ("<article><header><h2>Head</h2><p>by line</header>body</article>", "Head\nbody"),
        ('<form id="page"><article>in a form</article></form>', "in a form"),
        ("<article>a &am b &amp c &#233; &#x1F600; &unknown;</article>", "a &am b & c é 😀 &unknown;"),
        ("<article><div>one<p>two</div>three</article>", "one\ntwo\nthree"),
        ('<article><p hidden>no</p><p style="display: none">no</p><p title="a > b">yes</p></article>', "yes"),
        ("<article><script>x", ""),
        ("<article>a<!-- b", "a"),
        ("<article><p>a</article><aside><article>teaser</article></aside>", "a"),
        ("<article>one</article><article>two</article>", "one\ntwo"),
    ],
)
def test_markup_places_text(page, text):
    assert (read_page(page)[0] or "") == text


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000, "<a " * 200_000, '<p title="x' * 100_000, "<!--" * 100_000, "</p>" * 100_000])
def test_malformed_pages_end_in_time(page):
    read_page(page)


def brute(streams, groups, least):
    def runs(s):
        return [tuple(s[p : p + least]) for p in range(len(s) - least + 1)]

    return [
        [p for p, r in enumerate(runs(s)) if any(j != i and groups[j] == groups[i] and r in runs(o) for j, o in enumerate(streams))]
        for i, s in enumerate(streams)
    ]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=15), st.integers(0, 1)), max_size=6), st.integers(1, 7))
def test_suffix_array(rows, least):
    streams, groups = [np.array(s, np.uint64) for s, _ in rows], [g for _, g in rows]
    assert [list(x) for x in repeated_places(streams, groups, least)] == brute([s for s, _ in rows], groups, least)


MENU = "<div>Home News Sport Weather</div><div>About this site and contact us here</div>"


def pages():
    """Pages that mark no article: of one host many, with a copy, and others."""
    rows = [(i, "https://a.example/p", f"{MENU}<p>Story {i} is like no other one</p><p>words {i * 7} of {i} own</p>") for i in range(8)]
    rows.append((8, "http://u@A.example:80/q?x", rows[3][2]))
    rows += [(9, "https://b.example/", rows[0][2]), (10, None, "plain text"), (11, None, None), (None, "x", ""), (12, "https://a.example", PAGE)]
    rows.append((12, "https://a.example", PAGE))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame(pages(), "page_id bigint, url string, html string")
    return df.select("*", *(F.lit("x").alias(n) for n in ("text", "host", "stream", "digest", "blocks", "at", "n_chars", "chunk"))).repartition(3).cache()


@pytest.mark.parametrize("chunk", [1, 40, 50_000])
def test_repeats_of_a_host_go(frame, chunk):
    out = extraction.extract_text(frame, Boilerplate(chunk=chunk)).collect()
    assert len(out) == len(pages())
    text = {r.page_id: r.text for r in out}
    for i in range(8):
        assert text[i] == f"Story {i} is like no other one\nwords {i * 7} of {i} own"
    # a copy has what its original has; one page of a host has all of its text
    assert text[8] == text[3]
    assert text[9].startswith("Home News Sport Weather\nAbout")
    assert (text[10], text[11], text[None]) == ("plain text", "", "")
    assert text[12].startswith("Title & more") and all(r.n_chars == len(r.text) for r in out)


def test_no_pages(frame):
    assert extraction.extract_text(frame.limit(0)).count() == 0


def test_text_keys(spark):
    df = spark.createDataFrame([(None, None, "<article>a"), ("k", "u", None)], "page_id string, url string, html string")
    assert {(r.page_id, r.text) for r in extraction.extract_text(df).collect()} == {(None, "a"), ("k", "")}


def test_a_long_page(spark):
    words = [f"w{i}" for i in range(300_000)]
    df = spark.createDataFrame([(1, "https://a", "<p>" + " ".join(words)), (2, "https://a", "<p>" + " ".join(words[::-1]))], "page_id bigint, url string, html string")
    assert {r.n_chars for r in extraction.extract_text(df).collect()} == {len(" ".join(words))}


def test_articles_keep_what_their_host_repeats(spark):
    """Lines of several articles stay, though adverts or footers of the host say them, too."""
    line = "Our readers say that nobody had seen the letter before that night"
    more = f'<div class="ad">{line}</div>', f"<footer>{line}</footer>", ""
    rows = [(i, "https://a.example/p", f"<article><h1>Head {i}</h1><p>{line}</p><p>own words {i}</p></article>{m}") for i, m in enumerate(more)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in extraction.extract_text(df).collect()} == {i: f"Head {i}\n{line}\nown words {i}" for i in range(3)}


NOTICE = "Write to the editor of this paper if you have seen a mistake"
SHARED = "The old lighthouse stood above the harbour and nobody had lit it for years"


def articles():
    """Articles of a host that says one notice in most of them, and of hosts that are no evidence."""
    rows = []
    for i in range(40):
        own = "".join(f"<p>{' '.join(f'w{i}x{j}y{k}' for k in range(12))}</p>" for j in range(3))
        notice = f"<div>{NOTICE}</div>" if i % 20 else ""
        # a line of three in four articles is text
        shared = f"<p>{SHARED}</p>" if i % 4 else ""
        rows.append((i, "https://a.example/p", f"<article><h1>Head {i}</h1>{own}{shared}{notice}</article>"))
        # nine different articles only, and a copy
        if i < 10:
            rows.append((100 + i, "https://few.example/p", f"<article><p>own words of {i % 9}</p><div>{NOTICE}</div><p>{own if i % 9 else ''}</p></article>"))
        # articles that are copies but for a word
        rows.append((200 + i, "https://copies.example/p", f"<article><h1>Head {i}</h1><p>{SHARED}</p><p>{NOTICE}</p></article>"))
    return rows + rows[:5]


def marked_text(page, *without):
    return "\n".join(line for line in read_page(page)[0].split("\n") if line not in without)


@pytest.mark.parametrize("how", [Boilerplate(), Boilerplate(chunk=1, articles=1), Boilerplate(chunk=300, articles=4)])
def test_notices_of_marked_articles_go(spark, how):
    df = spark.createDataFrame(articles(), "page_id bigint, url string, html string").repartition(3)
    out = extraction.extract_text(df, how).collect()
    assert len(out) == len(articles())
    text = {r.page_id: r.text for r in out}
    for i, _, page in articles():
        assert text[i] == marked_text(page, *([NOTICE] if i < 100 else []))


@settings(deadline=None, max_examples=60)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=15), st.integers(0, 1)), max_size=6), st.integers(1, 7))
def test_owners_of_runs(rows, least):
    streams, groups = [np.array(s, np.uint64) for s, _ in rows], [g for _, g in rows]
    runs = [[tuple(s[p : p + least]) for p in range(len(s) - least + 1)] for s, _ in rows]
    plain = [[sum(r in other and groups[j] == g for j, other in enumerate(runs)) for r in own] for own, g in zip(runs, groups)]
    assert [list(x) for x in run_owners(streams, groups, least)] == plain


def test_notices_against_plain_counts(spark):
    """Small chunks name the same runs as counts over whole hosts."""
    rng = np.random.default_rng(5)
    lines = [" ".join(rng.choice(list("abcd"), 6)) for _ in range(8)]
    rows = []
    for i in range(120):
        host = f"h{i % 3}"
        text = [lines[j] for j in range(8) if rng.random() < 0.97 - 0.04 * j] + [f"own {i}"] * (i % 7 > 0)
        rows.append((host, str(i % 110).encode(), "\n".join(text), ["p"] * len(text), sum(len(t.split()) + 1 for t in text)))
    rows = [rows[int(r[1])] for r in rows]
    different = {(h, a): set(article_runs(article_tokens(t, g)[0], 4).tolist()) for h, a, t, g, _ in rows}
    plain = {}
    for host in {h for h, _ in different}:
        own = [runs for (h, _), runs in different.items() if h == host]
        plain[host] = {r for runs in own for r in runs if 10 * sum(r in x for x in own) >= 8 * len(own)}
    df = spark.createDataFrame(rows, "host string, article binary, text string, tags array<string>, tokens bigint").repartition(4)
    for how in (Boilerplate(least=4, of_ten=8), Boilerplate(least=4, of_ten=8, chunk=20, articles=1)):
        found = {r.host: set(r.runs) for r in host_notices(df, how).collect()}
        assert found == {h: r for h, r in plain.items() if r} and found
