"""The main text of web pages: the article, without what surrounds it.

A page is read into blocks.  Its markup places most of them: inside an article (or the
page's main part), or in a menu, a footer, a form and the like, which are never text.
Some pages mark no article.  Of these, the blocks that nothing else places are told from
boilerplate by what a host's pages share: the token streams of all blocks outside of
articles are concatenated, a suffix array finds the runs of ``least`` tokens or more that
occur in different pages of the host, and blocks that such runs cover altogether go.

Articles go through suffix arrays, too, apart from what is outside of them: a block of an
article is a notice, though no name says so, if runs cover it altogether that nearly all
different articles of its host have.

Repeats alone would be wrong in both directions: a host with one page has none, and an
article that two pages carry is text.  So the markup is heard after the arrays: what it
puts outside goes, and what it marks stays but for notices, or altogether if notices would
be half of it (the articles are copies then).  Pages with equal streams count as one.

A host is dealt out in chunks of bounded size, each with a suffix array of its own, sorted
to the depth that coverage asks for; what chunks of one host have in common is found by
the hashes of their windows.  What nearly all articles of a host have, nearly all of some
chunk have, so chunks name the runs that are then counted in every article.  Any division
into chunks gives the same text.

Null, empty and malformed html give what text they have, or an empty one.  Rows stay,
repeated ones, too; a null url is a host of its own.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import mixed, rolling, rows_of, saved

# Elements and names by what they say of their text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
CONTAINERS = frozenset(
    "article aside blockquote body button center dialog div dl details fieldset figure footer form head header hgroup html main menu nav "
    "noscript object ol section select svg table template ul canvas audio video".split()
)
BLOCKS = CONTAINERS | frozenset(
    "address caption dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li optgroup option p pre summary tbody td tfoot th thead tr".split()
) - frozenset("button svg object canvas audio video".split())
NEVER = frozenset(
    "nav footer aside menu form button select dialog template noscript iframe object canvas audio video svg fieldset head".split()
)
NEVER_NAMES = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer sidebar sidebars aside comment comments commentlist disqus respond reply replies "
    "related recommended teaser teasers ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored "
    "promo promos promotion cookie cookies cookiebar consent gdpr widget widgets hidden".split()
)
UNLESS_AROUND_NAMES = frozenset(
    "header masthead banner notice notices notification notifications alert alerts popup modal overlay newsletter subscribe "
    "subscription signup login form search share sharing social toolbar pagination pager skip copyright legal disclaimer topbar".split()
)
ARTICLE_NAMES = frozenset("comment comments reply related teaser promo ad advert sponsored".split())
MAIN_NAMES = frozenset(
    "article article-body article-content articlebody post post-body post-content entry entry-content story story-body content "
    "main main-content page-content".split()
)
ROLES = {"navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside", "search": "form", "dialog": "dialog"}
# an element of the first kind ends open ones of the others
ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SAYS = re.compile(r"\b(?:class|id|role|itemprop|hidden|style|aria-hidden)\b", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_OPEN, _SOFT, _HARD = 0, 1, 2
_NOWHERE, _MAIN, _ARTICLE = 0, 1, 2

HOST = r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


@dataclass(frozen=True)
class Boilerplate:
    """``least``: tokens of a repeat, tags among them; ``chunk``: tokens in one suffix array, about.

    An array over articles has not fewer than about ``articles`` of them.  Their run is a
    notice's if at least ``of_ten`` tenths of a host's different articles have it, and these
    are ``pages`` or more.
    """

    least: int = 8
    chunk: int = 50_000
    articles: int = 32
    of_ten: int = 9
    pages: int = 10


@dataclass
class _State:
    out: int = _OPEN
    zone: int = _NOWHERE
    header: bool = False
    heading: bool = False


def _named(values: dict[str, str]) -> tuple[set[str], set[str]]:
    """Words of an element's classes and id, and these names as they are."""
    names = values.get("class", "").split() + values.get("id", "").split()
    words: set[str] = set()
    for name in names:
        parts = [w.lower() for w in _WORDS.findall(name)]
        # with-sidebar, no-ads and the like tell of something else
        if not {"with", "without", "has", "no"} & set(parts):
            words.update(parts)
    return words, {n.lower().replace("_", "-") for n in names}


def _entered(state: _State, name: str, attributes: str) -> _State:
    """What an element's own tag makes of what is around it."""
    values = {}
    if _SAYS.search(attributes):
        for key, value in _ATTRIBUTE.findall(attributes):
            values.setdefault(key.lower(), entities.unescape(value.strip("\"'")))
    role = values.get("role", "").lower()
    element = ROLES.get(role, name) if name not in ("article", "main", "body", "html") else name
    words, whole = _named(values)
    out, zone = state.out, state.zone
    header = state.header
    article = element == "article" or role == "article" or "articlebody" in values.get("itemprop", "").lower()
    main = element == "main" or role == "main"
    if article and words & ARTICLE_NAMES:
        out = _HARD
    elif article or main:
        if out < _HARD:
            out, zone, header = _OPEN, max(zone, _ARTICLE if article else _MAIN), False
    elif name not in ("body", "html"):
        if element in NEVER and element != "form" or "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(values.get("style", "")):
            out = _HARD
        elif words & NEVER_NAMES and not whole & MAIN_NAMES:
            out = _HARD
        elif element == "form":
            out = max(out, _SOFT)
        elif element == "header" or (words & UNLESS_AROUND_NAMES and not whole & MAIN_NAMES):
            # an article's header has its title
            if zone and (element == "header" or "header" in words):
                header = True
            else:
                out = max(out, _SOFT)
        elif whole & MAIN_NAMES and out < _HARD:
            out, zone = _OPEN, max(zone, _MAIN)
    heading = state.heading or name in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup")
    return _State(out, zone, header, heading)


class _Reader:
    """Blocks of a page with what the markup says of them."""

    def __init__(self):
        self.states = [_State()]
        self.names = [""]
        # open elements by name: containers, and others since each container
        self.containers: dict[str, int] = {}
        self.others: list[dict[str, int]] = [{}]
        self.pieces: list[str] = []
        self.piece_state = self.states[0]
        self.tag = ""
        self.blocks: list[tuple[str, str, _State]] = []

    def text(self, raw: str) -> None:
        state = self.states[-1]
        if self.pieces and state.out >= _SOFT > self.piece_state.out:
            # a span that is left out, inside of a block
            return
        if self.pieces and self.piece_state.out >= _SOFT > state.out:
            self.flush()
        if not self.pieces:
            self.piece_state = state
            self.tag = self.names[-1]
        self.pieces.append(entities.unescape(raw) if "&" in raw else raw)

    def flush(self) -> None:
        if self.pieces:
            block = " ".join("".join(self.pieces).split())
            if block:
                self.blocks.append((block, self.tag, self.piece_state))
            self.pieces = []

    def pop(self) -> str:
        name = self.names.pop()
        self.states.pop()
        if name in CONTAINERS:
            self.others.pop()
            self.containers[name] -= 1
        else:
            self.others[-1][name] -= 1
        return name

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            ended = [n for n in ENDS.get(name, ("p",)) if self.others[-1].get(n)]
            while ended:
                gone = self.pop()
                ended = [n for n in ended if self.others[-1].get(n)] if gone in ended else ended
        if name in VOID:
            if name == "br" and self.pieces:
                self.pieces.append(" ")
            return
        self.states.append(_entered(self.states[-1], name, attributes) if attributes or name in BLOCKS or name in NEVER else self.states[-1])
        self.names.append(name)
        if name in CONTAINERS:
            self.containers[name] = self.containers.get(name, 0) + 1
            self.others.append({})
        else:
            self.others[-1][name] = self.others[-1].get(name, 0) + 1

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        if name in CONTAINERS:
            if self.containers.get(name):
                while self.pop() != name:
                    pass
        elif self.others[-1].get(name):
            while self.pop() != name:
                pass


def page_blocks(page: str) -> list[tuple[str, str, _State]]:
    """Blocks in page order: text, element and state."""
    reader = _Reader()
    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag != at:
            reader.text(page[at : tag if tag >= 0 else size])
        if tag < 0:
            break
        follows = page[tag + 1 : tag + 2]
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 2)
            at = end + 3 if end >= 0 else size
        elif follows in ("!", "?") or (follows == "/" and not page[tag + 2 : tag + 3].isalpha()):
            end = page.find(">", tag)
            at = end + 1 if end >= 0 else size
        elif not (follows == "/" or (follows.isascii() and follows.isalpha())):
            reader.text("<")
            at = tag + 1
        else:
            found = _TAG.match(page, tag) or _LOOSE_TAG.match(page, tag)
            if not found:
                # a tag that the end of the page cuts
                break
            at = found.end()
            name = found[2].lower()
            if found[1]:
                reader.end(name)
            elif name in RAW and not found[3].endswith("/"):
                closing = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
                end = page.find(">", closing.end()) if closing else -1
                at = end + 1 if end >= 0 else size
                if name == "iframe" or name == "textarea":
                    reader.flush()
            else:
                reader.start(name, found[3])
    reader.flush()
    return reader.blocks


def _is_out(state: _State) -> bool:
    return state.out >= _SOFT or (state.header and not state.heading)


def _token(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def read_page(page: str | None) -> tuple[str | None, list[str], list[str], list[bool], np.ndarray, np.ndarray]:
    """A page's text if the markup places it, with the elements of its lines, and the blocks outside.

    Of these: texts, whether nothing places them, tokens in a row, and how many each has.
    """
    blocks = page_blocks(page or "")
    zone = max((s.zone for _, _, s in blocks if not _is_out(s)), default=_NOWHERE)
    # a main part that has the title beside the article
    titled = zone < _ARTICLE or any(s.zone == _ARTICLE and s.heading for _, _, s in blocks)
    inside, tags, texts, free, tokens, sizes = [], [], [], [], [], []
    for text, tag, state in blocks:
        if zone and not _is_out(state) and (state.zone == zone or (state.zone == _MAIN and tag == "h1" and not titled)):
            inside.append(text)
            tags.append(tag)
            continue
        words = text.split(" ")
        texts.append(text)
        free.append(not zone and not _is_out(state))
        tokens.append(_token(f"<{tag}>"))
        tokens += map(_token, words)
        sizes.append(1 + len(words))
    return ("\n".join(inside) if zone else None), tags, texts, free, np.array(tokens, np.uint64), np.array(sizes, np.int64)


def article_tokens(text: str, tags: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """An article's tokens in a row, and how many each line has."""
    tokens, sizes = [], []
    for tag, line in zip(tags, text.split("\n")):
        words = line.split(" ")
        tokens.append(_token(f"<{tag}>"))
        tokens += map(_token, words)
        sizes.append(1 + len(words))
    return np.array(tokens, np.uint64), np.array(sizes, np.int64)


def _read(kind: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, hosts, pages in rows_of(batches, "page_id", "url", "host", "html"):
            out = []
            for page in pages:
                text, tags, texts, free, tokens, sizes = read_page(page)
                blocks = [] if text is not None else [{"text": t, "free": f, "tokens": int(n)} for t, f, n in zip(texts, free, sizes)]
                stream = tokens.tobytes()
                article = xxhash.xxh3_128_digest("\n".join([text, *tags])) if tags else None
                words = text.count(" ") + 2 * len(tags) if tags else 0
                out.append((text, blocks, stream, xxhash.xxh3_128_digest(stream), tags, article, words))
            texts, blocks, streams, digests, tags, articles, tokens = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kind),
                    pa.array(urls, pa.string()),
                    pa.array(hosts, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(blocks, _BLOCKS),
                    pa.array(streams, pa.binary()),
                    pa.array(digests, pa.binary()),
                    pa.array(tags, pa.list_(pa.string())),
                    pa.array(articles, pa.binary()),
                    pa.array(tokens, pa.int64()),
                ],
                names=["page_id", "url", "host", "text", "blocks", "stream", "digest", "tags", "article", "tokens"],
            )

    return read


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("free", pa.bool_()), ("tokens", pa.int64())]))


def run_owners(streams: list[np.ndarray], groups: list[int], least: int) -> list[np.ndarray]:
    """How many streams of its group have the run of ``least`` tokens that starts at each place, for each stream.

    A suffix array over all streams, by prefix doubling up to depth ``least``: suffixes
    that agree so far are neighbours of equal rank.  A place too near the end has none.
    """
    sizes = np.array([len(s) for s in streams], np.int64)
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    total = int((sizes + 1).sum())
    _, ranks = np.unique(np.concatenate(streams) if len(streams) else np.empty(0, np.uint64), return_inverse=True)
    owner = np.repeat(np.arange(len(streams)), sizes + 1)
    order = np.full(total, -1, np.int64)
    inside = np.ones(total, bool)
    inside[starts + sizes] = False
    order[inside] = ranks
    # ends are all different, so no run goes past one
    order[~inside] = (ranks.max(initial=-1) + 1) + np.arange(len(streams))
    depth = 1
    while depth < least:
        step = min(depth, least - depth)
        behind = np.zeros(total, np.int64)
        behind[: max(total - step, 0)] = order[step:] + 1
        _, order = np.unique(order * (int(order.max(initial=0)) + 2) + behind, return_inverse=True)
        depth += step
    # positions by rank: the suffix array; in it, the streams of a group that share a rank
    group = np.array(groups, np.int64)[owner] if total else owner
    suffixes = np.lexsort((owner, group, order))
    new = np.ones(total, bool)
    new[1:] = (np.diff(order[suffixes]) != 0) | (np.diff(group[suffixes]) != 0)
    first = np.flatnonzero(new)
    another = new.copy()
    another[1:] |= np.diff(owner[suffixes]) != 0
    count = np.zeros(total, np.int64)
    if total:
        count[suffixes] = np.repeat(np.add.reduceat(another.astype(np.int64), first), np.diff(np.append(first, total)))
    return [count[s : s + max(n - least + 1, 0)] for s, n in zip(starts, sizes)]


def repeated_places(streams: list[np.ndarray], groups: list[int], least: int) -> list[np.ndarray]:
    """Where runs of ``least`` tokens start that two streams of a group have, for each stream."""
    return [np.flatnonzero(count > 1) for count in run_owners(streams, groups, least)]


def _found(least: int, chunk: int):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places of repeats, for rows sorted by host and chunk; several small chunks are handled at once."""
        held: list[tuple] = []
        size = 0

        def handled():
            numbers: dict[tuple, int] = {}
            groups = [numbers.setdefault((h, c), len(numbers)) for h, c, _, _ in held]
            found = repeated_places([t for *_, t in held], groups, least)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, *_ in held], pa.string()),
                    pa.array([d for _, _, d, _ in held], pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["host", "digest", "at"],
            )

        for hosts, chunks, digests, streams in rows_of(batches, "host", "chunk", "digest", "stream"):
            for row in zip(hosts, chunks, digests, streams):
                if size > chunk and row[:2] != held[-1][:2]:
                    yield handled()
                    held, size = [], 0
                held.append((*row[:3], np.frombuffer(row[3], np.uint64)))
                size += len(held[-1][3])
        if held:
            yield handled()

    return places


def _windows(least: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two hashes of every run of ``least`` tokens."""
        for hosts, chunks, digests, streams in rows_of(batches, "host", "chunk", "digest", "stream"):
            for host, chunk, digest, stream in zip(hosts, chunks, digests, streams):
                tokens = np.frombuffer(stream, np.uint64)
                a, b = rolling(tokens, least), rolling(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)), least)
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([host] * n, pa.string()),
                        pa.array([chunk] * n, pa.int32()),
                        pa.array([digest] * n, pa.binary()),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.array(np.arange(n)),
                    ],
                    names=["host", "chunk", "digest", "a", "b", "place"],
                )

    return windows


def host_repeats(streams: DataFrame, how: Boilerplate) -> DataFrame:
    """host, digest, and ``at``: where runs start that another stream of the host has.

    ``streams`` has different (host, digest) with their ``stream`` of tokens.
    """
    hosts = streams.groupBy("host").agg(F.ceil(F.sum(F.octet_length("stream")) / (8 * how.chunk)).cast("int").alias("chunks"))
    hosts = hosts.withColumnRenamed("host", "h_host")
    dealt = streams.join(hosts, F.col("host") == F.col("h_host")).drop("h_host")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("digest"), F.greatest("chunks", F.lit(1))).cast("int"))
    sorted_ = dealt.select("host", "chunk", "digest", "stream").repartition("host", "chunk").sortWithinPartitions("host", "chunk", "digest")
    within = sorted_.mapInArrow(_found(how.least, how.chunk), "host string, digest binary, at array<bigint>")
    large = dealt.filter("chunks > 1").select("host", "chunk", "digest", "stream")
    windows = large.mapInArrow(_windows(how.least), "host string, chunk int, digest binary, a bigint, b bigint, place bigint")
    across = windows.groupBy("host", "a", "b").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
    across = across.filter("first < last").select(*(F.col(c).alias(f"x_{c}") for c in ("host", "a", "b")))
    on = (F.col("host") == F.col("x_host")) & (F.col("a") == F.col("x_a")) & (F.col("b") == F.col("x_b"))
    # a stream's places are at most its tokens
    placed = windows.join(across, on, "left_semi").groupBy("host", "digest").agg(F.collect_list("place").alias("at"))
    return within.unionByName(placed).groupBy("host", "digest").agg(F.flatten(F.collect_list("at")).alias("at"))


def _covered(at: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Which blocks of ``sizes`` tokens the runs that start at the places ``at`` cover altogether."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + least, -1)
    covered = np.cumsum(edges[:total]) > 0
    return np.array([covered[e - n : e].all() for e, n in zip(ends, sizes)], bool)


def _kept(least: int, kind: pa.DataType):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, blocks, places in rows_of(batches, "page_id", "url", "blocks", "at"):
            texts = []
            for page, at in zip(blocks, places):
                gone = _covered(np.unique(np.array(at or [], np.int64)), np.array([b["tokens"] for b in page], np.int64), least)
                unique = [b["text"] for b, g in zip(page, gone) if b["free"] and not g]
                texts.append("\n".join(unique))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return kept


def article_runs(tokens: np.ndarray, least: int) -> np.ndarray:
    """Hashes of all runs of ``least`` tokens; few are ever sought, so 64 bits tell them apart."""
    return rolling(mixed(tokens.astype(np.uint64)), least).view(np.int64)


def _short(tokens: np.ndarray) -> np.ndarray:
    """A part of each token.  Equal runs stay equal; different ones that become so are told apart when they are counted."""
    return tokens.astype(np.uint16)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Articles' short tokens, packed; of those that a task meets again mostly the first."""
    seen: set[tuple] = set()
    for hosts, articles, texts, tags in rows_of(batches, "host", "article", "text", "tags"):
        rows = []
        for key in zip(hosts, articles, texts, tags):
            if key[:2] in seen:
                continue
            if len(seen) >= 100_000:
                seen.clear()
            seen.add(key[:2])
            rows.append((*key[:2], zlib.compress(_short(article_tokens(*key[2:])[0]).tobytes(), 1)))
        if rows:
            hosts, articles, streams = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(articles, pa.binary()), pa.array(streams, pa.binary())], names=["host", "article", "stream"]
            )


def _of_hosts(found: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    """Rows of a host and a run, without repeats."""
    runs = [np.unique(np.concatenate(r)) for r in found.values()]
    hosts = [h for h, r in zip(found, runs) for _ in range(len(r))]
    return pa.RecordBatch.from_arrays(
        [pa.array(hosts, pa.string()), pa.array(np.concatenate(runs) if runs else [], pa.int64())], names=["host", "run"]
    )


def _common(how: Boilerplate):
    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of short tokens that nearly all articles of a chunk have, for rows sorted by host, chunk and article."""
        held: list[tuple] = []
        size = 0

        def handled():
            numbers: dict[tuple, int] = {}
            groups = [numbers.setdefault(row[:2], len(numbers)) for row in held]
            articles = np.bincount(groups)
            streams = [row[3].astype(np.uint64) for row in held]
            found: dict[str, list] = {}
            for row, g, count in zip(held, groups, run_owners(streams, groups, how.least)):
                common = count * 10 >= how.of_ten * articles[g]
                if common.any():
                    found.setdefault(row[0], []).append(article_runs(row[3], how.least)[common])
            return _of_hosts(found)

        for rows in rows_of(batches, "host", "chunk", "article", "stream"):
            for row in zip(*rows):
                if held and row[:3] == held[-1][:3]:
                    continue
                if size > how.chunk and row[:2] != held[-1][:2]:
                    yield handled()
                    held, size = [], 0
                held.append((*row[:3], np.frombuffer(zlib.decompress(row[3]), np.uint16)))
                size += len(held[-1][3])
        if held:
            yield handled()

    return common


def _whole(least: int):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Articles' runs whose short tokens are among their host's ``runs``."""
        for rows in rows_of(batches, "host", "text", "tags", "runs"):
            found: dict[str, list] = {}
            for host, text, tags, runs in zip(*rows):
                tokens = article_tokens(text, tags)[0]
                at = np.isin(article_runs(_short(tokens), least), np.array(runs, np.int64))
                found.setdefault(host, []).append(article_runs(tokens, least)[at])
            yield _of_hosts(found)

    return whole


def _lacked(least: int):
    def lacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Which of its host's ``runs`` each article has not."""
        for *keys, texts, tags, runs in rows_of(batches, "host", "article", "text", "tags", "runs"):
            lacks = [np.setdiff1d(np.array(r, np.int64), article_runs(article_tokens(*page)[0], least)) for *page, r in zip(texts, tags, runs)]
            kinds = pa.string(), pa.binary(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip((*keys, lacks), kinds)], names=["host", "article", "lacks"])

    return lacked


def _listed(runs: DataFrame, name: str) -> DataFrame:
    return runs.groupBy("host").agg(F.collect_list("run").alias("runs")).withColumnRenamed("host", name)


def host_notices(articles: DataFrame, how: Boilerplate) -> DataFrame:
    """host, and ``runs``: hashes of the runs that nearly all different articles of the host have.

    ``articles`` has host, article (a digest), text, tags and tokens.
    """
    hosts = articles.select("host", "article", "tokens").distinct().groupBy("host").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    chunks = F.least(F.ceil(F.col("tokens") / how.chunk), F.floor(F.col("n") / how.articles))
    hosts = hosts.filter(F.col("n") >= how.pages).select(F.col("host").alias("h_host"), "n", F.greatest(chunks, F.lit(1)).cast("int").alias("chunks"))
    hosts = saved(hosts, "hosts")
    on = F.col("host") == F.col("h_host")
    streams = articles.select("host", "article", "text", "tags").mapInArrow(_streams, "host string, article binary, stream binary")
    dealt = streams.join(hosts, on).withColumn("chunk", F.pmod(F.xxhash64("article"), "chunks").cast("int"))
    sorted_ = dealt.select("host", "chunk", "article", "stream").repartition("host", "chunk").sortWithinPartitions("host", "chunk", "article")
    named = saved(sorted_.mapInArrow(_common(how), "host string, run bigint").distinct(), "runs")
    met = articles.join(_listed(named, "r_host"), F.col("host") == F.col("r_host")).select("host", "text", "tags", "runs")
    whole = saved(met.mapInArrow(_whole(how.least), "host string, run bigint").distinct(), "whole")
    met = articles.join(_listed(whole, "w_host"), F.col("host") == F.col("w_host")).select("host", "article", "text", "tags", "runs")
    # what an article lacks is less than what it has; copies count once
    lacked = met.mapInArrow(_lacked(how.least), "host string, article binary, lacks array<bigint>").distinct()
    lacked = lacked.select(F.col("host").alias("l_host"), F.explode("lacks").alias("l_run")).groupBy("l_host", "l_run").agg(F.count("*").alias("lacking"))
    counted = whole.join(hosts, on).join(lacked, (F.col("host") == F.col("l_host")) & (F.col("run") == F.col("l_run")), "left")
    carriers = F.col("n") - F.coalesce("lacking", F.lit(0))
    return counted.filter(carriers * 10 >= F.col("n") * how.of_ten).groupBy("host").agg(F.collect_list("run").alias("runs"))


def without_notices(text: str, tags: list[str], runs: list[int], least: int) -> str:
    """An article without the lines that a host's ``runs`` cover, if more than half of it is left."""
    tokens, sizes = article_tokens(text, tags)
    gone = _covered(np.flatnonzero(np.isin(article_runs(tokens, least), np.array(runs, np.int64))), sizes, least)
    if 2 * int(sizes[gone].sum()) >= int(sizes.sum()):
        return text
    return "\n".join(line for line, g in zip(text.split("\n"), gone) if not g)


def _own(least: int, kind: pa.DataType):
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, *rows in rows_of(batches, "page_id", "url", "text", "tags", "runs"):
            texts = [without_notices(*row, least) for row in zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return own


def extract_text(pages: DataFrame, how: Boilerplate = Boilerplate()) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages."""
    kind = pages.schema["page_id"].dataType.simpleString()
    kind = kind if kind == "string" else "bigint"
    id_type = pa.string() if kind == "string" else pa.int64()
    host = F.regexp_extract(F.lower(F.coalesce(pages["url"], F.lit(""))), HOST, 1).alias("host")
    read = pages.select(pages["page_id"].cast(kind).alias("page_id"), pages["url"].alias("url"), host, pages["html"].alias("html"))
    schema = f"page_id {kind}, url string, host string, text string, blocks array<struct<text string, free boolean, tokens bigint>>, stream binary, digest binary, tags array<string>, article binary, tokens bigint"
    read = saved(read.mapInArrow(_read(id_type), schema), "pages", compression="zstd")
    articles = read.filter("article is not null").select("host", "article", "text", "tags", "tokens")
    notices = saved(host_notices(articles, how), "notices").withColumnRenamed("host", "n_host")
    marked = read.filter("text is not null").select("page_id", "url", "host", "text", "tags")
    on = F.col("host") == F.col("n_host")
    placed = marked.join(notices, on, "left_anti").select("page_id", "url", "text")
    # a page without an article's lines has no notices either
    cleared = marked.join(notices, on).select("page_id", "url", "text", "tags", "runs")
    cleared = cleared.mapInArrow(_own(how.least, id_type), f"page_id {kind}, url string, text string")
    streams = read.filter("octet_length(stream) > 0").groupBy("host", "digest").agg(F.any_value("stream").alias("stream"))
    repeats = host_repeats(saved(streams, "streams"), how)
    repeats = repeats.select(F.col("host").alias("r_host"), F.col("digest").alias("r_digest"), "at")
    open_ = read.filter("text is null").select("page_id", "url", "host", "digest", "blocks")
    met = open_.join(repeats, (F.col("host") == F.col("r_host")) & (F.col("digest") == F.col("r_digest")), "left")
    rest = met.select("page_id", "url", "blocks", "at").mapInArrow(_kept(how.least, id_type), f"page_id {kind}, url string, text string")
    return placed.unionByName(cleared).unionByName(rest).withColumn("n_chars", F.length("text").cast("bigint"))
