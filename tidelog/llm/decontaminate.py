"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are normalised to words: A-Z in lower case, every other ASCII character that
is no digit or letter taken for a space.  A document's words are streamed through
the automaton, which tells at each word how many of the last words occur together
in some item.  A *window* is ``width`` consecutive words of an item, or a shorter
item whole; every word inside an occurrence of a window is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import packed, rows_of, saved, text_bytes, unused, with_text

_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")

# words of items in one automaton; more items make more automata
BLOCK_WORDS = 100_000


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """Suffix automaton of several word sequences.

    ``windows`` are found with ``hits``.  States are numbers; state 0 is the empty
    sequence.  ``owners[s]`` are the items with a full-width window that ends in
    state ``s``, ``whole[s]`` those shorter items that end there.
    """

    def __init__(self, items: Sequence[tuple[str, Sequence[bytes]]], width: int):
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.next)
        self.owners: list[set[int] | None] = [None] * n
        self.whole: list[list[int] | None] = [None] * n
        self.names = [name for name, _ in items]
        for number, (_, words) in enumerate(items):
            self._own(number, words)
        # the nearest state, by suffix links, at which a short item ends
        self.short = [-1] * n
        for s in sorted(range(1, n), key=self.length.__getitem__):
            self.short[s] = s if self.whole[s] else self.short[self.link[s]]

    def _state(self, length: int, following: dict[bytes, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """The state for the longest sequence of p, then w; q is cut in two if it holds longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        half = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = half
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = half
            p = self.link[p]
        return half

    def _extend(self, last: int, w: bytes) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return self._split(last, w, known)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def _own(self, number: int, words: Sequence[bytes]) -> None:
        s = length = 0
        for w in words:
            s, length = self.next[s][w], length + 1
            if length >= self.width:
                window = self._window(s)
                if self.owners[window] is None:
                    self.owners[window] = set()
                self.owners[window].add(number)
        if 0 < len(words) < self.width:
            if self.whole[s] is None:
                self.whole[s] = []
            self.whole[s].append(number)

    def _window(self, s: int) -> int:
        """The suffix state that holds the last ``width`` words."""
        while self.length[self.link[s]] >= self.width:
            s = self.link[s]
        return s

    def hits(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of words inside windows, in order and apart, and the items they are of."""
        spans: list[list[int]] = []
        found: set[int] = set()
        seen: set[int] = set()
        following, link, length, width, short = self.next, self.link, self.length, self.width, self.short
        s = matched = 0
        for at, w in enumerate(words, 1):
            n = following[s].get(w)
            if n is None:
                while n is None and s:
                    s = link[s]
                    n = following[s].get(w)
                if n is None:
                    matched = 0
                    continue
                matched = length[s]
            s = n
            matched += 1
            if matched >= width:
                reach = width
                window = self._window(s)
                if window not in seen:
                    seen.add(window)
                    found |= self.owners[window]
            else:
                reach = 0
            t = short[s]
            if t >= 0:
                # of a state's sequences only the longest is an item; it may exceed what matched
                if t == s and length[s] > matched:
                    t = short[link[s]]
                if t >= 0:
                    reach = max(reach, length[t])
                    while t > 0:
                        if t not in seen:
                            seen.add(t)
                            found.update(self.whole[t])
                        t = short[link[t]]
            if reach:
                start = at - reach
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = at
                else:
                    spans.append([start, at])
        return [(a, b) for a, b in spans], found


def item_blocks(items: DataFrame, width: int, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """Items as ``(id, words)``, words joined by spaces, in blocks of at most ``block_words`` words.

    A longer item is cut into pieces that overlap by all but one word of a window,
    so that each window is in one of them.  Blocks come to the driver one by one.
    """
    step = max(block_words, 2 * width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "id", "text"):
            rows = []
            for name, text in zip(ids, texts, strict=True):
                words = normal_words(text)
                for start in range(0, max(1, len(words) - width + 1), step - width + 1):
                    piece = words[start : start + step]
                    if piece:
                        rows.append((name, b" ".join(piece), len(piece)))
            names, pieces, sizes = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [pa.array(names, pa.string()), pa.array(pieces, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "words", "size"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), text_bytes())
    pieces = saved(named.mapInArrow(cut, "id string, words binary, size bigint"), "items")
    block: list[tuple[str, bytes]] = []
    size = 0
    # one partition at a time; a piece is no longer than a block
    for row in pieces.toLocalIterator():
        if size + row["size"] > step and block:
            yield block
            block, size = [], 0
        block.append((row["id"], bytes(row["words"])))
        size += row["size"]
    if block:
        yield block


# automata that a worker keeps; the others are built anew for each batch of documents
KEPT_AUTOMATA = 4

_automata: dict[tuple[bytes, int], Automaton] = {}


def _automaton(block: list[tuple[str, bytes]], width: int) -> Automaton:
    """The block's automaton, built once in a worker as long as there are few."""
    key = (hashlib.sha256(repr(block).encode()).digest(), width)
    if key not in _automata:
        if len(_automata) >= KEPT_AUTOMATA:
            _automata.clear()
        _automata[key] = Automaton([(name, words.split(b" ")) for name, words in block], width)
    return _automata[key]


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order and apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


FOUND = "n_words bigint, spans array<array<int>>, items array<string>"


def find_spans(docs: DataFrame, items: DataFrame, width: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add ``n_words, spans, items`` to documents; other columns of these names are replaced.

    ``spans`` are starts and ends, in words, of what is inside windows; ``items`` are
    the sorted ids, as strings, of the items with windows there (a null id is '').
    Documents stay where they are: items move, in blocks of bounded size, and each
    batch of documents meets one block after the other.  Null texts have no words;
    items without words are never found; rows that repeat an item count as one.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(b) for b in item_blocks(items, width, block_words)]
    added = T.StructType.fromDDL(FOUND)
    columns = [f for f in docs.schema if f.name not in added.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normal_words(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            spans: list[list] = [[] for _ in texts]
            owners: list[set] = [set() for _ in texts]
            for block in blocks:
                automaton = _automaton(block.value, width)
                for i, words in enumerate(texts):
                    where, found = automaton.hits(words)
                    if where:
                        spans[i] += where
                        owners[i].update(automaton.names[f] for f in found)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([_united(x) for x in spans], pa.list_(pa.list_(pa.int32()))),
                    pa.array([sorted(x) for x in owners], pa.list_(pa.string())),
                ],
                names=[*batch.schema.names[:-1], *added.fieldNames()],
            )

    kept = [F.col(f"`{f.name}`") for f in columns]
    source = docs.select(*kept, text_bytes().alias(unused("bytes", docs.columns)))
    return source.mapInArrow(run, T.StructType([*columns, *added]))


def report(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    found = find_spans(docs.select("doc_id", "text"), items, width)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (F.get(s, 1) - F.get(s, 0)))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: Sequence[tuple[int, int]]) -> str:
    """The text without the words of some spans, and without what stands between those."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, width: int = 10, min_span: int = 1, max_coverage: float = 0.5
) -> DataFrame:
    """Documents without what they share with test items; columns as before.

    Spans of at least ``min_span`` words are cut out of the text.  A document is
    dropped if they cover more than ``max_coverage`` of its words.  Documents
    without such spans stay as they are.  ``n_chars``, if there, follows the text.
    """
    found = find_spans(packed(docs, "text"), items, width)
    taken = F.filter("spans", lambda s: F.get(s, 1) - F.get(s, 0) >= min_span)
    found = found.withColumn("spans", taken)
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (F.get(s, 1) - F.get(s, 0)))
    found = found.filter(covered <= F.lit(max_coverage) * F.col("n_words"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return texts.combine(spans, lambda t, s: without_spans(t, [tuple(x) for x in s]) if len(s) else t)

    found = found.withColumn("text", cut(F.col("text"), F.col("spans")))
    return found.select(with_text(F.col("row"), F.col("text"), F.size("spans") > 0, docs).alias("row")).select("row.*")
