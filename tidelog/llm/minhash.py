"""Near-duplicates: SuperMinHash signatures, banding, verification, grouping.

SuperMinHash gives each element one random permutation of the signature's places
and a random number; the element offers ``rank + number`` to each place.  Ranks of
one element differ from place to place, which lowers the variance against
independent hashes, and once no place holds an offer of the present rank or more,
higher ranks need not be looked at.

Documents with equal shingle sets are one class; only one signature of a class is
banded.  In each bucket members are compared with its most central one, which settles
most groups.  All classes then go through an exact join of members of different groups,
whether or not they share a bucket.  Every link is confirmed on the full sets.  Groups
come from union-find inside tasks, then from label contraction between them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, mixed, rolling, rows_of, saved, text_bytes, unused, word_hashes

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RANK_SHIFT = np.uint64(32)
_GOLDEN = 0x9E3779B97F4A7C15
# shingles whose ranks are drawn together
CHUNK = 1 << 16
# elements are counted by their first bits; so many cells go together in a row
CELL_BITS = 22
CELL_BLOCK = 1 << 12
# bits that bound from below in how many elements two sets differ
PARITY_BITS = 2048


@dataclass(frozen=True)
class NearDuplicates:
    """How documents are compared.

    Two documents are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets
    of ``shingle``-word shingles.  ``bands`` of ``rows`` signature places find most
    pairs: with the defaults a pair at 80 % is missed once in 1,500 times by all bands.
    An exact join finds what they miss, so they decide on time only, not on results.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 6

    @property
    def places(self) -> int:
        return self.bands * self.rows


def shingles(texts: Sequence[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the texts' k-word shingles.

    A shorter text is one shingle; one without words has none.
    """
    sets = []
    for words in word_hashes([t.translate(_LOWER) for t in texts]):
        n = min(k, len(words))
        sets.append(np.unique(rolling(words, n) + np.uint64(n)) if n else words)
    return sets


def signatures(elements: np.ndarray, owner: np.ndarray, n_owners: int, places: int) -> np.ndarray:
    """SuperMinHash signatures of several sets at once, one row each.

    ``elements`` are hashes, ``owner`` the (non-empty) set each belongs to.  A place
    holds ``rank << 32 | number``.
    """
    least = np.full((n_owners, places), np.iinfo(np.uint64).max, np.uint64)
    flat = least.ravel()
    order = np.empty((0, places), np.int16)
    started = False
    for rank in range(places):
        with np.errstate(over="ignore"):
            drawn = mixed(elements + np.uint64((rank + 1) * _GOLDEN % (1 << 64)))
        pick = rank + ((drawn >> _RANK_SHIFT) * np.uint64(places - rank) >> _RANK_SHIFT).astype(np.int64)
        number = (drawn & np.uint64(0xFFFFFFFF)) | np.uint64(rank) << _RANK_SHIFT
        if not started:
            place = pick
        else:
            rows = np.arange(len(elements))
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        np.minimum.at(flat, owner * places + place, number)
        # a set is done once no place is left that a higher rank could lower
        open_ = (least >> _RANK_SHIFT).max(axis=1) > rank
        if not open_.any():
            break
        stay = open_[owner]
        if not started:
            order = np.tile(np.arange(places, dtype=np.int16), (int(stay.sum()), 1))
            rows = np.arange(len(order))
            # the first rank's exchange of places 0 and pick
            order[rows, pick[stay]] = 0
            started = True
        else:
            order = order[stay]
        elements, owner = elements[stay], owner[stay]
    return least


def signatures_of(sets: list[np.ndarray], places: int) -> np.ndarray:
    """Signatures of (non-empty) sets, about ``CHUNK`` elements at a time.

    A long set is taken in pieces: its signature has the least that any of them offers.
    """
    least = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    held: list[tuple[int, np.ndarray]] = []

    def take() -> None:
        owner = np.repeat(np.arange(len(held)), [len(x) for _, x in held])
        found = signatures(np.concatenate([x for _, x in held]), owner, len(held), places)
        np.minimum.at(least, [i for i, _ in held], found)
        held.clear()

    size = 0
    for i, elements in enumerate(sets):
        for start in range(0, len(elements), CHUNK):
            piece = elements[start : start + CHUNK]
            if held and size + len(piece) > CHUNK:
                take()
                size = 0
            held.append((i, piece))
            size += len(piece)
    if held:
        take()
    return least


SKETCH = "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>"


def sketches(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """``doc_id, n_shingles, class, bands``: equal sets have equal classes.

    Documents without words have no class and no bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            sets = shingles(texts, how.shingle)
            bands: list = [None] * len(sets)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = signatures_of([sets[i] for i in full], how.places).reshape(len(full), how.bands, how.rows)
            with np.errstate(over="ignore"):
                hashed = np.broadcast_to(np.arange(1, how.bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN), keys.shape[:2])
                for r in range(how.rows):
                    hashed = mixed(hashed * np.uint64(31) + keys[:, :, r])
            for i, row in zip(full, hashed.view(np.int64), strict=True):
                bands[i] = row
            classes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "bands"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes()).mapInArrow(run, SKETCH)


def verified(pairs: DataFrame, docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """Those pairs ``a, b`` of ids whose full sets are alike enough.

    Texts go to the pairs of ``a``; these go on to ``b``, many of which may be the
    same: adaptive execution splits such a one over tasks.
    """
    texts = docs.select(F.col("doc_id").alias("id"), text_bytes())
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for a, b, text_a, text_b in rows_of(batches, "a", "b", "text_a", "text_b"):
            kept = []
            for i, x in enumerate(shingles(text_a, how.shingle)):
                if last[0] != text_b[i]:
                    last = (text_b[i], shingles([text_b[i]], how.shingle)[0])
                y = last[1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common and 100 * common >= how.percent * (len(x) + len(y) - common):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())], names=["a", "b"]
            )

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint").distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a task's links; gives a link from each id to its group's smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def links() -> pa.RecordBatch:
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
        )

    for a, b in rows_of(batches, "a", "b"):
        for x, y in zip(a, b, strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > 1_000_000:
            yield links()
            parent.clear()
    yield links()


def components(links: DataFrame) -> DataFrame:
    """``id, component``: for each linked id the smallest id that it can reach.

    Each round points ids to the smallest of their neighbours, seen from the larger
    and from the smaller ones in turn, until nothing changes; links are written to
    shared storage after each round and never gathered.
    """
    edges = saved(links.select("a", "b").mapInArrow(_forest, "a bigint, b bigint").distinct(), "links")

    def print_of(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = print_of(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
        down = saved(larger, "links")
        lowest = down.groupBy("a").agg(F.min("b").alias("least"))
        smaller = down.join(lowest, "a")
        edges = saved(
            smaller.select("a", F.col("least").alias("b"))
            .unionByName(smaller.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b"))
            .distinct(),
            "links",
        )
        after = print_of(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))


def candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` (a > b) of bucket members, each with its bucket's most central one.

    That is the member whose buckets have the most members in all: of copies with
    different changes, one with few.
    """
    central = members.groupBy("id").agg(F.sum("many").alias("central"))
    drawn = F.max(F.struct("central", F.xxhash64("id"), "id", "n"))
    heads = members.join(central, "id").groupBy("bucket").agg(drawn.alias("head"))
    heads = heads.select("bucket", F.col("head.id").alias("head"), F.col("head.n").alias("head_n"))
    pairs = members.join(heads, "bucket").filter("id <> head")
    alike = 100 * F.least("n", "head_n") >= percent * F.greatest("n", "head_n")
    return pairs.filter(alike).select(F.greatest("id", "head").alias("a"), F.least("id", "head").alias("b")).distinct()


def _cells(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def levels(docs: DataFrame, how: NearDuplicates) -> np.ndarray:
    """How often elements occur, on a scale of logarithms, for each first ``CELL_BITS`` bits of them.

    The table has the same size whatever the documents are.  Cells that several
    elements share make the order of elements less good, not wrong.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(1 << CELL_BITS, np.uint32)
        for (texts,) in rows_of(batches, "text"):
            np.add.at(many, _cells(np.concatenate([np.empty(0, np.uint64), *shingles(texts, how.shingle)])), 1)
        blocks = np.minimum(many, 65535).astype("<u2").reshape(-1, CELL_BLOCK)
        full = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([blocks[i].tobytes() for i in full], pa.binary())], names=["block", "many"])

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        many = np.zeros(CELL_BLOCK, np.uint64)
        for part in parts.column("many").to_pylist():
            many += np.frombuffer(part, "<u2")
        level = np.minimum(255, 8 * np.log2(many + 1.0)).astype(np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "level": pa.array([level.tobytes()], pa.binary())})

    parts = docs.select(text_bytes()).mapInArrow(count, "block bigint, many binary")
    out = np.zeros(1 << CELL_BITS, np.uint8).reshape(-1, CELL_BLOCK)
    for row in parts.groupBy("block").applyInArrow(add, "block bigint, level binary").toLocalIterator():
        out[row.block] = np.frombuffer(row.level, np.uint8)
    return out.ravel()


def _differences(a: int, b: int, percent: int) -> int:
    """In how many elements at most sets of these sizes differ if they are alike enough."""
    return (100 - percent) * (a + b) // (100 + percent)


def _widths(n: int, percent: int) -> list[tuple[int, int, int]]:
    """For each class of sizes in which a set of n elements is looked for: its number, its cells and how many the set names.

    A class has sizes from a power of two to the next.  A pair is looked for in that of
    its smaller set, with the same number of cells for both.
    """
    found = []
    for size_class in range((-(percent * n // -100)).bit_length() - 1, n.bit_length()):
        largest = (2 << size_class) - 1
        cells = 3 * (_differences(largest, 100 * largest // percent, percent) + 1) // 2 + 1
        # the set may be the larger one, or in its own class the smaller one
        other = largest if largest < n else 100 * n // percent
        found.append((size_class, cells, min(cells, _differences(n, other, percent) + 1)))
    return found


def cells(docs: DataFrame, how: NearDuplicates, known: Broadcast) -> DataFrame:
    """``id, cells``: keys of which any two sets that are alike enough have one in common.

    A set's elements are dealt to cells by their hashes, to more than alike sets differ
    in elements.  So some cells have the same content in both, and the best of these,
    the one that is the least likely by its elements' ``levels``, has no more others
    before it than there are differences.  Each set names its best cells.  Unlike sets
    have single elements in common by chance, whole cells of several hardly ever.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = known.value
        top = int(level.max()) + 1
        for ids, texts in rows_of(batches, "id", "text"):
            sets = shingles(texts, how.shingle)
            roles = [(i, *role) for i, s in enumerate(sets) if len(s) for role in _widths(len(s), how.percent)]
            who, size_class, width, named = np.array(roles, np.int64).reshape(-1, 4).T
            elements = np.concatenate([np.empty(0, np.uint64), *(sets[i] for i in who)])
            owner = np.repeat(np.arange(len(who)), np.array([len(sets[i]) for i in who], np.int64))
            first = np.cumsum(width) - width
            place = first[owner] + (elements % width[owner].astype(np.uint64)).astype(np.int64)
            total = int(width.sum())
            content = np.zeros(total, np.uint64)
            np.add.at(content, place, elements)
            worth = np.bincount(place, weights=(top - level[_cells(elements)].astype(np.int64)), minlength=total).astype(np.int64)
            owner = np.repeat(np.arange(len(who)), width)
            number = np.arange(total) - first[owner]
            rank = (65535 - np.minimum(worth, 65535)).astype(np.uint64) << np.uint64(48) | content >> np.uint64(16)
            order = np.lexsort((rank, owner))
            order = order[number < named[owner]]
            with np.errstate(over="ignore"):
                keys = mixed(content[order] + mixed(((size_class[owner[order]] << 40) + number[order] + 1).astype(np.uint64)))
            ends = np.zeros(len(sets) + 1, np.int64)
            np.add.at(ends, who + 1, named)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], names=["id", "cells"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_bytes()).filter("id is not null")
    return texts.mapInArrow(run, "id bigint, cells array<bigint>")


def blocks(groups: DataFrame, docs: DataFrame, how: NearDuplicates, known: Broadcast) -> DataFrame:
    """``id, block``: sets of different groups that may be alike are in one block; those without such have none.

    ``groups`` has ``id, component``.  Blocks are what keys of ``cells`` connect.
    """
    spark = docs.sparkSession
    named = saved(cells(docs, how, known).join(groups, "id"), "cells")
    discard(spark)
    each = named.select("id", "component", F.explode("cells").alias("cell"))
    shared = each.groupBy("cell").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.min("id").alias("first"))
    shared = saved(shared.filter("least <> most").select("cell", "first"), "shared")
    discard(spark)
    edges = saved(each.join(shared, "cell").filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct(), "edges")
    found = components(edges).withColumnRenamed("component", "block")
    discard(spark, named, shared, edges)
    return found.unionByName(found.select(F.col("block").alias("id"), "block").distinct())


def prefixes(docs: DataFrame, how: NearDuplicates, known: Broadcast) -> DataFrame:
    """``id, n, parity, first, own``: the first elements of each set, rarest first.

    Of two sets that are alike the smaller has one of its first ``own`` elements among
    the larger one's ``first``: they share ``2 p / (100 + p)`` of the smaller at least.
    ``parity`` has a bit for each of ``PARITY_BITS`` cells, set if an odd number of
    elements fall there: sets differ in as many elements at least as in bits.
    ``known`` has the elements' ``levels``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = known.value
        for ids, texts in rows_of(batches, "id", "text"):
            sets = shingles(texts, how.shingle)
            first, own, parity = [], [], []
            for s in sets:
                odd = np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
                parity.append(np.packbits(odd.astype(np.uint8)).tobytes())
                order = np.lexsort((s, level[_cells(s)]))
                keep = len(s) + how.percent * len(s) // -100 + 1 if len(s) else 0
                first.append(s[order[:keep]].view(np.int64))
                own.append(len(s) + 2 * how.percent * len(s) // -(100 + how.percent) + 1 if len(s) else 0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(parity, pa.binary()),
                    pa.array(first, pa.list_(pa.int64())),
                    pa.array(own, pa.int64()),
                ],
                names=["id", "n", "parity", "first", "own"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_bytes()).filter("id is not null")
    return texts.mapInArrow(run, "id bigint, n bigint, parity binary, first array<bigint>, own bigint")


def _near_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` without those whose parities differ in more bits than alike sets in elements.

    An id that rows with different texts share stays if any of them may be alike.
    """
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("parity_a")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("parity_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, n_a, n_b, parity_a, parity_b in rows_of(batches, "a", "b", "n_a", "n_b", "parity_a", "parity_b"):
            x, y = (np.frombuffer(b"".join(p), np.uint64).reshape(-1, PARITY_BITS // 64) for p in (parity_a, parity_b))
            differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            # of alike sets, (100 + percent) * |A ^ B| <= (100 - percent) * (|A| + |B|)
            keep = (100 + percent) * differ <= (100 - percent) * (np.array(n_a, np.int64) + np.array(n_b, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(a, np.int64)[keep], pa.int64()), pa.array(np.array(b, np.int64)[keep], pa.int64())], names=["a", "b"]
            )

    return both.select("a", "b", "n_a", "n_b", "parity_a", "parity_b").mapInArrow(run, "a bigint, b bigint").distinct()


def remaining(groups: DataFrame, docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """Pairs ``a, b`` (a > b) of ids in different groups that may be alike: all that are.

    ``groups`` has ``id, component`` of one document of each class.  An exact join by
    prefix and position: with elements in one order, rarest first, the smaller of two
    sets that are alike enough has one of its few first elements among the larger one's
    first, and where that is, enough elements must follow in both.  Rare elements are
    what a copy does not have from its original: texts of one pattern that differ too
    much have their own elements first, so that none of the pattern's brings them
    together.  Only sets of one of the ``blocks`` meet: in a growing corpus ever more
    unlike sets have some rare element in common.  Of an element's documents those of
    its largest group meet only others.
    """
    p = how.percent
    known = docs.sparkSession.sparkContext.broadcast(levels(docs, how))
    block = blocks(groups, docs, how, known)
    some = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(block.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    grouped = saved(prefixes(some, how, known).join(groups, "id").join(block, "id"), "prefixes")
    each = grouped.select("id", "n", "component", "block", F.posexplode("first").alias("at", "element"), "own")
    each = each.withColumn("short", F.col("at") < F.col("own")).withColumn("element", F.xxhash64("block", "element")).drop("block", "own")
    several = each.groupBy("element").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.max("short").alias("any_short")
    )
    several = several.filter("least <> most and any_short").select("element")
    met = saved(each.join(several, "element", "left_semi"), "elements")
    counts = met.groupBy("element", "component").agg(F.count("*").alias("own_many"))
    largest = counts.groupBy("element").agg(F.max_by("component", F.struct("own_many", "component")).alias("largest"))
    each = saved(met.join(largest, "element").withColumn("minor", F.col("component") != F.col("largest")).drop("largest"), "elements")
    short = each.filter("short").select(*(F.col(c).alias(f"m_{c}") for c in ("id", "n", "component", "at", "element", "minor")))
    smaller = (F.col("m_n") < F.col("n")) | ((F.col("m_n") == F.col("n")) & (F.col("m_id") < F.col("id")))
    most = F.least(F.col("n") - F.col("at"), F.col("m_n") - F.col("m_at"))
    enough = (100 + p) * most >= p * (F.col("n") + F.col("m_n"))
    alike = 100 * F.col("m_n") >= p * F.col("n")
    meet = (F.col("element") == F.col("m_element")) & (F.col("component") != F.col("m_component")) & smaller & enough & alike
    found = [each.join(short.filter("m_minor"), meet), each.filter("minor").join(short.filter("not m_minor"), meet)]
    ends = (F.greatest("id", "m_id").alias("a"), F.least("id", "m_id").alias("b"))
    pairs = found[0].select(*ends).unionByName(found[1].select(*ends)).distinct()
    pairs = saved(_near_enough(pairs, grouped, p), "pairs")
    discard(docs.sparkSession, grouped, met, each)
    return pairs


def near_duplicates(docs: DataFrame, how: NearDuplicates | None = None) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, kept`` per document.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest
    that links lead to.  Empty and null texts are linked with nothing.  Rows that
    share an id are linked; rows without an id are linked with nothing and kept.
    Further columns are left out.
    """
    how = how or NearDuplicates()
    sketch = saved(sketches(docs, how), "sketches")
    banded = sketch.filter("class is not null and doc_id is not null")
    classes = saved(
        banded.groupBy("class").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    members = classes.select("id", "n", F.explode("bands").alias("bucket")).distinct()
    shared = members.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1")
    members = saved(members.join(shared, "bucket"), "members")
    tested = saved(candidates(members, how.percent), "pairs")
    links = saved(verified(tested, docs, how), "confirmed")
    first = components(links)
    discard(docs.sparkSession, members)
    every = classes.select("id").distinct().join(first, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    again = saved(remaining(every, docs, how).join(tested, ["a", "b"], "left_anti"), "pairs")
    if not again.isEmpty():
        first = components(links.unionByName(saved(verified(again, docs, how), "confirmed")))
    grouped = classes.join(first.withColumnRenamed("id", "g_id"), F.col("id") == F.col("g_id"), "left")
    grouped = saved(grouped.select("class", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id")), "groups")
    out = sketch.join(grouped, "class", "left")
    own = F.coalesce("class_id", "doc_id")
    group = F.coalesce("component_id", "doc_id")
    group = F.when(F.col("doc_id").isNotNull(), group)
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select(
        "doc_id", "n_shingles", own.alias("class_id"), group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, how: NearDuplicates | None = None) -> DataFrame:
    """One document of each group, the one with the smallest id; columns as before.

    Rows that repeat a kept id all stay.
    """
    name = unused("gone", docs.columns)
    gone = near_duplicates(docs, how).filter("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
