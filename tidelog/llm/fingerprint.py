"""Document fingerprints: a hash tree over sections, paragraphs and pieces of a text.

A fingerprint is the tree as text: the root's 64 hex digits; then, section by
section, ``S`` and the section's hash; within it ``P`` and each paragraph's hash;
within that ``.`` and a short hash of each piece.  A paragraph is a line.  A
section ends after a paragraph whose hash begins with 0 or 1, so that an edit
disturbs its own section only.  A piece is up to eight words of one sentence.
Paragraph hashes cover every character; a section's hash covers those of its
paragraphs, and the root those of the sections.  Equal roots mean equal texts, and
where roots differ, equal branches show what was kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r" \t\n\x0B\f\r"
PIECE = rf"(?:[^{SPACE}]*[^{SPACE}.!?][{SPACE}]+){{0,7}}[^{SPACE}]+"
LOWEST = -(1 << 63)


def _hash(c: Column, digits: int) -> Column:
    return F.substring(F.sha2(c.cast("binary"), 256), 1, digits)


def fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the fingerprint of a text column; null counts as empty."""

    def paragraph(line: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), lambda x: F.concat(F.lit("."), _hash(x, 8)))
        return F.concat(F.lit("P"), _hash(line, 32), F.array_join(pieces, ""))

    def ended(p: Column) -> Column:
        return F.concat(p, F.when(F.substring(p, 2, 1).isin("0", "1"), F.lit("|")).otherwise(F.lit("")))

    def section(s: Column) -> Column:
        return F.concat(F.lit("S"), _hash(F.regexp_replace(s, r"\.[0-9a-f]+", ""), 32), s)

    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    df = df.withColumn("_paragraphs", F.transform(lines, paragraph))
    df = df.withColumn("_marked", F.array_join(F.transform("_paragraphs", ended), ""))
    sections = F.split(F.regexp_replace("_marked", r"\|$", ""), r"\|", -1)
    df = df.withColumn("_tree", F.array_join(F.transform(sections, section), ""))
    root = F.sha2(F.array_join(F.regexp_extract_all("_tree", F.lit("S([0-9a-f]{32})"), F.lit(1)), "").cast("binary"), 256)
    return df.withColumn(name, F.concat(root, F.col("_tree"))).drop("_paragraphs", "_marked", "_tree")


def pieces(fingerprint: Column) -> Column:
    """The distinct piece hashes of a fingerprint."""
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit(r"\.([0-9a-f]{8})"), F.lit(1)))


def likeness(a: Column, b: Column, pieces_a: Column, pieces_b: Column) -> Column:
    """Twice the common pieces, by the pieces of both; 1 for equal roots.

    Different texts without any piece (white space only) have likeness 0.
    """
    common = F.size(F.array_intersect(pieces_a, pieces_b))
    total = F.size(pieces_a) + F.size(pieces_b)
    return F.when(a == b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(2.0 * common / F.greatest(total, F.lit(1)))


def _branches(fingerprint: Column) -> Column:
    """The tree's sections: hash, and paragraphs with hash and piece hashes."""

    def parts(text: Column, mark: str) -> Column:
        # what stands before the first mark is the branch's own hash
        found = F.split(text, mark, -1)
        return F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0)))

    def paragraph(p: Column) -> Column:
        return F.struct(F.substring(p, 1, 32).alias("hash"), parts(p, r"\.").alias("pieces"))

    def section(s: Column) -> Column:
        return F.struct(F.substring(s, 1, 32).alias("hash"), F.transform(parts(s, "P"), paragraph).alias("paragraphs"))

    return F.transform(parts(fingerprint, "S"), section)


def differences(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Add ``name``: where the text of fingerprint ``a`` differs from that of ``b``.

    A struct of ``sections``, the numbers of a's sections that b does not have, and
    ``lines``: of the paragraphs in them that b's other sections do not have, the number
    (of the line, from 0), and the numbers of the ``pieces`` that b's paragraphs of that
    kind do not have.  The walk goes from the root to sections, paragraphs and pieces,
    and leaves equal branches alone; both lists are empty for equal roots.  Sections
    without lines say that paragraphs were moved or repeated.  Null fingerprints differ
    in nothing.
    """
    df = df.withColumns({"_a": _branches(F.col(a)), "_b": _branches(F.col(b))})
    gone = F.array_except(F.transform("_a", lambda s: s["hash"]), F.transform("_b", lambda s: s["hash"]))
    came = F.array_except(F.transform("_b", lambda s: s["hash"]), F.transform("_a", lambda s: s["hash"]))
    df = df.withColumns({"_gone": gone, "_came": came})
    # all paragraphs in order, so that their places are those of lines
    lines = F.flatten(
        F.transform("_a", lambda s: F.transform(s["paragraphs"], lambda p: F.struct(p["hash"].alias("hash"), p["pieces"].alias("pieces"), s["hash"].alias("section"))))
    )
    others = F.flatten(F.transform(F.filter("_b", lambda s: F.array_contains("_came", s["hash"])), lambda s: s["paragraphs"]))
    df = df.withColumns({"_lines": F.transform(lines, lambda p, i: F.struct(i.alias("line"), p["hash"].alias("hash"), p["pieces"].alias("pieces"), p["section"].alias("section"))), "_others": others})
    open_ = F.filter("_lines", lambda p: F.array_contains("_gone", p["section"]))
    new = F.array_except(F.transform(open_, lambda p: p["hash"]), F.transform("_others", lambda p: p["hash"]))
    df = df.withColumns({"_open": open_, "_new": new, "_pieces": F.array_distinct(F.flatten(F.transform("_others", lambda p: p["pieces"])))})
    numbered = lambda p: F.transform(p["pieces"], lambda x, i: F.struct(x.alias("hash"), i.alias("place")))
    changed = F.transform(
        F.filter("_open", lambda p: F.array_contains("_new", p["hash"])),
        lambda p: F.struct(
            p["line"].alias("line"),
            F.transform(F.filter(numbered(p), lambda x: ~F.array_contains("_pieces", x["hash"])), lambda x: x["place"]).alias("pieces"),
        ),
    )
    places = F.transform(
        F.filter(F.transform("_a", lambda s, i: F.struct(s["hash"].alias("hash"), i.alias("place"))), lambda s: F.array_contains("_gone", s["hash"])),
        lambda s: s["place"],
    )
    found = F.when(F.col(a) == F.col(b), F.struct(F.array().cast("array<int>").alias("sections"), F.array().cast("array<struct<line:int,pieces:array<int>>>").alias("lines")))
    df = df.withColumn(name, found.otherwise(F.struct(places.alias("sections"), changed.alias("lines"))))
    return df.drop("_a", "_b", "_gone", "_came", "_lines", "_others", "_open", "_new", "_pieces")


def _count_below(key: Column, edges: Sequence[int]) -> Column:
    """How many edges are smaller than the key; two short searches for many edges."""
    width = max(1, int(len(edges) ** 0.5))
    groups = [list(edges[i : i + width]) for i in range(0, len(edges), width)]
    if not groups:
        return F.lit(0)
    # Groups but the last are full, so a padded last one keeps the counts right.
    padded = groups[-1] + [(1 << 63) - 1] * (width - len(groups[-1]))
    array = F.array(*(F.array(*(F.lit(e).cast("bigint") for e in g)) for g in [*groups[:-1], padded]))
    whole = F.size(F.filter(F.array(*(F.lit(g[-1]) for g in groups)), lambda e: e < key))
    inside = F.coalesce(F.size(F.filter(F.get(array, whole), lambda e: e < key)), F.lit(0))
    return F.when(whole >= len(groups), F.lit(len(edges))).otherwise(whole * width + inside)


def with_next(docs: DataFrame, columns: Sequence[str], ranges: int) -> DataFrame:
    """Add ``next_<column>`` of the next document by descending id; after the last, the first.

    Ids are cut into ``ranges`` ranges at ids that occur, so the row that begins a
    range is known from its id; it is copied to the end of the range before.  Each
    range is then complete by itself, and texts are shuffled once.  Rows with one id
    follow each other by ``columns``; null ids come last.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(LOWEST))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.select(key.alias("k")).agg(F.percentile_approx("k", shares, 100 * ranges).alias("e"), F.max("k").alias("m")).first()
    top = found["m"] if found["m"] is not None else 0
    edges = sorted({*(found["e"] or []), top} - {top})
    range_of = _count_below(F.col("_key"), edges)
    rows = docs.select("doc_id", *columns, key.alias("_key")).withColumn("_range", range_of)

    def place(part: Column, copy: bool) -> Column:
        return F.struct(part.alias("part"), F.lit(copy).alias("copy"))

    copies = F.array_compact(
        F.array(
            place(F.col("_range"), False),
            F.when(F.col("_key").isin(edges) if edges else F.lit(False), place(F.col("_range") + 1, True)),
            F.when(F.col("_key") == F.lit(top), place(F.lit(0), True)),
        )
    )
    rows = rows.select("doc_id", *columns, "_key", F.inline(copies))
    order = [F.col("copy"), F.col("_key").desc(), *(F.col(c) for c in columns)]
    following = Window.partitionBy("part").orderBy(*order)
    rows = rows.select("doc_id", "copy", *columns, *(F.lead(c).over(following).alias(f"next_{c}") for c in columns))
    return rows.filter(~F.col("copy")).drop("copy")


def fingerprint_edits(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last half (rounded down) replaced by as many first
    characters of the next document by descending id.  Columns: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.  Null
    texts count as empty; further columns are left out.  ``ranges`` is the number of
    id ranges that are sorted apart (four a shuffle partition by default).
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = with_next(rows, ["text"], ranges)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint"))
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half)))
    for column, name in (("text", "fingerprint"), ("edited", "edited_fingerprint"), ("next_text", "next_fingerprint")):
        rows = fingerprint(rows, column, name)
        rows = rows.withColumn(f"_{name}", pieces(F.col(name)))
    near = {
        f"near_{n}": likeness(F.col("fingerprint"), F.col(f"{n}_fingerprint"), F.col("_fingerprint"), F.col(f"_{n}_fingerprint"))
        for n in ("edited", "next")
    }
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        *(c.alias(n) for n, c in near.items()),
    )
