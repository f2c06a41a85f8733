"""IP address lookup as a range join: one row in, one row out.

Where ranges nest or overlap, the narrowest that holds an address counts; of equally wide
ones that with the smaller start, then the smaller values.

``ip_range_join`` takes IPv4 ranges as numbers: these are made disjoint, block by block,
and the rows stay where they are.  ``ip_text_join`` takes IPv4 and IPv6 ranges as text:
different addresses and ranges meet in parts of the address space, each swept in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.shared import lookup_join

_IPV4 = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def ip_to_long(ip: Column) -> Column:
    """IPv4 text to a number; NULL if it is none."""
    parts = F.split(ip, r"\.")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("bigint")

    return F.when(ip.rlike(_IPV4), ((part(0) * 256 + part(1)) * 256 + part(2)) * 256 + part(3))


def overlapping_ranges(ranges: DataFrame, prefix_bits: int = 16) -> DataFrame:
    """Pairs ``lo, hi, next_lo`` of ranges that overlap, block by block."""
    following = Window.partitionBy("_block").orderBy("lo", "hi")
    ahead = _cut(ranges.select("lo", "hi"), prefix_bits).select("lo", "hi", F.lead("lo").over(following).alias("next_lo"))
    return ahead.filter("next_lo <= hi").distinct()


def _block(c: Column, prefix_bits: int) -> Column:
    return F.floor(c / F.lit(1 << (32 - prefix_bits))).cast("bigint")


def _cut(ranges: DataFrame, prefix_bits: int) -> DataFrame:
    blocks = F.sequence(_block(F.col("lo"), prefix_bits), _block(F.col("hi"), prefix_bits))
    return ranges.select(F.explode(blocks).alias("_block"), *ranges.columns)


def _swept(ranges: list[tuple], points: list) -> Iterator[tuple | None]:
    """The narrowest range for each of the sorted points; ranges are ``(lo, hi, width, order)``, sorted."""
    heap: list[tuple] = []
    at = 0
    for point in points:
        while at < len(ranges) and ranges[at][0] <= point:
            lo, hi, width, order = ranges[at]
            heapq.heappush(heap, (width, lo, order, hi))
            at += 1
        # the narrowest that has not ended
        while heap and heap[0][3] < point:
            heapq.heappop(heap)
        yield heap[0] if heap else None


def _table(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), kind))]
    return pa.RecordBatch.from_arrays(arrays, names=["_block", "lo", "hi", "_row"])


def disjoint_ranges(ranges: DataFrame, values: tuple[str, ...], prefix_bits: int = 16) -> DataFrame:
    """``_block, lo, hi`` and values: ranges cut so that no two of a block overlap.

    Every address has the values of the narrowest range that holds it.  Null ends, and
    ranges that end before they start, hold nothing.
    """
    width = F.col("hi") - F.col("lo")
    known = ranges.select("lo", "hi", *values).filter("lo <= hi").withColumn("_width", width)
    row = F.struct(*values) if values else F.struct(F.lit(0).alias("_none"))
    cut = known.select("lo", "hi", "_width", F.col("lo").alias("_from"), row.alias("_row"))
    blocks = F.sequence(_block(F.col("lo"), prefix_bits), _block(F.col("hi"), prefix_bits))
    cut = cut.withColumn("_block", F.explode(blocks))
    size = 1 << (32 - prefix_bits)
    cut = cut.withColumns({"lo": F.greatest("lo", F.col("_block") * size), "hi": F.least("hi", (F.col("_block") + 1) * size - 1)})
    # what starts first and is narrowest has the smallest place
    cut = cut.withColumn("_order", F.row_number().over(Window.partitionBy("_block").orderBy("_width", "_from", F.to_json("_row"))))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks one after the other, many of them of one range."""
        held: list[tuple] = []
        block = None

        def segments() -> Iterator[tuple]:
            if len(held) == 1:
                yield block, *held[0][:2], held[0][3]
                return
            starts = sorted({x for lo, hi, *_ in held for x in (lo, hi + 1)})
            rows = {place: row for _, _, place, row in held}
            found = _swept(sorted((lo, hi, place, place) for lo, hi, place, _ in held), starts)
            for s, e, f in zip(starts, starts[1:], found):
                if f:
                    yield block, s, e - 1, rows[f[2]]

        for batch in batches:
            out = []
            names = ("_block", "lo", "hi", "_order", "_row")
            for at, *row in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)):
                if at != block and held:
                    out += segments()
                    held.clear()
                block = at
                held.append(tuple(row))
            kind = batch.schema.field("_row").type
            yield _table(out, kind)
        if held:
            yield _table(list(segments()), kind)

    kind = cut.schema["_row"].dataType.simpleString()
    together = cut.repartition("_block").sortWithinPartitions("_block")
    out = together.mapInArrow(sweep, f"_block bigint, lo bigint, hi bigint, _row {kind}")
    return out.select("_block", "lo", "hi", *(F.col("_row")[v].alias(v) for v in values))


def ip_range_join(
    df: DataFrame,
    ranges: DataFrame,
    ip: Column,
    values: tuple[str, ...],
    prefix_bits: int = 16,
    salts: int = 1,
    spread: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``values`` of the narrowest range ``lo``..``hi`` an address lies in, else NULL.

    Ranges are cut at the ``prefix_bits`` boundaries and made disjoint, so that the join
    has an equality key and a residual test, and no row meets two of them.
    """
    cut = disjoint_ranges(ranges, values, prefix_bits)
    cut = cut.withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    left = df.withColumn("_ip", ip_to_long(ip)).withColumn("_block", _block(F.col("_ip"), prefix_bits))
    inside = F.col("_ip").between(F.col("r__lo"), F.col("r__hi"))
    joined = lookup_join(left, cut, ["_block"], where=inside, salts=salts, spread=spread)
    return joined.drop("_ip", "_block", "_lo", "_hi")


# -- addresses as text ---------------------------------------------------------

_PARTS, _SAMPLED = 64, 64
_V6_GROUPS = r"^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?$"


def ip_key(ip: Column) -> Column:
    """An IPv4 or IPv6 address as 32 hexadecimal digits, in the order of addresses; NULL if it is none.

    IPv4 addresses are those that IPv6 maps to ``::ffff:a.b.c.d``.
    """
    text = F.lower(F.trim(ip))
    tail = F.substring_index(text, ":", -1)
    four = F.lower(F.lpad(F.hex(ip_to_long(tail)), 8, "0"))
    v4 = F.when(~F.contains(text, F.lit(":")), F.concat(F.lit("0" * 20 + "ffff"), four))
    # an IPv4 tail as two groups
    groups = F.when(F.contains(tail, F.lit(".")), F.concat(F.regexp_replace(text, r"[^:]*$", ""), F.substring(four, 1, 4), F.lit(":"), F.substring(four, 5, 4))).otherwise(text)
    halves = F.split(groups, "::")

    def listed(half: Column) -> Column:
        there = F.filter(F.split(half, ":"), lambda g: F.length(g) > 0)
        return F.transform(there, lambda g: F.lpad(g, 4, "0"))

    left, right = listed(F.get(halves, F.lit(0))), F.coalesce(listed(F.get(halves, F.lit(1))), F.array().cast("array<string>"))
    n = F.size(left) + F.size(right)
    fits = F.when(F.size(halves) == 2, n <= 7).when(F.size(halves) == 1, n == 8).otherwise(False)
    well_formed = F.forall(halves, lambda h: h.rlike(_V6_GROUPS))
    zeros = F.array_repeat(F.lit("0000"), F.greatest(8 - n, F.lit(0)))
    v6 = F.when(fits & well_formed, F.array_join(F.concat(left, zeros, right), ""))
    return F.coalesce(v4, v6)


def ip_text_join(df: DataFrame, ranges: DataFrame, ip: Column, values: tuple[str, ...]) -> DataFrame:
    """Add ``values`` of the narrowest range an address lies in, else NULL; ``lo`` and ``hi`` are addresses as text.

    Different addresses alone are moved to the ranges' parts, and their answers joined to
    the rows.  The borders of the parts come from a sample of the ranges; they decide on
    balance, not on answers.  Ranges whose ends are no addresses hold nothing.
    """
    keyed = ranges.select(ip_key(F.col("lo")).alias("lo"), ip_key(F.col("hi")).alias("hi"), F.struct(*values).alias("_row")).filter("lo <= hi")
    sample = keyed.select("lo").distinct().orderBy(F.xxhash64("lo")).limit(_PARTS * _SAMPLED).collect()
    starts = sorted(r["lo"] for r in sample)
    borders = F.array(*(F.lit(x) for x in starts[:: max(1, len(starts) // _PARTS)])).cast("array<string>")

    def part(key: Column) -> Column:
        return F.size(F.filter(borders, lambda b: b <= key))

    parts = keyed.select("*", F.explode(F.sequence(part(F.col("lo")), part(F.col("hi")))).alias("_part"))
    rows = df.withColumn("_key", ip_key(ip))
    wanted = rows.select("_key").filter("_key is not null").distinct().select(F.col("_key").alias("key"), part(F.col("_key")).alias("_part"))
    kind = keyed.schema["_row"].dataType.simpleString()

    def sweep(addresses: pa.Table, held: pa.Table) -> pa.Table:
        points = sorted(addresses.column("key").to_pylist()) if addresses.num_rows else []
        order = held.column("_order").to_pylist() if held.num_rows else []
        known = []
        for lo, hi, place in zip(*(held.column(c).to_pylist() for c in ("lo", "hi", "_order"))) if order else ():
            known.append((lo, hi, int(hi, 16) - int(lo, 16), place))
        owner = {place: i for i, place in enumerate(order)}
        found = list(_swept(sorted(known), points))
        hits = [(p, owner[f[2]]) for p, f in zip(points, found) if f]
        picked = held.column("_row").combine_chunks().take(pa.array([i for _, i in hits], pa.int64()))
        return pa.table([pa.array([p for p, _ in hits], pa.string()), picked], names=["key", "_row"])

    numbered = parts.withColumn("_order", F.row_number().over(Window.partitionBy("_part").orderBy("lo", F.to_json("_row"), "hi")))
    met = wanted.groupBy("_part").cogroup(numbered.groupBy("_part")).applyInArrow(sweep, f"key string, _row {kind}")
    out = lookup_join(rows, met.withColumnRenamed("key", "_key"), ["_key"])
    return out.select(*df.columns, *(F.col("_row")[v].alias(v) for v in values))
