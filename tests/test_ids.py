"""Intervals of ids against sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import ids
from tidelog.operators.merge import first_per_key


def frame(spark, rows):
    return spark.createDataFrame(rows, "pipelet bigint, msg_id bigint")


def runs(values):
    out = []
    for v in sorted(values):
        if out and out[-1][1] + 1 == v:
            out[-1][1] = v
        else:
            out.append([v, v])
    return out


def by_pipelet(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.pipelet, []).append([r.lo, r.hi])
    return {k: sorted(v) for k, v in out.items()}


B = ids.BLOCK


def test_intervals_gaps_and_marks(spark):
    rng = random.Random(3)
    sets = {
        0: set(range(3 * B + 5)),  # over several blocks
        1: {B - 1, B, B + 1, 2 * B - 1, 2 * B, 5 * B},  # at their borders
        2: {-B - 1, -B, -1, 0, 1, 2**62, 2**62 + 1},
        3: set(rng.sample(range(3000), 1500)),
        None: {7},
        5: set(range(999 * B, 1001 * B)),  # at the border of a thousand blocks
    }
    rows = [(p, i) for p, s in sets.items() for i in s] + [(1, B), (1, B), (3, None)]
    rng.shuffle(rows)
    found = ids.intervals(frame(spark, rows).repartition(5)).cache()
    want = {p: runs(s) for p, s in sets.items()}
    assert by_pipelet(found) == want
    assert by_pipelet(ids.gaps(found)) == {p: [[a[1] + 1, b[0] - 1] for a, b in zip(r, r[1:])] for p, r in want.items() if len(r) > 1}
    assert {r.pipelet: r.msg_id for r in ids.low_water(found).collect()} == {p: r[0][1] for p, r in want.items()}
    marks = {r.pipelet: r.msg_id for r in ids.low_water(found, first=0).collect()}
    assert marks == {0: 3 * B + 4, 1: -1, 2: 1, 3: next((b for a, b in want[3] if a <= 0), -1), None: -1, 5: -1}


def test_no_ids(spark):
    found = ids.intervals(frame(spark, []))
    assert found.count() == ids.gaps(found).count() == ids.low_water(found).count() == 0


@pytest.mark.parametrize("size", [40, 2500])
def test_replays_are_found_and_the_state_closes_up(spark, tmp_path, size):
    """Parts of a pipe in which a tenth comes twice, some of it much later."""
    rng = random.Random(size)
    state, kept, seen = ids.nothing_seen(spark), [], set()
    sizes = []
    for part in range(6):
        now = [(p, part * size + i) for p in (0, 1, None) for i in range(size)]
        rng.shuffle(now)
        held, now = now[: size // 20], now[size // 20 :]  # some come with the next part
        batch = [*now, *rng.sample(sorted(seen, key=str), len(seen) // 10), *now[: size // 10]]
        if part:
            batch += before
        before = held
        df = frame(spark, batch)
        new = first_per_key(ids.unseen(df, state), ("pipelet", "msg_id"), F.lit(0))
        kept += [(r.pipelet, r.msg_id) for r in new.collect()]
        ids.absorb(state, df).write.parquet(str(tmp_path / str(part)))
        state = spark.read.schema(ids.SEEN).parquet(str(tmp_path / str(part)))
        seen |= set(batch)
        sizes.append(state.count())
    assert len(kept) == len(set(kept)) and set(kept) == seen
    # the last part's holes, not the rows of all parts
    assert max(sizes) <= 3 * (size // 20 + 2)
    done = ids.absorb(state, frame(spark, before))
    assert [(r.block, r.lo, r.hi) for r in done.collect()] == [(None, 0, 6 * size - 1)] * 3
