"""Levels, ranks, summaries, sessions and sliding windows against plain loops."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sketches
from tidewatch.operators.ranking import global_ranks, with_positions
from tidewatch.operators.rollup import rolled_up
from tidewatch.operators.spans import sessions, sliding_volume

START = datetime(2031, 6, 1)


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("sets", ["cube", "rollup", [["a"], ["a", "b"], []]])
def test_every_level_adds_up(spark, sets):
    draw = random.Random(1)
    rows = [(draw.choice(["x", "y", None]), draw.choice(["p", "q"]), draw.choice([True, False, None])) for _ in range(200)]
    found = rolled_up(spark.createDataFrame(rows, "a string, b string, flag boolean"), ["a", "b"], {"hit": F.col("flag")}, sets)
    chosen = {"cube": [list(c) for k in (0, 1, 2) for c in combinations("ab", k)], "rollup": [[], ["a"], ["a", "b"]]}.get(str(sets), sets)
    wanted = []
    for s in chosen:
        key = lambda r: (r[0] if "a" in s else None, r[1] if "b" in s else None)
        level = 2 * ("a" not in s) + ("b" not in s)
        n, hit = Counter(map(key, rows)), Counter(key(r) for r in rows if r[2])
        wanted += [(*k, level, n[k], hit[k], round(100 * hit[k] / n[k], 2)) for k in n]
    assert order(map(tuple, found.collect())) == order(wanted)


def ranked(rows, tiles):
    known = sorted((v, i) for i, v in rows if v is not None)
    values, n = sorted({v for v, _ in known}), len(known)
    sizes = [n // tiles + (k < n % tiles) for k in range(tiles)]
    tile_of = [k + 1 for k, size in enumerate(sizes) for _ in range(size)]
    out = [(i, None, None, None, None, None, None, None) for i, v in rows if v is None]
    for at, (v, i) in enumerate(known):
        below, upto = sum(x < v for x, _ in known), sum(x <= v for x, _ in known)
        out.append((i, v, at + 1, below + 1, values.index(v) + 1, below / (n - 1) if n > 1 else 0.0, upto / n, tile_of[at]))
    return out


@pytest.mark.parametrize("seed,count,tiles", [(1, 300, 4), (2, 7, 10), (3, 1, 3), (4, 0, 2)])
def test_global_ranks(spark, seed, count, tiles):
    draw = random.Random(seed)
    rows = [(i, draw.choice([5.0] * 5 + [draw.uniform(-9, 9), float(draw.randrange(4)), None])) for i in range(count)]
    frame = spark.createDataFrame(rows, "id long, value double").repartition(3)
    found = global_ranks(frame, "value", ["id"], tiles)
    assert found.columns == ["id", "value", "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile"]
    same = [(*r[:5], r[5] and round(r[5], 12), r[6] and round(r[6], 12), r[7]) for r in ranked(rows, tiles)]
    got = [tuple(r) for r in found.collect()]
    assert order((*r[:5], r[5] and round(r[5], 12), r[6] and round(r[6], 12), r[7]) for r in got) == order(same)


def test_positions_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v"))
        frame = with_positions(rows, ["v"])
        assert {r.v: r.position for r in frame.collect()} == {v: v for v in range(5000)}
        assert rows.repartitionByRange("v").select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_states_of_days_add_up(spark):
    draw = random.Random(2)
    rows = [(k % 5, draw.choice([None, f"u{draw.randrange(3000)}"]), draw.gauss(0, 3)) for k in range(20000)]
    frame = spark.createDataFrame(rows, "day int, user string, v double")
    days = sketches.summaries(frame, ["day"], ["user", "v"], ["v"])
    assert days.count() == 10
    for part, chosen in ((days, rows), (days.where("day < 2"), [r for r in rows if r[0] < 2])):
        state = sketches.merged(part)
        counts = {r.field: r for r in sketches.distinct_counts(state).collect()}
        exact = len({u for _, u, _ in chosen if u})
        assert abs(counts["user"].distinct_estimate - exact) <= sketches.DISTINCT_ERROR * exact
        assert counts["user"].n == sum(u is not None for _, u, _ in chosen)
        numbers = sorted(v for *_, v in chosen)
        for share in (0.02, 0.5, 0.9):
            q = next(r for r in sketches.quantile(state, share).collect() if r.field == "v").quantile
            assert abs(sum(v <= q for v in numbers) / len(numbers) - share) <= sketches.RANK_ERROR + 1 / len(numbers)
    empty = sketches.merged(sketches.summaries(frame.limit(0), ["day"], ["user"]))
    assert empty.count() == 0


@pytest.mark.parametrize("slots", [1, 16, 1 << 16])
@pytest.mark.parametrize("share", [0.003, 0.05, 0.9])
def test_no_frequent_value_is_lost(spark, slots, share):
    draw = random.Random(7)
    rows = [(draw.choice(["hot"] * 8 + [None, f"k{int(draw.expovariate(0.02))}"]), draw.randrange(400), k % 3) for k in range(4000)]
    frame = spark.createDataFrame(rows, "a string, b int, day int")
    daily = sketches.slot_counts(frame, ["a", "b"], ["day"], slots)
    for state in (None, daily):
        found = sketches.frequent_values(frame, ["a", "b"], share, state, slots)
        wanted = set()
        for i, name in enumerate("ab"):
            n = Counter(str(r[i]) for r in rows if r[i] is not None)
            wanted |= {(name, v, k, n.total()) for v, k in n.items() if k >= share * n.total()}
        assert {tuple(r) for r in found.select("field", "value", "n", "total").collect()} == wanted
    with pytest.raises(ValueError):
        sketches.frequent_values(frame, ["a"], 0)


@pytest.mark.parametrize("width", [3_600_000_000, 60_000_000, 10**13])
def test_sessions(spark, width):
    draw = random.Random(3)
    rows = [(draw.choice(["hot"] * 4 + ["a", None]), draw.choice([START + timedelta(minutes=draw.randrange(6000))] * 9 + [None])) for _ in range(400)]
    found = sessions(spark.createDataFrame(rows, "k string, at timestamp").repartition(3), ["k"], "at", "30 minutes", width)
    wanted = []
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key and t is not None)
        runs = []
        for t in times:
            if runs and t - runs[-1][-1] < timedelta(minutes=30):
                runs[-1].append(t)
            else:
                runs.append([t])
        wanted += [(key, i + 1, r[0], r[-1], len(r)) for i, r in enumerate(runs)]
    assert order(map(tuple, found.collect())) == order(wanted)


def test_sliding_windows_count_quiet_days(spark):
    draw = random.Random(4)
    days = {("s", START.date() + timedelta(days=d)): draw.randrange(1, 9) for d in draw.sample(range(60), 25)}
    days |= {("t", START.date()): 3}
    frame = spark.createDataFrame([(s, str(d), n) for (s, d), n in days.items()], "scenario string, calendar_date string, request_count long")
    found = {(r.scenario, r.calendar_date): r for r in sliding_volume(frame, 5).collect()}
    for series in "st":
        own = [d for s, d in days if s == series]
        at, first = min(own), min(own)
        while at <= max(own):
            window = [at - timedelta(days=k) for k in range(5)]
            row = found.pop((series, str(at)))
            total = sum(days.get((series, d), 0) for d in window)
            assert (row.request_count, row.sliding_count) == (days.get((series, at), 0), total)
            assert row.sliding_mean == (total / 5 if window[-1] >= first else None)
            at += timedelta(days=1)
    assert not found and math.isfinite(total)
