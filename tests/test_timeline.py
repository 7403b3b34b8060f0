"""As-of joins and intervals against plain loops."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import skew, timeline
from tidewatch.operators.asof import asof_join
from tidewatch.operators.intervals import concurrency, overlap_counts

START = datetime(2031, 3, 1)


def moment(draw, hours=60):
    return START + timedelta(minutes=draw.randrange(hours * 60) // 7 * 7)


def order(rows):
    return sorted(rows, key=repr)


def newest(left, right, strict, tolerance):
    out = []
    for key, at, number in left:
        best = None
        for k, t, name, tie in right:
            if key is None or at is None or t is None or k != key or t > at or (strict and t == at):
                continue
            if tolerance and at - t > tolerance:
                continue
            if best is None or (t, tie) > (best[0], best[1]):
                best = (t, tie, name)
        out.append((key, at, number, best and best[2]))
    return out


@pytest.mark.parametrize("seed,strict,tolerance,width", [
    (1, False, None, 3_600_000_000), (2, True, None, 60_000_000), (3, False, timedelta(hours=2), 10**12), (4, True, timedelta(hours=1), 10**9)])
def test_asof_join_finds_the_newest_partner(spark, seed, strict, tolerance, width):
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 6 + ["a", "b", "c", None])
    left = [(key(), draw.choice([moment(draw)] * 9 + [None]), n) for n in range(300)]
    left += [("hot", START + timedelta(hours=20), 1000 + n) for n in range(100)]
    right = [(key(), draw.choice([moment(draw)] * 9 + [None]), f"r{n}", n) for n in range(200)]
    asked = spark.createDataFrame(left, "k string, at timestamp, number int").repartition(3)
    offered = spark.createDataFrame(right, "k string, seen timestamp, name string, tie int").repartition(3)
    limit = None if tolerance is None else f"{int(tolerance.total_seconds())} seconds"
    found = asof_join(asked, offered, ["k"], "at", "seen", ["name"], ["tie"], strict, limit, width)
    assert found.columns == ["k", "at", "number", "name"]
    assert order(map(tuple, found.collect())) == order(newest(left, right, strict, tolerance))


def test_asof_join_of_nothing(spark):
    some = spark.createDataFrame([("a", START, 1)], "k string, at timestamp, n int")
    other = some.select("k", F.col("at").alias("t"), F.col("n").alias("m"))
    assert asof_join(some.limit(0), other, ["k"], "at", "t", ["m"], ["m"]).count() == 0
    assert asof_join(some, other.limit(0), ["k"], "at", "t", ["m"], ["m"]).collect()[0].m is None
    with pytest.raises(ValueError):
        asof_join(some, some, ["k"], "at", "at", ["n"], ["n"])


def intervals(seed, count=150):
    draw = random.Random(seed)
    out = []
    for n in range(count):
        start = moment(draw)
        end = draw.choice([None, start, start + timedelta(minutes=draw.randrange(300)), start + timedelta(days=3), start - timedelta(hours=1)])
        out.append((draw.choice(["hot", "hot", "hot", "b", None]), draw.choice([start] * 9 + [None]), end, n))
    return out


SCHEMA = "k string, start timestamp, end timestamp, n int"


def usable(row):
    return row[1] is not None and (row[2] is None or row[2] >= row[1])


@pytest.mark.parametrize("minutes", [60, 7])
def test_concurrency_of_every_span(spark, minutes):
    rows = intervals(5)
    width = timedelta(minutes=minutes)
    found = concurrency(spark.createDataFrame(rows, SCHEMA).repartition(3), "start", "end", ["k"], minutes * 60_000_000,
                        until=str(START + timedelta(days=7)))
    wanted = []
    for key in {r[0] for r in rows if usable(r)}:
        mine = [(s, e or datetime.max) for k, s, e, _ in rows if k == key and usable((k, s, e))]
        points = sorted({t for pair in mine for t in pair if t != datetime.max})
        alive = lambda t: sum(s <= t < e for s, e in mine)
        epoch = datetime(1970, 1, 1)
        at = epoch + (points[0] - epoch) // width * width
        last = epoch + (max(points[-1], START + timedelta(days=7)) - epoch) // width * width
        while at <= last:
            end = at + width
            inside = [at] + [t for t in points if at <= t < end]
            wanted.append((key, at, sum(s < at <= e and s != e for s, e in mine), sum(at <= s < end for s, _ in mine),
                           sum(at <= e < end for _, e in mine), alive(end - timedelta(microseconds=1)), max(map(alive, inside))))
            at = end
    assert order(map(tuple, found.collect())) == order(wanted)


def test_concurrency_without_groups_and_without_rows(spark):
    rows = [("a", START, START + timedelta(hours=3), 1), ("b", START + timedelta(hours=1), None, 2)]
    found = concurrency(spark.createDataFrame(rows, SCHEMA), "start", "end").orderBy("span_start").collect()
    assert [(r.open_before, r.opened, r.closed, r.open_after, r.most_open) for r in found] == [
        (0, 1, 0, 1, 1), (1, 1, 0, 2, 2), (2, 0, 0, 2, 2), (2, 0, 1, 1, 1)]
    assert concurrency(spark.createDataFrame([], SCHEMA), "start", "end", ["k"]).count() == 0


def test_overlap_counts(spark):
    rows = intervals(6)
    found = overlap_counts(spark.createDataFrame(rows, SCHEMA).repartition(3), "start", "end", ["k"])
    wanted = []
    for k, s, e, n in rows:
        count = None
        if usable((k, s, e)) and k is not None:
            count = sum(m != n and usable((k2, s2, e2)) and k2 == k and s2 < (e or datetime.max) and s < (e2 or datetime.max)
                        for k2, s2, e2, m in rows)
        wanted.append((k, s, e, n, count))
    assert order(map(tuple, found.collect())) == order(wanted)


def test_a_hot_key_is_cut_into_cells(spark):
    pairs = spark.range(4000).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"), (F.col("id") * 1000).alias("at"))
    sizes = [r["count"] for r in timeline.with_cells(pairs, ["k"], "at", 10**9).groupBy("k", "_cell").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 40


def test_rows_of_a_heavy_key_are_dealt_out(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 4 > 0, 7).when(F.col("id") % 4 == 0, None).alias("k"), "id")
    found = spark.createDataFrame([(7, "x")], "k int, v string")
    joined = skew.join_by_count(rows, found, found.select("k"), ["k"])
    assert joined.where("v = 'x'").count() == 3000 and joined.count() == 4000
    exchanged = joined._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in exchanged
