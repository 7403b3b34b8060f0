"""Streamed volume against batches, and keys across snapshots against dictionaries."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators.history import KeyHistory, repeats_summary
from tidewatch.operators.tables import one_table
from tidewatch.operators.volume import COUNT, DAY, daily_counts
from tidewatch.streaming.volume import VolumeStream, open_day_counts

SCHEMA = "row_id long, created_date string"
FIRST = datetime(2031, 5, 1, 3)


def landings(seed):
    """Four landings: mostly in order, some rows days late, some dates unreadable."""
    draw, out, row = random.Random(seed), [], 0
    for k in range(4):
        rows = []
        for _ in range(60):
            at = FIRST + timedelta(days=2 * k, hours=draw.randrange(48))
            at -= timedelta(days=draw.choice([0, 0, 0, 0, 1, 4]))
            rows.append((row, draw.choice([at.isoformat()] * 9 + ["never"])))
            row += 1
        out.append(rows)
    return out


def expected(parts, delay):
    counts, late, newest = Counter(), [], None
    for epoch, rows in enumerate(parts):
        times = [(i, datetime.fromisoformat(t)) for i, t in rows if t != "never"]
        for i, at in times:
            end = at.replace(hour=0, minute=0) + timedelta(days=1)
            if newest is not None and end <= newest - delay:
                late.append((epoch, i))
            else:
                counts[str(at.date())] += 1
        newest = max([newest or datetime.min, *(at for _, at in times)])
    return counts, late


@pytest.mark.parametrize("seed,days", [(1, 1), (2, 2), (3, 30)])
def test_every_row_is_counted_or_late(spark, tmp_path, seed, days):
    parts = landings(seed)
    job = VolumeStream(str(tmp_path / "out"), delay=f"{days} days")
    native = str(tmp_path / "native")
    stream = lambda: spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "landing"))
    (tmp_path / "landing").mkdir()
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "landing"))
        job.follow(stream())  # a run of its own for each landing: the state is in the folder

        def keep(batch, epoch):
            batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(native)

        open_day_counts(stream(), delay=f"{days} days").writeStream.outputMode("update").foreachBatch(keep).option(
            "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    counts, late = expected(parts, timedelta(days=days))
    assert {r[DAY]: r[COUNT] for r in job.daily_counts(spark).collect()} == counts
    epochs = {e: k for k, e in enumerate(sorted({r.epoch for r in job._entries(spark).collect()}))}
    found = job.late_rows(spark, spark.createDataFrame([], SCHEMA).schema).collect()
    assert sorted((epochs[r.epoch], r.row_id) for r in found) == sorted(late)
    assert (days < 30) == bool(late)
    assert sum(r.late_rows for r in job.late_counts(spark).collect()) == len(late)
    # Spark's own watermark keeps the same counts
    kept = spark.read.parquet(native).groupBy(DAY).agg(F.max_by(COUNT, "epoch").alias(COUNT)).collect()
    assert {r[DAY]: r[COUNT] for r in kept} == counts
    whole = daily_counts(one_table(spark.createDataFrame(sum(parts, []), SCHEMA), "row_id"))
    assert {r[DAY]: r[COUNT] for r in whole.collect()} == {
        r[DAY]: r[COUNT] for r in job.daily_counts(spark, with_late=True).collect()}


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path):
    job = VolumeStream(str(tmp_path / "out"), delay="1 days")
    first = spark.createDataFrame([(1, "2031-05-09T10:00:00"), (2, "2031-05-08T10:00:00")], SCHEMA)
    second = spark.createDataFrame([(3, "2031-05-01T10:00:00"), (4, "2031-05-09T11:00:00"), (5, None)], SCHEMA)
    for _ in range(2):
        job._take(first, 0)
    for _ in range(3):
        job._take(second, 1)
    assert {r[DAY]: r[COUNT] for r in job.daily_counts(spark).collect()} == {"2031-05-09": 2, "2031-05-08": 1}
    assert [(r.epoch, r.row_id) for r in job.late_rows(spark, second.schema).collect()] == [(1, 3)]


def test_nothing_has_arrived(spark, tmp_path):
    job = VolumeStream(str(tmp_path / "out"))
    assert job.daily_counts(spark).count() == 0 and job.late_rows(spark, spark.range(1).schema).count() == 0


def snapshots(seed):
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 5 + [f"k{draw.randrange(25)}", "", "  ", None, "é"])
    return [[(key(), draw.randrange(3), n) for n in range(80)] for _ in range(3)]


@pytest.mark.parametrize("keys", [["k"], ["k", "part"]])
def test_keys_across_snapshots(spark, tmp_path, keys):
    seen: dict = {}
    for number, rows in enumerate(snapshots(4)):
        history = KeyHistory(spark, str(tmp_path / "keys"), buckets=8)
        frame = spark.createDataFrame(rows, "k string, part int, n int").repartition(3)
        now = Counter((k, p) if len(keys) > 1 else k for k, p, _ in rows if k and k.strip())
        found = history.check(frame, f"day {number}", str(tmp_path / f"found{number}"), keys).collect()
        name = lambda k: k if len(keys) == 1 else f'["{k[0]}","{k[1]}"]'
        wanted = {(name(k), n, f"day {seen[k][0][0]}", len(seen[k]), sum(m for _, m in seen[k]))
                  for k, n in now.items() if k in seen}
        assert {tuple(r) for r in found} == wanted and (number == 0) == (not wanted)
        for k, n in now.items():
            seen.setdefault(k, []).append((number, n))
    assert history.snapshots().count() == 3
    with pytest.raises(ValueError):
        history.remember(frame, "day 1", keys)


def test_history_is_not_shuffled(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "keys"), buckets=8)
    frame = spark.createDataFrame(snapshots(1)[0], "k string, part int, n int")
    history.remember(frame, "one", ["k"])
    plan = history.repeats(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    above_history = plan[:plan.index("key_history_")]
    assert "Bucketed: true" in plan and plan.count("Exchange") == 2  # both are the new snapshot's
    assert "SortMergeJoin" in above_history


def test_copies_of_whole_rows(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "rows"), buckets=4)
    one = spark.createDataFrame([("a", 1.0, None), ("b", 0.0, b"x")], "k string, v double, raw binary")
    two = spark.createDataFrame([("a", 1.0, None), ("a", 1.0, None), ("b", -0.0, b"x"), ("b", 2.0, b"x")], one.schema)
    assert history.repeats(one).count() == 0
    history.remember(one, "one")
    found = repeats_summary(history.repeats(two)).first()
    assert tuple(found) == (2, 3, 1)
