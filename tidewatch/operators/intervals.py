"""Intervals over time: how many are open at once, and how many each one overlaps.

A sweep line: an interval is +1 at its start and -1 at its end, an open one has no end. The
changes are summed for each instant (on the map side first), walked cell by cell, and cells
start with the sum that earlier cells leave, so neither a group with a third of all
intervals nor an interval that lasts for years makes more than two rows.

Intervals are half open: one that ends at an instant does not overlap one that starts there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.asof import asof_join
from tidewatch.operators.timeline import CELL, carried, micros, with_cells
from tidewatch.session import stored

HOUR = 3_600_000_000


def _usable(start: str, end: str) -> Column:
    return F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))


def changes(frame: DataFrame, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., at, opened, closed, empty) for every instant at which an interval starts or ends.

    ``empty`` counts intervals that do both there. Intervals without a start, or with an end
    before it, are left out.
    """
    empty = F.when(F.col(start) == F.col(end), F.lit(1)).otherwise(F.lit(0))
    point = lambda at, opened, closed: F.struct(
        micros(F.col(at)).alias("at"), F.lit(opened).alias("opened"), F.lit(closed).alias("closed"),
        (empty * opened).alias("empty"))
    both = F.explode(F.array(point(start, 1, 0), point(end, 0, 1)))
    points = frame.where(_usable(start, end)).select(*by, both.alias("p")).where("p.at is not null")
    return points.groupBy(*by, "p.at").agg(F.sum("p.opened").alias("opened"), F.sum("p.closed").alias("closed"), F.sum("p.empty").alias("empty"))


def concurrency(
    frame: DataFrame, start: str, end: str, by: Sequence[str] = (), width: int = HOUR, until: str | None = None
) -> DataFrame:
    """Open intervals in every span of ``width`` microseconds, one row for each group and span.

    Columns: by..., span_start (timestamp), open_before (open just before the span), opened,
    closed, open_after, most_open (the greatest number open at once inside it). Spans run without
    gaps from the first change of a group to its last, or to the one that holds ``until`` (a
    timestamp text); open intervals stay open. Null groups are groups.
    """
    moves = with_cells(stored(changes(frame, start, end, by), "changes"), by, "at", width)
    net = F.col("opened") - F.col("closed")
    walk = Window.partitionBy(*by, CELL).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    level = moves.withColumn("net", net).withColumn("level", F.sum("net").over(walk))
    cells = level.groupBy(*by, CELL).agg(
        F.sum("net").alias("net"), F.max("level").alias("peak"), F.min("at").alias("first"),
        F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    cells = _with_before(cells, cells.select(*by, CELL, "net"), by, "net")
    spans = cells.groupBy(*by, F.col(f"{CELL}.coarse").alias("span")).agg(
        F.min_by("before", CELL).alias("open_before"), F.sum("opened").alias("opened"), F.sum("closed").alias("closed"),
        F.max(F.col("before") + F.col("peak")).alias("peak"), F.min("first").alias("first"))
    # what is open just before a span is open in it, unless something changes at its first instant
    spans = spans.withColumn("peak", F.when(F.col("first") == F.col("span") * width, F.col("peak")).otherwise(
        F.greatest("open_before", "peak")))
    return _without_gaps(spans, by, width, until)


def _with_before(rows: DataFrame, cells: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` over earlier cells."""
    before = carried(cells, by, value, last=False).select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(by)), F.col(CELL).alias("_kc"), "before")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(by)] + [F.col(CELL) == F.col("_kc")]
    return rows.join(before, same).select(*rows.columns, "before")


def _without_gaps(spans: DataFrame, by: Sequence[str], width: int, until: str | None) -> DataFrame:
    """Quiet spans between two busy ones have what the first leaves open."""
    # the next busy span: looked up inside runs of spans, then from run to run
    run = 4096
    rows = spans.withColumn("_run", F.floor(F.col("span") / run))
    inside = Window.partitionBy(*by, "_run").orderBy("span")
    rows = rows.withColumn("_next", F.lead("span").over(inside))
    along = Window.partitionBy(*by).orderBy("_run")
    runs = rows.groupBy(*by, "_run").agg(F.min("span").alias("first")).select(
        *(F.col(k).alias(f"_r{i}") for i, k in enumerate(by)), F.col("_run").alias("_rr"), F.lead("first").over(along).alias("_after"))
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(by)] + [F.col("_run") == F.col("_rr")]
    rows = rows.join(runs, same)
    end = F.col("span") + 1
    if until is not None:
        end = F.greatest(end, F.floor(micros(F.lit(until)) / width).cast("long") + 1)
    follow = F.coalesce("_next", "_after", end)
    filled = rows.withColumn("_s", F.explode(F.sequence(F.col("span"), follow - 1)))
    busy, after = F.col("_s") == F.col("span"), F.col("open_before") + F.col("opened") - F.col("closed")
    none = F.lit(0).cast("long")
    return filled.select(
        *by, F.timestamp_micros(F.col("_s") * width).alias("span_start"),
        F.when(busy, F.col("open_before")).otherwise(after).alias("open_before"),
        F.when(busy, F.col("opened")).otherwise(none).alias("opened"),
        F.when(busy, F.col("closed")).otherwise(none).alias("closed"), after.alias("open_after"),
        F.when(busy, F.col("peak")).otherwise(after).alias("most_open"))


def overlap_counts(frame: DataFrame, start: str, end: str, by: Sequence[str]) -> DataFrame:
    """``frame`` with ``overlap_count``: how many other intervals of its group each one overlaps.

    Those that start before its end, less those that end at or before its start: two
    look-ups in the running sums, no pairs. Two intervals overlap if each starts before the other
    ends, so one of no length overlaps those that start before its instant and end behind it.
    Rows without a usable interval or with a null group get null.
    """
    sums = stored(_running(stored(changes(frame, start, end, by), "changes"), by), "sums")
    whole = frame.select(F.struct("*").alias("_row"), *(F.col(c).alias(f"_g{i}") for i, c in enumerate(by)),
                         F.when(_usable(start, end), F.col(start).cast("timestamp")).alias("_start"),
                         F.col(end).cast("timestamp").alias("_end"))
    groups = [f"_g{i}" for i in range(len(by))]
    sums = sums.select(*(F.col(c).alias(g) for c, g in zip(by, groups)), F.timestamp_micros("at").alias("_t"), "at",
                       F.col("opened").alias("_opened"), F.col("closed").alias("_closed"), F.col("empty").alias("_empty"))
    totals = sums.groupBy(*groups).agg(F.max("_opened").alias("_all")).select(
        *(F.col(g).alias(f"_t{g}") for g in groups), "_all")
    found = asof_join(whole, sums, groups, "_start", "_t", ["_closed", "_empty"], ["at"])
    found = asof_join(found, sums, groups, "_end", "_t", ["_opened"], ["at"], strict=True)
    found = found.join(totals, [F.col(g) == F.col(f"_t{g}") for g in groups], "left")
    started = F.when(F.col("_end").isNull(), F.col("_all")).otherwise(F.coalesce("_opened", F.lit(0)))
    # an interval counts itself; one of no length does not start before its end, but ends at its start
    own = F.when(F.col("_end") == F.col("_start"), -F.col("_empty")).otherwise(F.lit(1))
    count = started - F.coalesce("_closed", F.lit(0)) - own
    return found.select("_row.*", F.when(F.col("_start").isNotNull() & F.col("_all").isNotNull(), count).alias("overlap_count"))


def _running(moves: DataFrame, by: Sequence[str], width: int = HOUR) -> DataFrame:
    """``moves`` with opened and closed summed up from the first instant of the group on."""
    moves = with_cells(moves, by, "at", width)
    walk = Window.partitionBy(*by, CELL).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    out = moves.select(*by, CELL, "at", "empty", *(F.sum(c).over(walk).alias(c) for c in ("opened", "closed")))
    sums = moves.groupBy(*by, CELL).agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed"))
    for name in ("opened", "closed"):
        out = _with_before(out, sums.select(*by, CELL, name), by, name)
        out = out.withColumn(name, F.col(name) + F.col("before")).drop("before")
    return out.drop(CELL)
