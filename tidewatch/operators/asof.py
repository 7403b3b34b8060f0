"""As-of join: each row with the newest row of another table at or before its own time.

Both sides are first reduced to distinct (key, instant) pairs, which combines on the map side;
the right one keeps one row for each. The pairs are merged, sorted and walked cell by cell of
their timeline; the newest right row of earlier cells closes the seams. The answers, one for
each pair, then meet the left rows again, instants with very many rows dealt out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.skew import is_heavy, join_by_count
from tidewatch.operators.timeline import CELL, carried, micros, with_cells
from tidewatch.session import stored

HOUR = 3_600_000_000


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    ties: Sequence[str],
    strict: bool = False,
    tolerance: str | None = None,
    width: int = HOUR,
) -> DataFrame:
    """Every row of ``left`` with ``columns`` of its newest partner in ``right``, null if it has none.

    A partner has equal ``by`` columns (named alike on both sides) and a time not after the left
    one; with ``strict`` before it; with ``tolerance``, such as ``2 hours``, not older than that.
    Among partners of one time the one with the greatest ``ties`` (a list of columns that
    orders the right side) wins. Rows of the left side with a null key or time come back
    without a partner, such rows of the right side are no partners. ``width`` is that of the
    timeline's cells in microseconds; any value is right.
    """
    if not columns or set(columns) & set(left.columns):
        raise ValueError("columns must be named, and not be columns of the left side")
    keys = [f"_b{i}" for i in range(len(by))]
    known = lambda time: _all_known([*by, time])
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    payload = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), micros(F.col(right_time)).alias("at"))

    asked = left.where(known(left_time)).groupBy(*named, micros(F.col(left_time)).alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"))
    offered = right.where(known(right_time)).groupBy(*named, micros(F.col(right_time)).alias("_at")).agg(
        F.max_by(payload, F.struct(*ties)).alias("_offer"))
    # at one instant a right row stands before the left one, or behind it if partners must be older
    side = lambda is_right: F.lit(int(is_right == strict))
    merged = asked.select(*keys, "_at", side(False).alias("_side"), "_n", F.lit(None).alias("_offer")).unionByName(
        offered.select(*keys, "_at", side(True).alias("_side"), F.lit(None).cast("long").alias("_n"), "_offer"))
    pairs = stored(merged, "asof")
    merged = with_cells(pairs, keys, "_at", width)

    walk = Window.partitionBy(*keys, CELL).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    walked = merged.withColumn("_found", F.last("_offer", ignorenulls=True).over(walk)).where("_n is not null")
    seams = carried(
        merged.groupBy(*keys, CELL).agg(F.max_by("_offer", F.when(F.col("_offer").isNotNull(), F.col("_at"))).alias("_newest")),
        keys, "_newest", last=True).select(*keys, CELL, "before")
    answers = walked.join(seams, [*keys, CELL]).select(*keys, "_at", F.coalesce("_found", "before").alias("_found"))
    if tolerance is not None:
        oldest = micros(F.timestamp_micros("_at") - F.expr(f"interval {tolerance}"))
        answers = answers.withColumn("_found", F.when(F.col("_found.at") >= oldest, F.col("_found")))

    rows = left.select("*", *named, micros(F.col(left_time)).alias("_at"))
    heavy = pairs.where(is_heavy(F.col("_n"), pairs.agg(F.sum("_n")).scalar()))
    joined = join_by_count(rows, answers, heavy, [*keys, "_at"])
    return joined.select(*left.columns, *(F.col(f"_found.c{i}").alias(c) for i, c in enumerate(columns)))


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known
