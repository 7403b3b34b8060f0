"""Sessions between gaps, and sliding windows over calendar days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.tables import SCENARIO
from tidewatch.operators.timeline import CELL, carried, micros, with_cells
from tidewatch.operators.volume import COUNT, DAY
from tidewatch.session import stored

HOUR = 3_600_000_000


def sessions(frame: DataFrame, by: Sequence[str], time: str, gap: str, width: int = HOUR) -> DataFrame:
    """(by..., session, session_start, session_end, events): runs of rows without a gap.

    A row starts a session, numbered from 1, if its predecessor of the same ``by`` is ``gap`` or
    more older, such as ``30 minutes``. Rows with a null time are left out; null keys are a key. Rows are first
    counted for each key and instant; the timeline of a key is walked cell by cell, with its
    last instant and the number of its sessions carried over the seams.
    """
    keys = [f"_b{i}" for i in range(len(by))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)]
    pairs = frame.where(F.col(time).isNotNull()).groupBy(*named, micros(F.col(time)).alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"))
    cells = with_cells(stored(pairs, "instants"), keys, "_at", width)
    walk = Window.partitionBy(*keys, CELL).orderBy("_at")
    last = carried(cells.groupBy(*keys, CELL).agg(F.max("_at").alias("_last")), keys, "_last", last=True)
    rows = _beside(cells, last, keys).withColumn("_previous", F.coalesce(F.lag("_at").over(walk), "before")).drop("before")
    length = F.timestamp_micros("_at") - F.expr(f"interval {gap}")
    begins = F.col("_previous").isNull() | (F.col("_previous") <= micros(length))
    rows = stored(rows.select(*keys, CELL, "_at", "_n", begins.cast("long").alias("_begins")), "sessions")
    begun = carried(rows.groupBy(*keys, CELL).agg(F.sum("_begins").alias("_sum")), keys, "_sum", last=False)
    number = F.sum("_begins").over(walk.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    numbered = _beside(rows, begun, keys).withColumn("session", number)
    found = numbered.groupBy(*keys, "session").agg(F.min("_at").alias("a"), F.max("_at").alias("z"), F.sum("_n").alias("events"))
    return found.select(
        *(F.col(k).alias(c) for c, k in zip(by, keys)), "session", F.timestamp_micros("a").alias("session_start"),
        F.timestamp_micros("z").alias("session_end"), "events")


def _beside(rows: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with what is carried ``before`` their cell."""
    named = cells.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(CELL).alias("_kc"), "before")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(CELL) == F.col("_kc")]
    return rows.join(named, same).select(*rows.columns, "before")


def calendar_days(daily: DataFrame) -> DataFrame:
    """``daily`` counts (scenario, calendar_date, request_count) with quiet days between as zero."""
    day = F.to_date(DAY)
    following = F.lead(day).over(Window.partitionBy(SCENARIO).orderBy(DAY))
    spread = daily.select(SCENARIO, day.alias("_day"), COUNT, F.date_sub(F.coalesce(following, F.date_add(day, 1)), 1).alias("_until"))
    each = spread.withColumn("_d", F.explode(F.sequence("_day", "_until")))
    return each.select(SCENARIO, F.date_format("_d", "yyyy-MM-dd").alias(DAY),
                       F.when(F.col("_d") == F.col("_day"), F.col(COUNT)).otherwise(0).alias(COUNT))


def sliding_volume(daily: DataFrame, days: int = 7) -> DataFrame:
    """Each calendar day with the sum and mean of the ``days`` that end with it.

    Quiet days count as zero; windows that begin before the first day of a series are left
    out of ``sliding_mean``, since what came before is not known.
    """
    filled = calendar_days(daily)
    number = F.unix_date(F.to_date(DAY))
    window = Window.partitionBy(SCENARIO).orderBy(number).rangeBetween(-(days - 1), 0)
    seen = F.count(F.lit(1)).over(window)
    total = F.sum(COUNT).over(window)
    return filled.select(SCENARIO, DAY, COUNT, total.alias("sliding_count"), F.when(seen == days, total / days).alias("sliding_mean"))
