"""Keyed timelines cut into cells, so that a key with a third of all rows is not one task's.

A timeline is a table of distinct (key, instant) pairs. Instants are dealt to cells of a fixed
width; a cell with more than a thousandth of all pairs (there are fewer than a thousand) is
cut into finer ones. What must cross a border is carried along the cells of a key, one row
for each cell, never along the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.skew import HEAVY

CELL = "_cell"
#: Borders of a key are first carried inside runs of so many cells, then along the runs.
RUN = 4096
#: A heavy cell is cut into so many parts for each thousandth of all rows that it holds.
FINER = 4


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def with_cells(pairs: DataFrame, keys: Sequence[str], at: str, width: int) -> DataFrame:
    """``pairs`` with ``_cell``, a struct (coarse, fine) that ascends with ``at`` (microseconds)."""
    coarse = F.floor(F.col(at) / width).cast("long")
    counts = pairs.groupBy(*keys, coarse.alias("_coarse")).agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
    total = counts.agg(F.sum("n")).scalar()
    heavy = counts.where((F.col("n") * HEAVY > total) & (F.col("n") > 1)).select(
        *(F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)), F.col("_coarse").alias("_hc"), F.col("low").alias("_low"),
        (F.col("high") - F.col("low") + 1).alias("_long"),
        F.ceil(F.col("n") * HEAVY * FINER / total).cast("long").alias("_parts"))
    same = [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)] + [F.col("_coarse") == F.col("_hc")]
    fine = F.floor((F.col(at) - F.col("_low")) / (F.col("_long") / F.col("_parts")))
    fine = F.coalesce(fine, F.lit(0)).cast("long")
    return (pairs.withColumn("_coarse", coarse).join(F.broadcast(heavy), same, "left")
            .select(*pairs.columns, F.struct(F.col("_coarse").alias("coarse"), fine.alias("fine")).alias(CELL)))


def carried(cells: DataFrame, keys: Sequence[str], value: str, last: bool) -> DataFrame:
    """``cells`` (keys, _cell, value) with ``before``: what earlier cells of the key leave behind.

    With ``last`` that is the newest value that is not null, otherwise the sum of all values. A
    key's cells are taken in runs, so a window holds at most RUN cells, or one row for each run.
    """
    total = (lambda c, w: F.last(c, ignorenulls=True).over(w)) if last else (lambda c, w: F.sum(c).over(w))
    run = F.floor(F.col(f"{CELL}.coarse") / RUN)
    cells = cells.withColumn("_run", run)
    inside = Window.partitionBy(*keys, "_run").orderBy(CELL)
    cells = cells.withColumn("_inside", total(value, inside.rowsBetween(Window.unboundedPreceding, -1)))
    final = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(CELL))) if last else F.sum(value)
    runs = cells.groupBy(*keys, "_run").agg(final.alias("_final"))
    along = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), F.col("_run").alias("_rr"),
                       total("_final", along).alias("_outside"))
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)] + [F.col("_run") == F.col("_rr")]
    joined = cells.join(runs, same, "left")
    before = (F.coalesce("_inside", "_outside") if last
              else F.coalesce("_inside", F.lit(0)) + F.coalesce("_outside", F.lit(0)))
    return joined.select(*keys, CELL, value, before.alias("before"))
