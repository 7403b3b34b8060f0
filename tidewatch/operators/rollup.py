"""Counts and shares at several levels of grouping, from one pass over the rows.

Rows are counted once at the finest level, which combines on the map side; all other levels add
up those counts. Shares are made from the added counts, never from other shares, so every
subtotal is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import is_blank, percent

LEVEL, ROWS = "level", "row_count"


def rolled_up(
    frame: DataFrame, dimensions: Sequence[str], counters: Mapping[str, Column], sets: Sequence[Sequence[str]] | str = "cube"
) -> DataFrame:
    """(dimensions..., level, row_count, a count and a percentage for each of ``counters``).

    ``sets`` is ``cube`` (every subset of the dimensions), ``rollup`` (every leading part), or the
    list of subsets wanted. ``level`` tells them apart: bit i from the right is set if the i-th
    last dimension is added up, so a null dimension is a total there and a value otherwise.
    ``counters`` are conditions whose rows are counted; a null condition is not met.
    """
    finest = frame.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias(ROWS), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items()))
    columns = [F.col(d) for d in dimensions]
    if sets == "cube":
        grouped = finest.cube(*columns)
    elif sets == "rollup":
        grouped = finest.rollup(*columns)
    else:
        grouped = finest.groupingSets([[F.col(d) for d in s] for s in sets], *columns)
    added = grouped.agg(F.grouping_id().cast("long").alias(LEVEL), *(F.sum(n).alias(n) for n in (ROWS, *counters)))
    return added.select(
        *dimensions, LEVEL, ROWS, *counters, *(percent(F.col(n), F.col(ROWS)).alias(f"{n}_percentage") for n in counters))


def missingness_levels(
    frame: DataFrame, dimensions: Sequence[str], fields: Sequence[str], sets: Sequence[Sequence[str]] | str = "cube"
) -> DataFrame:
    """Blank values of ``fields`` at every level of ``dimensions``."""
    types = {f.name: f.dataType for f in frame.schema.fields}
    return rolled_up(frame, dimensions, {f"missing_{f}": is_blank(F.col(f), types[f]) for f in fields}, sets)
