"""Summaries that add up: kept for each day, merged for any span without its rows.

Distinct counts (HyperLogLog) and quantiles (KLL) are Spark's own sketches, one binary for each
group and field. Frequent values are found through slots: values are hashed to ``SLOTS`` slots
and the rows of a slot counted. A value has at most its slot's rows, so a slot below the share
holds no frequent value, and at most 1 / share slots can hold one; a second pass counts their
values exactly. No value at or above the share is lost, and no other is reported.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12
#: Three standard errors of a distinct count, as a share of it.
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(1 << LG_SIZE)
KLL_SIZE = 400
#: Rank error of a quantile, as a share of all rows, for KLL_SIZE.
RANK_ERROR = 0.01
SLOTS = 1 << 16


def summaries(frame: DataFrame, by: Sequence[str], fields: Sequence[str], numbers: Sequence[str] = ()) -> DataFrame:
    """(by..., field, n, distinct_state, quantile_state): one row for each group and field.

    ``n`` counts the values that are not null. Fields in ``numbers`` also have a quantile state.
    All states come from one grouping.
    """
    aggregates = []
    for i, name in enumerate(fields):
        aggregates += [F.count(name).alias(f"n{i}"), F.hll_sketch_agg(F.col(name).cast("string"), LG_SIZE).alias(f"d{i}")]
        if name in numbers:
            aggregates.append(F.kll_sketch_agg_double(F.col(name).cast("double"), KLL_SIZE).alias(f"q{i}"))
    grouped = frame.groupBy(*by).agg(*aggregates)
    cells = F.array(*(F.struct(
        F.lit(name).alias("field"), F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("distinct_state"),
        (F.col(f"q{i}") if name in numbers else F.lit(None).cast("binary")).alias("quantile_state"))
        for i, name in enumerate(fields)))
    return grouped.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States added up over all groups but ``by``."""
    with_quantiles = F.when(F.col("n") > 0, F.col("quantile_state"))
    return states.groupBy(*by, "field").agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_state").alias("distinct_state"),
        F.when(F.count(with_quantiles) > 0, F.kll_merge_agg_double(with_quantiles)).alias("quantile_state"))


def distinct_counts(states: DataFrame) -> DataFrame:
    """``states`` with ``distinct_estimate``, within DISTINCT_ERROR of the count."""
    return states.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_state"))


def quantile(states: DataFrame, share: float) -> DataFrame:
    """``states`` with ``quantile``: a value whose rank is within RANK_ERROR of ``share``; null without a state."""
    return states.withColumn("quantile", F.kll_sketch_get_quantile_double("quantile_state", F.lit(share).cast("double")))


def slot_counts(frame: DataFrame, fields: Sequence[str], by: Sequence[str] = (), slots: int = SLOTS) -> DataFrame:
    """(by..., field, slot, n): the summary of frequent values; groups add up."""
    values = F.explode(F.array(*(
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    cells = frame.select(*by, values.alias("v")).where("v.value is not null")
    slot = F.pmod(F.xxhash64("v.value"), F.lit(slots))
    return cells.groupBy(*by, "v.field", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))


def frequent_values(
    frame: DataFrame, fields: Sequence[str], share: float, slotted: DataFrame | None = None, slots: int = SLOTS
) -> DataFrame:
    """(field, value, n, total): every value with at least ``share`` of its field's rows.

    ``slotted`` is a stored summary of the same rows, such as the sum of daily ones; without it
    it is made first. Nulls are not values and do not count.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    slotted = slot_counts(frame, fields, slots=slots) if slotted is None else slotted
    slotted = slotted.groupBy("field", "slot").agg(F.sum("n").alias("n"))
    totals = slotted.groupBy("field").agg(F.sum("n").alias("total"))
    # at most 1 / share slots of each field
    full = slotted.join(F.broadcast(totals), "field").where(F.col("n") >= F.col("total") * share).select("field", "slot", "total")
    values = F.explode(F.array(*(
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    rows = frame.select(values.alias("v")).select("v.*").where("value is not null")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("value"), F.lit(slots))).join(F.broadcast(full), ["field", "slot"])
    counted = rows.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"))
    return counted.where(F.col("n") >= F.col("total") * share)
