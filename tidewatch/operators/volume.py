"""Daily volume: counts, baseline comparison and rolling history.

Rows are counted per day with map-side aggregation, so every later step works on
one row per scenario and day.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.catalog import (
    MINIMUM_ABSOLUTE_INCREASE,
    MINIMUM_PERIODS,
    ROLLING_WINDOW,
    STANDARDIZED_THRESHOLD,
)
from tidewatch.functions import calendar_day, to_utc_timestamp
from tidewatch.operators.incidents import worded
from tidewatch.operators.tables import MEMBERS, SCENARIO, Tables, literal_rows, stack_tables

DAY, COUNT = "calendar_date", "request_count"


def daily_counts(tables: Tables, date_column: str = "created_date") -> DataFrame:
    """Rows per scenario and UTC day; unreadable dates are left out."""
    holders = tables.holders(date_column)
    if not holders:
        return literal_rows(
            tables.spark, {SCENARIO: [], DAY: [], COUNT: []},
            f"{SCENARIO} string, {DAY} string, {COUNT} long",
        )
    day = calendar_day(to_utc_timestamp(F.col(date_column), tables.dtype(date_column)))
    counted = (
        tables.frame.select(MEMBERS, tables.where_present(F.lit(True), date_column).alias("ok"), day.alias(DAY))
        .where("ok")
        .groupBy(MEMBERS, DAY)
        .agg(F.count(DAY).alias(COUNT))
        .where(F.col(COUNT) > 0)  # a filter on the day itself would read every date twice
    )
    return tables.per_scenario(counted).groupBy(SCENARIO, DAY).agg(F.sum(COUNT).alias(COUNT))


def _gates(
    difference: Column, standardized: Column, minimum: float, threshold: float,
    increases: bool, decreases: bool,
) -> Column:
    flagged = F.lit(False)
    if increases:
        flagged = flagged | ((difference >= minimum) & (standardized >= threshold))
    if decreases:
        flagged = flagged | ((difference <= -minimum) & (standardized <= -threshold))
    return F.coalesce(flagged, F.lit(False))


def compare_daily(
    daily: DataFrame,
    baseline: str,
    scenarios: list[str],
    standardized_threshold: float = STANDARDIZED_THRESHOLD,
    minimum_absolute_increase: int = MINIMUM_ABSOLUTE_INCREASE,
    detect_increases: bool = True,
    detect_decreases: bool = False,
) -> DataFrame:
    """Set each scenario's days beside the baseline's; a day missing on one side counts 0.

    This is an outer alignment without a join: one grouping by day holds the counts of
    all scenarios, and days unknown to both sides of a pair are dropped.
    """
    per_name = {
        name: F.sum(F.when(F.col(SCENARIO) == name, F.col(COUNT)).otherwise(0))
        for name in dict.fromkeys([baseline, *scenarios])
    }
    columns = {name: f"n{i}" for i, name in enumerate(per_name)}
    by_day = daily.groupBy(DAY).agg(*(s.alias(columns[n]) for n, s in per_name.items()))
    pairs = F.explode(
        F.array(*(F.struct(F.lit(n).alias(SCENARIO), F.col(columns[n]).alias("n")) for n in scenarios))
    )
    base, current = F.col("baseline_count"), F.col("current_count")
    difference = current - base
    standardized = difference / F.sqrt(F.greatest(base, F.lit(1)))
    return (
        by_day.select(DAY, F.col(columns[baseline]).alias("baseline_count"), pairs.alias("p"))
        .select(f"p.{SCENARIO}", DAY, "baseline_count", F.col("p.n").alias("current_count"))
        .where((base > 0) | (current > 0))
        .select(
            "*",
            F.abs(difference).alias("absolute_difference"),
            F.when(base > 0, F.try_divide(difference, base) * 100).alias("percentage_change"),
            standardized.alias("standardized_count_difference"),
            _gates(difference, standardized, minimum_absolute_increase, standardized_threshold,
                   detect_increases, detect_decreases).alias("is_anomaly"),
        )
    )


def compare_volumes(
    baseline: DataFrame, current: DataFrame, date_column: str = "created_date", **options
) -> DataFrame:
    """Baseline against current for two tables; see ``compare_daily``."""
    pair = stack_tables({
        name: frame.select(date_column) if date_column in frame.columns else frame.limit(0)
        for name, frame in (("baseline", baseline), ("current", current))
    })
    daily = daily_counts(pair, date_column)
    return compare_daily(daily, "baseline", ["current"], **options).drop(SCENARIO)


def rolling_volume(
    daily: DataFrame,
    rolling_window: int = ROLLING_WINDOW,
    minimum_periods: int = MINIMUM_PERIODS,
    standardized_threshold: float = STANDARDIZED_THRESHOLD,
    minimum_absolute_increase: float = MINIMUM_ABSOLUTE_INCREASE,
    detect_increases: bool = True,
    detect_decreases: bool = False,
) -> DataFrame:
    """Each day against the mean and spread of the days before it.

    The frame counts the previous ``rolling_window`` *rows*, so days without any rows
    are not zeros. It runs over the aggregated days of a series, never over raw rows.
    """
    if minimum_periods > rolling_window:
        raise ValueError("minimum_periods must not exceed rolling_window.")
    history = Window.partitionBy(SCENARIO).orderBy(DAY).rowsBetween(-rolling_window, -1)
    count = F.col(COUNT).cast("double")
    periods = F.count(COUNT).over(history)
    enough = periods >= minimum_periods
    mean, spread = F.col("rolling_mean"), F.col("rolling_standard_deviation")
    usable = F.coalesce(spread > 0, F.lit(False))
    z_score = F.when(usable, F.try_divide(count - mean, spread))
    return (
        daily.withColumn("rolling_mean", F.when(enough, F.avg(count).over(history)))
        .withColumn("rolling_standard_deviation", F.when(enough, F.stddev_pop(count).over(history)))
        .select(
            SCENARIO, DAY, COUNT, "rolling_mean", "rolling_standard_deviation",
            z_score.alias("rolling_z_score"),
            usable.alias("history_sufficient"),
            _gates(count - mean, z_score, minimum_absolute_increase, standardized_threshold,
                   detect_increases, detect_decreases).alias("is_anomaly"),
        )
    )


def anomaly_days(records: DataFrame) -> DataFrame:
    return records.where("is_anomaly")


def volume_issues(
    records: DataFrame,
    date_column: str = "created_date",
    standardized_threshold: float = STANDARDIZED_THRESHOLD,
    minimum_absolute_increase: float = MINIMUM_ABSOLUTE_INCREASE,
) -> DataFrame:
    """Incident rows for flagged days, from a baseline comparison or a rolling history."""
    flagged = records.where("is_anomaly")
    if "rolling_mean" in records.columns:
        flagged = flagged.select(
            SCENARIO, DAY,
            F.col("rolling_mean").alias("baseline_count"),
            F.col(COUNT).alias("current_count"),
            F.abs(F.col(COUNT) - F.col("rolling_mean")).alias("absolute_difference"),
            F.lit(None).cast("double").alias("percentage_change"),
            F.col("rolling_z_score").alias("standardized_count_difference"),
        )
    expected = {
        "minimum_absolute_increase": minimum_absolute_increase,
        "standardized_threshold": standardized_threshold,
    }
    observed = F.to_json(
        F.struct(DAY, "baseline_count", "current_count", "absolute_difference",
                 "percentage_change", "standardized_count_difference"),
        {"ignoreNullFields": "false"},
    )
    return worded(flagged.select(
        SCENARIO,
        F.lit(0).alias("issue_seq"),
        F.lit("volume_anomaly").alias("issue_type"),
        F.lit("warning").alias("severity"),
        F.lit(date_column).alias("affected_field"),
        observed.alias("observed_value"),
        F.lit(json.dumps(expected)).alias("expected_value"),
        F.col("current_count").cast("long").alias("issue_count"),
        F.col("standardized_count_difference").cast("double").alias("observed_number"),
    ))
