"""Drift of categorical fields against a baseline, for many fields and scenarios at once.

One grouping counts each (field, category) for all scenarios side by side; the outer
alignment of baseline and scenario is then a projection, not a join. Everything else
works on that table of distinct categories.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import (
    ALERT_ON_NEW_FIELDS,
    DRIFT_FIELDS,
    DRIFT_THRESHOLD,
    MINIMUM_FREQUENCY_CHANGE,
    MINIMUM_GONE_COUNT,
    MINIMUM_NEW_COUNT,
    MINIMUM_NEW_FREQUENCY,
    TOP_CATEGORY_LIMIT,
)
from tidewatch.functions import strip_text
from tidewatch.operators.incidents import worded
from tidewatch.operators.tables import MEMBERS, SCENARIO, Tables, literal_rows, stack_tables

FINDINGS_TABLE = "drift_findings"


@dataclass(frozen=True)
class DriftLimits:
    overall: float = DRIFT_THRESHOLD
    change: float = MINIMUM_FREQUENCY_CHANGE
    new_count: int = MINIMUM_NEW_COUNT
    new_frequency: float = MINIMUM_NEW_FREQUENCY
    gone_count: int = MINIMUM_GONE_COUNT


def category_counts(tables: Tables, fields: Sequence[str]) -> DataFrame:
    """Rows per (scenario, field, category); categories are stripped, blanks left out."""
    present = [f for f in fields if tables.holders(f)]
    if not present:
        return literal_rows(
            tables.spark, {SCENARIO: [], "field": [], "category": [], "n": []},
            f"{SCENARIO} string, field string, category string, n long",
        )
    pairs = F.array(*(
        F.struct(
            F.lit(f).alias("field"),
            F.when(tables.where_present(F.lit(True), f), strip_text(F.col(f))).alias("category"),
        )
        for f in present
    ))
    counted = (
        tables.frame.select(MEMBERS, F.explode(pairs).alias("p"))
        .select(MEMBERS, "p.field", "p.category")
        .where(F.col("category").isNotNull() & (F.col("category") != ""))
        .groupBy(MEMBERS, "field", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        tables.per_scenario(counted)
        .groupBy(SCENARIO, "field", "category")
        .agg(F.sum("n").alias("n"))
    )


def category_frequencies(counts: DataFrame) -> DataFrame:
    """Counts with their share of the non-blank rows of the same scenario and field."""
    totals = counts.groupBy(SCENARIO, "field").agg(F.sum("n").alias("total"))
    # One row per scenario and field: bounded by the configuration, not by the data.
    return counts.join(F.broadcast(totals), [SCENARIO, "field"]).select(
        SCENARIO, "field", "category", "n", (F.col("n") / F.col("total")).alias("frequency")
    )


def aligned_frequencies(
    counts: DataFrame, baseline: str, scenarios: Sequence[str]
) -> DataFrame:
    """Baseline and scenario counts and shares of every category either side has."""
    names = list(dict.fromkeys([baseline, *scenarios]))
    columns = {name: f"n{i}" for i, name in enumerate(names)}
    wide = counts.groupBy("field", "category").agg(*(
        F.sum(F.when(F.col(SCENARIO) == name, F.col("n")).otherwise(0)).alias(columns[name])
        for name in names
    ))
    pairs = F.explode(F.array(*(
        F.struct(F.lit(n).alias(SCENARIO), F.col(columns[n]).alias("n")) for n in scenarios
    )))
    pairwise = (
        wide.select("field", "category", F.col(columns[baseline]).alias("baseline_count"),
                    pairs.alias("p"))
        .select(f"p.{SCENARIO}", "field", "category", "baseline_count",
                F.col("p.n").alias("current_count"))
    )
    totals = pairwise.groupBy(SCENARIO, "field").agg(
        F.sum("baseline_count").alias("baseline_total"),
        F.sum("current_count").alias("current_total"),
    )

    def share(side: str) -> Column:
        total = F.col(f"{side}_total")
        ratio = F.try_divide(F.col(f"{side}_count"), total)
        return F.when(total > 0, ratio).otherwise(F.lit(0.0)).alias(f"{side}_frequency")

    # The totals again hold one row per scenario and field.
    return (
        pairwise.where((F.col("baseline_count") > 0) | (F.col("current_count") > 0))
        .join(F.broadcast(totals), [SCENARIO, "field"])
        .select(SCENARIO, "field", "category", "baseline_count", "current_count",
                share("baseline"), share("current"))
    )


def _flags(limits: DriftLimits) -> dict[str, Column]:
    base_n, now_n = F.col("baseline_count"), F.col("current_count")
    base_p, now_p = F.col("baseline_frequency"), F.col("current_frequency")
    return {
        "shifted": (base_n > 0) & (now_n > 0) & (F.abs(now_p - base_p) >= limits.change),
        "new": (base_n == 0)
        & ((now_n >= limits.new_count) | (now_p >= limits.new_frequency)),
        "gone": (now_n == 0) & (base_n >= limits.gone_count),
    }


def shifted_categories(aligned: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    return aligned.where(_flags(limits)["shifted"]).select(
        SCENARIO, "field", "category", "baseline_frequency", "current_frequency",
        F.abs(F.col("current_frequency") - F.col("baseline_frequency"))
        .alias("absolute_frequency_change"),
    )


def new_categories(aligned: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    return aligned.where(_flags(limits)["new"]).select(
        SCENARIO, "field", "category", F.col("current_count").alias("count"),
        F.col("current_frequency").alias("frequency"),
    )


def disappearing_categories(aligned: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    return aligned.where(_flags(limits)["gone"]).select(
        SCENARIO, "field", "category", "baseline_count", "baseline_frequency"
    )


def _divergence() -> Column:
    """One category's part of the base-2 Jensen-Shannon divergence."""
    base, now = F.col("baseline_frequency"), F.col("current_frequency")
    middle = (base + now) / 2

    def part(share: Column) -> Column:
        ratio = F.try_divide(share, middle)
        return F.when(share > 0, 0.5 * share * F.log2(ratio)).otherwise(F.lit(0.0))

    return part(base) + part(now)


def js_distance(aligned: DataFrame) -> DataFrame:
    """Jensen-Shannon distance per scenario and field, between 0 and 1."""
    return aligned.groupBy(SCENARIO, "field").agg(_distance().alias("jensen_shannon_distance"))


def _distance() -> Column:
    return F.sqrt(F.greatest(F.coalesce(F.sum(_divergence()), F.lit(0.0)), F.lit(0.0)))


def drift_verdict(
    aligned: DataFrame,
    tables: Tables,
    baseline: str,
    scenarios: Sequence[str],
    fields: Sequence[str] = DRIFT_FIELDS,
    limits: DriftLimits = DriftLimits(),
    alert_on_new: Sequence[str] = ALERT_ON_NEW_FIELDS,
) -> DataFrame:
    """Distance, finding counts and verdicts for every scenario and monitored field.

    A field that one side lacks is reported as unavailable, without drift.
    """
    flags = _flags(limits)
    found = aligned.groupBy(SCENARIO, "field").agg(
        _distance().alias("distance"),
        *(F.count_if(flag).alias(f"{name}_n") for name, flag in flags.items()),
    )
    pairs = [
        (name, position, f,
         f in tables.columns.get(baseline, ()) and f in tables.columns.get(name, ()))
        for name in scenarios
        for position, f in enumerate(fields)
    ]
    skeleton = literal_rows(
        tables.spark,
        dict(zip((SCENARIO, "field_position", "field", "field_available"), map(list, zip(*pairs)))),
        f"{SCENARIO} string, field_position int, field string, field_available boolean",
    )
    available = F.col("field_available")

    def known(name: str, default) -> Column:
        return F.when(available, F.coalesce(name, F.lit(default))).otherwise(F.lit(default))

    drift = (
        (F.col("jensen_shannon_distance") >= limits.overall)
        & ((F.col("shifted_count") > 0) | (F.col("disappearing_count") > 0))
    )
    unexpected = F.col("field").isin(list(alert_on_new)) & (F.col("new_count") > 0)
    return (
        skeleton.join(found, [SCENARIO, "field"], "left")
        .select(
            SCENARIO, "field_position", "field", "field_available",
            known("distance", 0.0).alias("jensen_shannon_distance"),
            known("shifted_n", 0).cast("long").alias("shifted_count"),
            known("new_n", 0).cast("long").alias("new_count"),
            known("gone_n", 0).cast("long").alias("disappearing_count"),
        )
        .select("*", drift.alias("category_drift"), unexpected.alias("unexpected_category"))
        .withColumn("drift_detected", F.col("category_drift") | F.col("unexpected_category"))
    )


def drift_findings(aligned: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """Every shifted, new and gone category with its counts and shares on both sides."""
    flags = _flags(limits)
    kind = F.when(flags["shifted"], "shifted").when(flags["new"], "new").when(flags["gone"], "gone")
    return aligned.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(
        SCENARIO, "field", "kind", "category", "baseline_count", "current_count",
        "baseline_frequency", "current_frequency",
    )


def drift_issues(verdict: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """Incident rows for drift and for unexpected categories, fields in configured order.

    An incident holds the distance and the counts of findings; the findings themselves, as
    many as a field has categories, are the table it names.
    """
    table = F.lit(FINDINGS_TABLE).alias("findings_table")
    drift_json = F.to_json(F.struct(
        "jensen_shannon_distance", "shifted_count", "disappearing_count", table))
    new_json = F.to_json(F.struct("new_count", table))
    drift_expected = {
        "maximum_jensen_shannon_distance": limits.overall,
        "minimum_absolute_category_frequency_change": limits.change,
    }
    new_expected = {
        "minimum_new_category_count": limits.new_count,
        "minimum_new_category_frequency": limits.new_frequency,
    }

    def incident(order: int, issue_type: str, observed: Column, expected: dict, count: Column,
                 number: Column) -> Column:
        return F.struct(
            (F.col("field_position") * 2 + order).alias("issue_seq"),
            F.lit(issue_type).alias("issue_type"),
            F.lit("warning").alias("severity"),
            F.col("field").alias("affected_field"),
            observed.alias("observed_value"),
            F.lit(json.dumps(expected)).alias("expected_value"),
            count.cast("long").alias("issue_count"),
            number.cast("double").alias("observed_number"),
        )

    rows = F.array_compact(F.array(
        F.when(F.col("category_drift"),
               incident(0, "category_drift", drift_json, drift_expected,
                        F.col("shifted_count") + F.col("disappearing_count"),
                        F.col("jensen_shannon_distance"))),
        F.when(F.col("unexpected_category"),
               incident(1, "unexpected_category", new_json, new_expected,
                        F.col("new_count"), F.col("new_count"))),
    ))
    found = verdict.where("drift_detected").select(SCENARIO, F.explode(rows).alias("i"))
    return worded(found.select(SCENARIO, "i.*"))


def top_categories(aligned: DataFrame, limit: int = TOP_CATEGORY_LIMIT) -> DataFrame:
    """Categories with the largest share on either side (a top-k plan)."""
    larger = F.greatest("baseline_frequency", "current_frequency")
    return aligned.orderBy(F.desc(larger), "category").limit(limit)


@dataclass(frozen=True)
class Drift:
    """The tables of one drift comparison."""

    aligned: DataFrame
    verdict: DataFrame
    limits: DriftLimits

    @property
    def issues(self) -> DataFrame:
        return drift_issues(self.verdict, self.limits)

    @property
    def findings(self) -> DataFrame:
        return drift_findings(self.aligned, self.limits)

    def settings(self) -> dict:
        return asdict(self.limits)


def detect_drift(
    tables: Tables,
    baseline: str,
    scenarios: Sequence[str],
    fields: Sequence[str] = DRIFT_FIELDS,
    limits: DriftLimits = DriftLimits(),
    alert_on_new: Sequence[str] = ALERT_ON_NEW_FIELDS,
) -> Drift:
    """Compare each scenario with the baseline on the monitored fields."""
    aligned = aligned_frequencies(category_counts(tables, fields), baseline, scenarios)
    for name in scenarios:
        absent = [f for f in fields
                  if f not in tables.columns.get(baseline, ()) or f not in tables.columns.get(name, ())]
        if absent:
            aligned = aligned.where((F.col(SCENARIO) != name) | ~F.col("field").isin(absent))
    verdict = drift_verdict(aligned, tables, baseline, scenarios, fields, limits, alert_on_new)
    return Drift(aligned, verdict, limits)


def compare_distributions(
    baseline: DataFrame, current: DataFrame, fields: Sequence[str] = DRIFT_FIELDS,
    limits: DriftLimits = DriftLimits(), alert_on_new: Sequence[str] = ALERT_ON_NEW_FIELDS,
) -> Drift:
    """Two tables, side by side."""
    pair = stack_tables({
        "baseline": baseline.select(*(f for f in fields if f in baseline.columns)),
        "current": current.select(*(f for f in fields if f in current.columns)),
    })
    return detect_drift(pair, "baseline", ["current"], fields, limits, alert_on_new)
