"""Scoring detectors against known ground truth with a multi-label confusion matrix.

All tables here have at most one row per scenario and issue type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import SUPPORTED_ISSUE_TYPES
from tidewatch.functions import normalize_label, safe_ratio
from tidewatch.operators.tables import SCENARIO, literal_rows


def detected_labels(*issue_tables: DataFrame) -> DataFrame:
    """Distinct normalised issue types per scenario over all detectors."""
    parts = [t.select(SCENARIO, normalize_label(F.col("issue_type")).alias("issue_type"))
             for t in issue_tables]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def expected_labels(spark: SparkSession, expected: Mapping[str, Sequence[str]]) -> DataFrame:
    pairs = [(name, label) for name, labels in expected.items() for label in labels]
    frame = literal_rows(
        spark,
        {SCENARIO: [p[0] for p in pairs], "issue_type": [p[1] for p in pairs]},
        f"{SCENARIO} string, issue_type string",
    )
    return frame.select(SCENARIO, normalize_label(F.col("issue_type")).alias("issue_type"))


def confusion_matrix(
    spark: SparkSession,
    scenarios: Sequence[str],
    expected: DataFrame,
    detected: DataFrame,
    pending: Sequence[str] = (),
) -> DataFrame:
    """One outcome per scenario and supported issue type. Other types are ignored.

    Skeleton, expectations and detections are stacked and grouped, so no join is needed.
    """
    cells = [(i, s, j, t) for i, s in enumerate(scenarios)
             for j, t in enumerate(SUPPORTED_ISSUE_TYPES)]
    skeleton = literal_rows(
        spark,
        dict(zip(("scenario_position", SCENARIO, "type_position", "issue_type"),
                 map(list, zip(*cells)))),
        f"scenario_position int, {SCENARIO} string, type_position int, issue_type string",
    )

    def flagged(frame: DataFrame, is_expected: bool, is_detected: bool) -> DataFrame:
        return frame.select(
            *(F.col(c) if c in frame.columns else F.lit(None).cast("int").alias(c)
              for c in skeleton.columns),
            F.lit(is_expected).alias("expected"),
            F.lit(is_detected).alias("detected"),
        )

    stacked = (
        flagged(skeleton, False, False)
        .unionByName(flagged(expected, True, False))
        .unionByName(flagged(detected, False, True))
    )
    outcome = (
        F.when(F.col("expected") & F.col("detected"), "true_positive")
        .when(F.col("expected"), "false_negative")
        .when(F.col("detected"), "false_positive")
        .otherwise("true_negative")
    )
    status = F.when(F.col(SCENARIO).isin(list(pending)), "pending").otherwise("evaluated")
    return (
        stacked.groupBy(SCENARIO, "issue_type")
        .agg(
            F.max("scenario_position").alias("scenario_position"),
            F.max("type_position").alias("type_position"),
            F.max("expected").alias("expected"),
            F.max("detected").alias("detected"),
        )
        .where(F.col("type_position").isNotNull())
        .select("*", outcome.alias("outcome"), status.alias("evaluation_status"))
    )


def scenario_results(
    matrix: DataFrame, expected: DataFrame, detected: DataFrame, row_counts: DataFrame
) -> DataFrame:
    """Per scenario: expected and detected types as text, status, verdict and row count."""

    def listed(frame: DataFrame, name: str) -> DataFrame:
        text = F.concat_ws(", ", F.array_sort(F.collect_set("issue_type")))
        return frame.groupBy(SCENARIO).agg(text.alias(name))

    verdict = matrix.groupBy(SCENARIO, "scenario_position", "evaluation_status").agg(
        F.every(F.col("expected") == F.col("detected")).alias("agrees")
    )
    return (
        verdict.join(listed(expected, "expected_issue_types"), SCENARIO, "left")
        .join(listed(detected, "detected_issue_types"), SCENARIO, "left")
        .join(row_counts, SCENARIO, "left")
        .select(
            SCENARIO, "scenario_position",
            F.coalesce("expected_issue_types", F.lit("")).alias("expected_issue_types"),
            F.coalesce("detected_issue_types", F.lit("")).alias("detected_issue_types"),
            "evaluation_status",
            F.when(F.col("evaluation_status") == "evaluated", F.col("agrees")).alias("scenario_passed"),
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
        )
    )


def evaluation_metrics(matrix: DataFrame) -> DataFrame:
    """Counts and rates over all evaluated scenarios; pending ones are only counted."""
    live = F.col("evaluation_status") == "evaluated"

    def tally(name: str):
        return F.count_if(live & (F.col("outcome") == name)).alias(f"{name}s")

    counted = matrix.agg(
        *(tally(n) for n in ("true_positive", "false_positive", "false_negative", "true_negative")),
        F.count_distinct(F.when(~live, F.col(SCENARIO))).alias("pending_scenario_count"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    return counted.select(
        tp, fp, fn, tn,
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        safe_ratio(fp, fp + tn).alias("false_positive_rate"),
        tp.alias("detected_expected_incidents"),
        (tp + fn).alias("total_expected_incidents"),
        "pending_scenario_count",
    )


def detection_rate(matrix: DataFrame) -> DataFrame:
    """How many of the expected incidents of each type were found."""
    live = F.col("evaluation_status") == "evaluated"
    return (
        matrix.groupBy("type_position", "issue_type")
        .agg(
            F.count_if(live & F.col("expected")).alias("expected_incidents"),
            F.count_if(live & (F.col("outcome") == "true_positive"))
            .alias("detected_expected_incidents"),
        )
        .select(
            "type_position", "issue_type", "expected_incidents", "detected_expected_incidents",
            safe_ratio(F.col("detected_expected_incidents"), F.col("expected_incidents"))
            .alias("detection_rate"),
        )
    )


def scenario_totals(row_counts: DataFrame) -> DataFrame:
    return row_counts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows_evaluated"),
        F.coalesce(F.max("row_count"), F.lit(0)).alias("peak_scenario_row_count"),
    )
