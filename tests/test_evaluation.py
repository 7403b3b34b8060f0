from __future__ import annotations

import json

import pytest
from conftest import KINDS, ROWS, clean_rows, to_frame
from pyspark.sql import functions as F

from tidewatch.catalog import CLEAN, SCENARIO_BY_NAME, SUPPORTED_ISSUE_TYPES
from tidewatch.operators import evaluation as E
from tidewatch.operators import faults
from tidewatch.operators.issues import validation_verdict
from tidewatch.operators.tables import literal_rows
from tidewatch.plans.evaluate import evaluate_faults, evaluate_tables
from tidewatch.plans.feeds import clean_feed, read_table
from tidewatch.plans.monitor import run_monitor
from tidewatch.sources.sinks import load_manifest


def spoiled(spark, feed):
    """Scenario tables with the labels they are said to deserve, not all of them rightly."""
    rows = clean_rows()

    def put(column, value, first, last):
        hit = F.col("row_id").between(first, last)
        return F.when(hit, F.lit(value)).otherwise(F.col(column))

    rush = [{**rows[20], "row_id": 500 + i, "unique_key": str(80_000 + i)} for i in range(250)]
    again = [{**rows[11], "row_id": 99}]
    late = to_frame(spark, rows + again).withColumn("created_date", put("created_date", "05/04/2031", 3, 4))
    return {
        "lost": (feed.drop("status").withColumn("longitude", put("longitude", "east", 7, 7)),
                 ["missing_required_column", "invalid_numeric_value"]),
        "messy": (late, ["invalid_timestamp", "duplicate_unique_key"]),
        "silent": (feed.withColumn("descriptor", put("descriptor", "", 0, 17)), ["missingness_threshold_exceeded"]),
        "rush": (to_frame(spark, rows + rush), ["volume_anomaly"]),
        "shifted": (feed.withColumn("complaint_type", put("complaint_type", KINDS[0], 0, 13))
                    .withColumn("note", F.lit(1)), ["category_drift", "unexpected_column"]),
        "unheard": (feed.withColumn("complaint_type", put("complaint_type", "Noise", 0, 13)),
                    ["unexpected_category", "invalid_date_order"]),
    }


@pytest.fixture(scope="module")
def six(spark, feed, contract):
    cases = spoiled(spark, feed)
    return evaluate_tables(feed, {n: f for n, (f, _) in cases.items()},
                           {n: e for n, (_, e) in cases.items()}, contract, "row_id")


def test_scenarios_are_scored_by_label(six):
    found = {}
    for r in six.detected.collect():
        found.setdefault(r.scenario, set()).add(r.issue_type)
    wanted = {n: set(e) for n, e in six.expected_types.items()}
    assert found == {**wanted, "rush": {"volume_anomaly", "category_drift"},
                     "unheard": {"unexpected_category", "category_drift"}}
    cells = len(SUPPORTED_ISSUE_TYPES) * 7
    hits = sum(len(wanted[n] & found[n]) for n in wanted)
    extra = sum(len(found[n] - wanted[n]) for n in wanted)
    missed = sum(len(wanted[n] - found[n]) for n in wanted)
    row = six.metrics.first()
    assert (row.true_positives, row.false_positives, row.false_negatives, row.true_negatives) == (
        hits, extra, missed, cells - hits - extra - missed)
    assert (row.precision, row.recall) == (round(hits / (hits + extra), 6), round(hits / (hits + missed), 6))
    assert row.f1_score == round(2 * hits / (2 * hits + extra + missed), 6)
    assert row.false_positive_rate == round(extra / (cells - hits - missed), 6)
    results = {r.scenario: r for r in six.results.collect()}
    assert {n for n, r in results.items() if not r.scenario_passed} == {"rush", "unheard"}
    assert results["rush"].row_count == ROWS + 250 and results["messy"].row_count == ROWS + 1
    rates = {r.issue_type: r.detection_rate for r in E.detection_rate(six.matrix).collect()}
    assert {t for t, rate in rates.items() if rate < 1} == {"invalid_date_order"}


def test_pending_scenarios_are_only_counted(spark, six):
    matrix = E.confusion_matrix(spark, six.names, six.expected, six.detected, ["shifted", "rush"])
    row = E.evaluation_metrics(matrix).first()
    assert (row.pending_scenario_count, row.true_positives, row.false_positives) == (2, 6, 1)
    results = E.scenario_results(matrix, six.expected, six.detected, six.row_counts)
    assert results.where("scenario = 'shifted'").first().scenario_passed is None


def test_unsupported_types_are_ignored(spark):
    found = literal_rows(spark, {"scenario": ["a"], "issue_type": ["Numeric-Out of-Range"]}, "scenario string, issue_type string")
    wanted = E.expected_labels(spark, {"a": []})
    matrix = E.confusion_matrix(spark, ["a"], wanted, E.detected_labels(found))
    assert {r.outcome for r in matrix.collect()} == {"true_negative"} and matrix.count() == 10
    assert E.scenario_results(matrix, wanted, E.detected_labels(found), found.select("scenario", F.lit(1).alias("row_count"))
                              ).first().detected_issue_types == "numeric_out_of_range"


def score(spark, types):
    found = literal_rows(spark, {"scenario": ["a"] * len(types), "issue_type": types}, "scenario string, issue_type string")
    return validation_verdict(found, literal_rows(spark, {"scenario": ["a"]}, "scenario string")).first()


@pytest.mark.parametrize("types,points,health", [
    (["invalid_date_order"], 90, "Healthy"), (["invalid_numeric_value", "unexpected_column"], 80, "Warning"),
    (["missing_required_value", "missing_unique_key", "unexpected_column"], 75, "Warning"),
    (["invalid_timestamp", "invalid_numeric_value"], 75, "Warning"), (["invalid_timestamp"] * 3, 70, "Critical"),
    (["numeric_out_of_range"] * 11, 0, "Critical"), (["category_drift", "something_else"], 100, "Healthy"),
])
def test_score(spark, types, points, health):
    row = score(spark, types)
    assert (row.reliability_score, row.health_status) == (points, health)


def test_range_issue_does_not_fail_the_schema(spark):
    assert score(spark, ["numeric_out_of_range"]).schema_passed
    assert not score(spark, ["invalid_timestamp"]).schema_passed
    assert not score(spark, ["numeric_out_of_range"]).validation_passed


@pytest.fixture(scope="module")
def five_thousand(spark):
    """Five thousand rows, the size the default fault sizes were made for."""
    events = read_table(spark, "/root/testdata/sf0.01", "events")
    return clean_feed(events.where("event_id < 5000"))


def test_twelve_scenarios_on_five_thousand_rows(five_thousand, contract):
    run = evaluate_faults(faults.plan_faults(five_thousand), contract)
    row = run.metrics.first()
    assert (row.true_positives, row.false_positives, row.false_negatives, row.true_negatives) == (13, 0, 0, 117)
    totals = E.scenario_totals(run.row_counts).first()
    assert (totals.total_rows_evaluated, totals.peak_scenario_row_count) == (65_600, 5_500)


def test_monitor_end_to_end(spark, five_thousand, tmp_path):
    run = run_monitor(five_thousand, str(tmp_path), source="events")
    assert run.rows_evaluated == 65_600 and run.rows_per_second > 0
    document = json.loads(spark.read.text(run.evaluation_report).first()[0])
    assert (document["precision"], document["recall"], document["f1_score"]) == (1.0, 1.0, 1.0)
    assert document["total_rows_evaluated"] == 65_600 and document["manifest_scenario_count"] == 12
    assert [r["scenario_name"] for r in document["per_scenario_results"]] == list(SCENARIO_BY_NAME)
    assert all(r["scenario_passed"] for r in document["per_scenario_results"])
    assert document["clean_baseline_result"]["quality_metrics"]["total_rows_processed"] == 5000
    report = json.loads(spark.read.text(run.report).first()[0])
    assert report["reliability_score"] == 100 and report["health_status"] == "Healthy"
    assert report["report_generation_time_seconds"] > 0
    assert spark.read.parquet(f"{document['report_paths']['result_tables_path']}/validation_issues").count() >= 9
    assert report["issue_count"] == 0 and report["incidents"] == [] and report["source_url"] == "events"
    assert report["quality_metrics"]["missing_value_percentages"]["descriptor"] == 2.0
    manifest = {r.scenario_name: r.affected_row_count for r in load_manifest(spark, str(tmp_path)).collect()}
    assert len(manifest) == 12
    assert spark.read.parquet(run.quarantine).count() == 0
    stored = spark.read.parquet(f"{tmp_path}/injected_rows")
    sizes = {r.scenario: r["count"] for r in stored.groupBy("scenario").count().collect()}
    assert sizes == {n: k for n, k in manifest.items() if n not in (faults.DROPPED, faults.RENAMED)}
    assert spark.read.parquet(f"{tmp_path}/tables/spike_sources").count() == manifest[faults.SPIKE]
    findings = spark.read.parquet(f"{tmp_path}/tables/drift_findings")
    assert findings.where("scenario = 'unseen_complaint_type_category' and kind = 'new'").count() == 1
