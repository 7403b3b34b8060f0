"""End-to-end jobs: report on a feed, and evaluate the monitor with injected faults."""

from __future__ import annotations

import time
from dataclasses import dataclass
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import CLEAN, REPORT_VERSION, SUPPORTED_ISSUE_TYPES
from tidewatch.contract import Contract, load_contract
from tidewatch.operators import evaluation as E
from tidewatch.operators import faults, quarantine
from tidewatch.operators.issues import validation_issues, validation_verdict
from tidewatch.operators.profile import profile
from tidewatch.operators.report import reliability_report
from tidewatch.operators.tables import SCENARIO, one_table
from tidewatch.plans.evaluate import Evaluation, evaluate_faults
from tidewatch.session import prepare
from tidewatch.sources import sinks
from tidewatch.sources.landing import ingestion_metadata


@dataclass(frozen=True)
class MonitorRun:
    """Where a run left its artifacts, and what it measured."""

    report: str
    evaluation_report: str
    manifest: str
    quarantine: str
    rows_evaluated: int
    seconds: float
    evaluation: Evaluation

    @property
    def rows_per_second(self) -> float:
        return self.rows_evaluated / self.seconds if self.seconds else 0.0


def report_feed(
    feed: DataFrame, folder: str, contract: Contract | None = None, row_id: str | None = "row_id",
    source: str = "", stamp: str | None = None,
) -> tuple[str, str, str]:
    """Validate a feed; write the report, its timestamped copy and the quarantine table."""
    prepare(feed.sparkSession)
    contract = contract or load_contract()
    started = time.perf_counter()
    tables = one_table(feed, row_id)
    checked = profile(tables, contract)
    has_id = row_id is not None or contract.key in feed.columns
    samples = quarantine.issue_samples(tables, contract) if has_id else None
    counters = f"{folder}/tables/feed_counters"
    checked.counters.write.mode("overwrite").parquet(counters)
    checked = type(checked)(
        feed.sparkSession.read.parquet(counters), checked.checks, tables, contract
    )  # no row_counters: the stored counters serve all
    issues = validation_issues(checked, samples)
    issues.write.mode("overwrite").parquet(f"{folder}/tables/feed_issues")
    issues = feed.sparkSession.read.parquet(f"{folder}/tables/feed_issues")
    kept = sinks.save_quarantine(quarantine.rejected_rows(tables, contract), folder)
    document = reliability_report(
        checked, issues, validation_verdict(issues, tables.names_frame(), contract),
        ingestion_metadata(feed.select(*tables.columns[tables.names[0]]), source),
        runtime_seconds=time.perf_counter() - started,
    ).drop(SCENARIO)
    generated = time.perf_counter()
    document.write.mode("overwrite").parquet(f"{folder}/tables/report_body")
    seconds = round(time.perf_counter() - generated, 3)
    document = feed.sparkSession.read.parquet(f"{folder}/tables/report_body").withColumn(
        "report_generation_time_seconds", F.lit(seconds))
    latest, snapshot = sinks.save_report(document, folder, "latest_report", "incident_report", stamp)
    return latest, snapshot, kept


def evaluation_report(run: Evaluation, manifest: DataFrame, paths: dict[str, str], seconds: float
                      ) -> DataFrame:
    """Scenario results, confusion matrix, rates and ground truth as one nested row."""
    cells = F.map_from_entries(F.sort_array(F.collect_list(F.struct("issue_type", "outcome"))))
    matrices = run.matrix.groupBy(SCENARIO).agg(cells.alias("issue_type_matrix"))
    results = run.results.join(matrices, SCENARIO).join(run.verdicts, SCENARIO).join(
        run.quality.select(SCENARIO, F.struct(
            *[c for c in run.quality.columns if c != SCENARIO]).alias("quality_metrics")), SCENARIO)
    fields = [F.col("scenario_position"), F.col(SCENARIO).alias("scenario_name"),
              *[F.col(c) for c in results.columns if c not in (SCENARIO, "scenario_position")]]
    in_order = F.array_sort(  # maps have no order, so the position decides
        F.collect_list(F.struct(*fields)), lambda a, b: a.scenario_position - b.scenario_position
    )
    listed = results.agg(in_order.alias("all_results"))
    rates = E.detection_rate(run.matrix).agg(
        F.sort_array(F.collect_list(F.struct(
            "type_position", "issue_type", "expected_incidents", "detected_expected_incidents",
            "detection_rate"))).alias("detection_rate_by_fault_type"))
    truth = manifest.agg(
        F.sort_array(F.collect_list(F.struct(*manifest.columns))).alias("generated_scenario_metadata"))
    totals = E.scenario_totals(run.results)
    row = run.metrics.withColumns({
        "all_results": listed.scalar(),
        "detection_rate_by_fault_type": rates.scalar(),
        "generated_scenario_metadata": truth.scalar(),
        "total_rows_evaluated": totals.select("total_rows_evaluated").scalar(),
        "peak_scenario_row_count": totals.select("peak_scenario_row_count").scalar(),
    })
    is_clean = F.filter("all_results", lambda r: r.scenario_name == CLEAN)
    speed = F.round(F.try_divide(F.col("total_rows_evaluated"), F.lit(seconds)), 3)
    return row.select(
        F.lit(REPORT_VERSION).alias("report_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("run_timestamp_utc"),
        F.get(is_clean, 0).alias("clean_baseline_result"),
        F.array(*(F.lit(t) for t in SUPPORTED_ISSUE_TYPES)).alias("supported_issue_types"),
        F.array(*(F.lit(t) for t in run.pending)).cast("array<string>").alias("pending_detector_types"),
        F.filter("all_results", lambda r: r.scenario_name != CLEAN).alias("per_scenario_results"),
        *run.metrics.columns,
        "detection_rate_by_fault_type", "total_rows_evaluated", "peak_scenario_row_count",
        F.lit(round(seconds, 6)).alias("total_pipeline_runtime_seconds"),
        speed.alias("records_validated_per_second"),
        F.struct(*(F.lit(v).alias(k) for k, v in paths.items())).alias("report_paths"),
        F.size("generated_scenario_metadata").alias("manifest_scenario_count"),
        "generated_scenario_metadata",
    )


def run_monitor(
    feed: DataFrame,
    folder: str,
    contract: Contract | None = None,
    row_id: str = "row_id",
    sizes: dict[str, int] | None = None,
    source: str = "",
) -> MonitorRun:
    """Validate the clean feed, inject the twelve faults, detect, score and report.

    Of the corrupted tables only the rows that differ from the feed are stored, under
    ``injected_rows/scenario=``; ``faults.rebuild`` makes whole tables of them. Detection
    works on the rows that scenarios share and reads the feed once per detector.
    """
    spark = prepare(feed.sparkSession)
    contract = contract or load_contract()
    stamp = sinks.utc_stamp()
    started = time.perf_counter()
    plan = faults.plan_faults(feed, row_id, sizes=sizes)
    rows_folder = f"{folder}/injected_rows"
    manifest = faults.manifest(plan, folder=rows_folder)
    manifest_path = sinks.save_manifest(manifest, folder, source)
    sinks.save_by_scenario(faults.changed_rows(plan), rows_folder)
    faults.spike_sources(plan).write.mode("overwrite").parquet(f"{folder}/tables/spike_sources")
    appended = spark.read.parquet(rows_folder).where(F.col(SCENARIO).isin(list(faults.APPENDING)))
    run = evaluate_faults(plan, contract, stored=appended).stored(f"{folder}/tables")
    rows = E.scenario_totals(run.results).first()["total_rows_evaluated"]
    seconds = time.perf_counter() - started
    latest, snapshot, kept = report_feed(feed, folder, contract, row_id, source, stamp)
    paths = {
        "latest_report_path": latest,
        "snapshot_report_path": snapshot,
        "latest_evaluation_path": f"{folder}/latest_evaluation",
        "snapshot_evaluation_path": f"{folder}/evaluation_report_{stamp}",
        "fault_manifest_path": manifest_path,
        # issues, volume records, drift verdicts and findings of every scenario
        "result_tables_path": f"{folder}/tables",
    }
    document = evaluation_report(run, manifest, paths, seconds)
    evaluation_path, _ = sinks.save_report(
        document, folder, "latest_evaluation", "evaluation_report", stamp
    )
    return MonitorRun(latest, evaluation_path, manifest_path, kept, rows, seconds, run)
