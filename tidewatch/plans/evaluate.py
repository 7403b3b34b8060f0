"""Validation, volume and drift over many scenarios at once, and their scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import CLEAN, DRIFT_FIELDS, SCENARIO_BY_NAME
from tidewatch.contract import Contract
from tidewatch.operators import evaluation as E
from tidewatch.operators import faults
from tidewatch.operators.drift import Drift, DriftLimits, detect_drift, drift_verdict
from tidewatch.operators.issues import validation_issues, validation_verdict
from tidewatch.operators.profile import Profile, profile, quality_metrics
from tidewatch.operators.tables import MEMBERS, SCENARIO, Tables, stack_tables
from tidewatch.operators.volume import compare_daily, daily_counts, volume_issues
from tidewatch.session import cut_lineage


@dataclass(frozen=True)
class Evaluation:
    """Lazy tables of one evaluation run. ``tables`` holds the clean feed and all scenarios.

    ``narrow`` may give the same tables cut down to some columns, for detectors that
    look at few of them.
    """

    tables: Tables
    contract: Contract
    expected_types: Mapping[str, Sequence[str]]
    pending: tuple[str, ...] = ()
    fields: Sequence[str] = DRIFT_FIELDS
    limits: DriftLimits = DriftLimits()
    narrow: Callable[[Sequence[str]], Tables] | None = None

    def _with_columns(self, *columns: str) -> Tables:
        return self.tables if self.narrow is None else self.narrow(columns)

    @property
    def names(self) -> list[str]:
        return list(self.tables.names)

    @cached_property
    def profile(self) -> Profile:
        return profile(self.tables, self.contract)

    @cached_property
    def validation_issues(self) -> DataFrame:
        return validation_issues(self.profile)

    @cached_property
    def volume_records(self) -> DataFrame:
        daily = daily_counts(self._with_columns("created_date"))
        return compare_daily(daily, CLEAN, self.names)

    @cached_property
    def drift(self) -> Drift:
        tables = self._with_columns(*self.fields)
        return detect_drift(tables, CLEAN, self.names, self.fields, self.limits)

    @cached_property
    def drift_labels(self) -> DataFrame:
        kinds = F.array_compact(F.array(
            F.when(F.col("category_drift"), "category_drift"),
            F.when(F.col("unexpected_category"), "unexpected_category"),
        ))
        return self.drift.verdict.select(SCENARIO, F.explode(kinds).alias("issue_type"))

    @cached_property
    def detected(self) -> DataFrame:
        return E.detected_labels(
            self.validation_issues, volume_issues(self.volume_records), self.drift_labels
        )

    @cached_property
    def expected(self) -> DataFrame:
        return E.expected_labels(self.tables.spark, self.expected_types)

    @cached_property
    def row_counts(self) -> DataFrame:
        tables = self._with_columns()
        counted = tables.per_scenario(
            tables.frame.groupBy(MEMBERS).agg(F.count(F.lit(1)).alias("row_count"))
        ).groupBy(SCENARIO).agg(F.sum("row_count").alias("row_count"))
        return self.tables.names_frame().join(counted, SCENARIO, "left").na.fill(0).select(
            SCENARIO, "row_count"
        )

    @cached_property
    def matrix(self) -> DataFrame:
        return E.confusion_matrix(
            self.tables.spark, self.names, self.expected, self.detected, self.pending
        )

    @property
    def results(self) -> DataFrame:
        rows = self.profile.counters.select(SCENARIO, F.col("total_rows").alias("row_count"))
        return E.scenario_results(self.matrix, self.expected, self.detected, rows)

    @property
    def metrics(self) -> DataFrame:
        return E.evaluation_metrics(self.matrix)

    @property
    def verdicts(self) -> DataFrame:
        return validation_verdict(self.validation_issues, self.tables.names_frame(), self.contract)

    @property
    def quality(self) -> DataFrame:
        return quality_metrics(self.profile)

    def settled(self) -> Evaluation:
        """Run the detectors now and go on from their small results.

        For answers that use several of them: each detector then reads the feed once.
        """
        kept = replace(self)
        kept.__dict__["profile"] = replace(
            self.profile, counters=cut_lineage(self.profile.counters), row_counters=None, key_counters=None)
        kept.__dict__["volume_records"] = cut_lineage(self.volume_records)
        kept.__dict__["drift"] = replace(self.drift, verdict=cut_lineage(self.drift.verdict))
        return kept

    def stored(self, folder: str) -> Evaluation:
        """Write the small result tables once and go on from the written ones.

        Reports read them several times; without this each would repeat the checks.
        """
        spark = self.tables.spark
        kept = replace(self)

        def keep(name: str, frame: DataFrame) -> DataFrame:
            path = f"{folder}/{name}"
            frame.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)

        kept.__dict__["profile"] = replace(
            self.profile, counters=keep("counters", self.profile.counters), row_counters=None, key_counters=None
        )
        kept.__dict__["validation_issues"] = keep(
            "validation_issues", validation_issues(kept.profile)
        )
        kept.__dict__["volume_records"] = keep("volume_records", self.volume_records)
        aligned = keep("category_frequencies", self.drift.aligned)
        verdict = drift_verdict(
            aligned, self.tables, CLEAN, self.names, self.fields, self.limits
        )
        kept.__dict__["drift"] = Drift(aligned, keep("drift_verdict", verdict), self.limits)
        keep("drift_findings", kept.drift.findings)
        kept.__dict__["matrix"] = keep("confusion_matrix", kept.matrix)
        return kept


def evaluate_tables(
    clean: DataFrame,
    scenarios: Mapping[str, DataFrame],
    expected: Mapping[str, Sequence[str]],
    contract: Contract,
    row_id: str | None = None,
    pending: Sequence[str] = (),
) -> Evaluation:
    """Given scenario tables, as read from storage, beside the clean feed."""
    tables = stack_tables({CLEAN: clean, **scenarios}, row_id)
    return Evaluation(tables, contract, expected, tuple(pending))


def evaluate_faults(
    plan: faults.FaultPlan, contract: Contract, names: Sequence[str] | None = None,
    stored: DataFrame | None = None,
) -> Evaluation:
    """All injected scenarios plus the clean baseline, from one scan of the feed.

    ``stored`` are the rows that scenarios append, if they were written before; else each
    detector draws them anew.
    """
    names = list(names or SCENARIO_BY_NAME)
    tables = faults.fan_out(plan, names, appended=stored)
    return Evaluation(
        tables, contract, {n: SCENARIO_BY_NAME[n].expected for n in names},
        narrow=lambda columns: faults.fan_out(plan, names, appended=stored, only=columns),
    )
