"""Findings as incident rows, the verdict over them, and the reliability score."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import (
    HEALTHY_SCORE,
    INCIDENT_FIELDS,
    ISSUE_PENALTIES,
    SCHEMA_ISSUE_TYPES,
    WARNING_SCORE,
)
from tidewatch.contract import Contract
from tidewatch.functions import percent
from tidewatch.operators import checks as C
from tidewatch.operators.incidents import worded
from tidewatch.operators.profile import Profile, counted_cells, described, slot_of
from tidewatch.operators.schema import missing_columns, unexpected_columns
from tidewatch.operators.tables import SCENARIO, literal_rows

# What a value must be to pass a check, in terms of the contract.
EXPECTED = {
    C.INVALID_TIMESTAMP: {"readable_as": "timestamp"},
    C.INVALID_NUMERIC: {"readable_as": "number"},
    C.MISSING_KEY: {"blank": False},
    C.DUPLICATE_KEY: {"rows_per_key": 1},
    C.MISSING_VALUE: {"blank": False},
}


def _limit_number(value: float | None) -> float | int | None:
    return int(value) if value is not None and value == int(value) else value


def _schema_findings(profile: Profile) -> list[tuple]:
    """(scenario, seq, type, field, observed, expected): known from column names alone."""
    contract = profile.contract
    found = []
    for name, columns in profile.tables.columns.items():
        found += [(name, i, "missing_required_column", c, '{"present":false}', '{"present":true}')
                  for i, c in enumerate(missing_columns(columns, contract))]
        found += [(name, 1000 + i, "unexpected_column", c, '{"present":true}',
                   '{"present":false}')
                  for i, c in enumerate(unexpected_columns(columns, contract))]
    return found


def _countable(profile: Profile) -> list[tuple]:
    """(type, field, slot, expected JSON, limit) of every finding a counter can raise, in order.

    A finding is raised by a positive count, or, with a limit, by a share above it.
    """
    contract, tables = profile.contract, profile.tables
    rows = []

    def add(issue_type: str, field: str, slot: int, expected, limit: float | None = None) -> None:
        rows.append((issue_type, field, slot, json.dumps(expected), limit))

    for slot, check in enumerate(profile.checks):
        if check.kind in (C.INVALID_TIMESTAMP, C.INVALID_NUMERIC):
            add(check.kind, check.field, slot, EXPECTED[check.kind])
        elif check.kind == C.OUT_OF_RANGE:
            rule = contract.rule(check.field)
            add(check.kind, check.field, slot,
                {"minimum": _limit_number(rule.minimum), "maximum": _limit_number(rule.maximum)})
    if contract.key in tables.all_columns():
        add(C.MISSING_KEY, contract.key, slot_of(profile, C.BLANK, contract.key),
            EXPECTED[C.MISSING_KEY])
        add(C.DUPLICATE_KEY, contract.key, slot_of(profile, "duplicate_key_rows", ""),
            EXPECTED[C.DUPLICATE_KEY])
    for field in profile.fields_of(C.DATE_ORDER):
        add(C.DATE_ORDER, field, slot_of(profile, C.DATE_ORDER, field), contract.date_order.condition)
    for name in C.required_fields(tables, contract):
        add(C.MISSING_VALUE, name, slot_of(profile, C.BLANK, name), EXPECTED[C.MISSING_VALUE])
    for check in contract.checks:
        if check.column in tables.all_columns():
            add(check.name, check.column, slot_of(profile, check.name, check.column), {"fails_when": check.fails_when})
    for rule in contract.columns:
        if rule.max_missing is not None and rule.name in tables.all_columns():
            add("missingness_threshold_exceeded", rule.name, slot_of(profile, C.BLANK, rule.name),
                rule.max_missing, rule.max_missing)
    return rows


def validation_issues(profile: Profile, samples: DataFrame | None = None) -> DataFrame:
    """One row per finding, numbered in report order.

    ``samples`` (from ``quarantine.issue_samples``) adds up to ten row ids per
    finding; both sides of that join hold a few dozen rows at most.
    """
    spark = profile.tables.spark
    schema = (f"{SCENARIO} string, issue_seq int, issue_type string, affected_field string, "
              "observed_value string, expected_value string")
    static = literal_rows(
        spark, described(_schema_findings(profile), [c.split()[0] for c in schema.split(", ")]), schema
    ).select("*", F.lit(1).cast("long").alias("issue_count"), F.lit(1.0).alias("observed_number"))

    entries = [
        (name, slot, 2000 + seq, issue_type, field, expected, limit)
        for name in profile.tables.names
        for seq, (issue_type, field, slot, expected, limit) in enumerate(_countable(profile))
    ]
    names = (SCENARIO, "slot", "issue_seq", "issue_type", "affected_field", "expected_value", "limit")
    cells = counted_cells(
        profile, described(entries, names),
        "issue_seq int, issue_type string, affected_field string, expected_value string, limit double",
    )
    count, share = F.col("n"), F.col("share")
    by_share = F.col("limit").isNotNull()
    counted = (
        cells.withColumn("share", F.when(by_share, percent(count, F.col("total_rows"))))
        .where(F.when(by_share, share > F.col("limit")).otherwise(count > 0))
        .select(
            SCENARIO, "issue_seq", "issue_type", "affected_field",
            F.when(by_share, share.cast("string"))
            .otherwise(F.to_json(F.struct(count.alias("count")))).alias("observed_value"),
            "expected_value", count.alias("issue_count"),
            F.coalesce(share, count.cast("double")).alias("observed_number"),
        )
    )
    if samples is not None:
        counted = counted.join(F.broadcast(samples), ["issue_type", "affected_field"], "left").withColumn(
            "observed_value",
            F.when(F.col("sample_row_ids").isNotNull(),
                   F.to_json(F.struct(F.col("issue_count").alias("count"), "sample_row_ids")))
            .otherwise(F.col("observed_value")),
        ).drop("sample_row_ids")
    return worded(static.unionByName(counted).withColumn("severity", F.lit("error")))


def penalty(issue_type: Column, contract: Contract | None = None) -> Column:
    """Score penalty of an issue type, the contract's own included; zero for types without one."""
    chain = F.lit(0)
    own = {check.name: check.penalty for check in contract.checks} if contract else {}
    for name, points in {**ISSUE_PENALTIES, **own}.items():
        chain = F.when(issue_type == name, F.lit(points)).otherwise(chain)
    return chain


def health_status(score: Column) -> Column:
    return (
        F.when(score >= HEALTHY_SCORE, "Healthy")
        .when(score >= WARNING_SCORE, "Warning")
        .otherwise("Critical")
    )


def validation_verdict(issues: DataFrame, scenarios: DataFrame, contract: Contract | None = None) -> DataFrame:
    """Passed, schema passed, issue count, score and health, one row per scenario.

    The score takes a penalty per issue, whatever its row count; ``contract`` tells those of its
    own checks. Scenarios without
    any issue come from ``scenarios`` and pass with a full score.
    """
    schema_type = F.col("issue_type").isin(list(SCHEMA_ISSUE_TYPES))
    found = issues.groupBy(SCENARIO).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_if(schema_type).alias("schema_issues"),
        F.sum(penalty(F.col("issue_type"), contract)).alias("penalty"),
    )
    score = F.greatest(F.lit(0), F.least(F.lit(100), F.lit(100) - F.col("penalty"))).cast("int")
    return (
        scenarios.select(SCENARIO)
        .join(found, SCENARIO, "left")
        .na.fill(0)
        .select(
            SCENARIO,
            (F.col("issue_count") == 0).alias("validation_passed"),
            (F.col("schema_issues") == 0).alias("schema_passed"),
            "issue_count",
            score.alias("reliability_score"),
        )
        .withColumn("health_status", health_status(F.col("reliability_score")))
    )


def incidents(issues: DataFrame) -> DataFrame:
    """The incident table: severity first, nested values as JSON text."""
    order = ["severity", "issue_type", *[f for f in INCIDENT_FIELDS if f not in ("severity", "issue_type")]]
    return issues.select(SCENARIO, *order)
