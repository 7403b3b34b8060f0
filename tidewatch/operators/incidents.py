"""Wording of incidents, made from what was checked, how often it failed, and where to look."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import INCIDENT_FIELDS, QUARANTINE, WHERE_FOUND
from tidewatch.operators.tables import SCENARIO


def _where_found(issue_type: Column, field: Column) -> Column:
    by_reason = F.concat(F.lit(f"{QUARANTINE}, reason "), issue_type, F.lit(":"), field)
    return reduce(
        lambda rest, item: F.when(issue_type == item[0], F.lit(item[1])).otherwise(rest),
        WHERE_FOUND.items(), by_reason,
    )


def worded(issues: DataFrame) -> DataFrame:
    """Issue rows with ``description`` and ``suggested_action``, in the common column order."""
    kind, field = F.col("issue_type"), F.col("affected_field")
    told = F.concat(
        F.lit("Check "), kind, F.lit(" on "), field, F.lit(" counts "), F.col("issue_count").cast("string"),
        F.lit("; expected: "), F.coalesce("expected_value", F.lit("none")),
    )
    action = F.concat(F.lit("See "), _where_found(kind, field), F.lit("."))
    return issues.withColumn("description", told).withColumn("suggested_action", action).select(
        SCENARIO, "issue_seq", *INCIDENT_FIELDS, "issue_count", "observed_number"
    )
