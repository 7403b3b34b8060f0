"""Report documents and the tables a dashboard shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.catalog import INCIDENT_FIELDS, REPORT_VERSION
from tidewatch.operators.profile import Profile, exceeded_missingness, missingness, quality_metrics
from tidewatch.operators.tables import SCENARIO


def reliability_report(
    profile: Profile,
    issues: DataFrame,
    verdict: DataFrame,
    metadata: DataFrame,
    runtime_seconds: float | None = None,
) -> DataFrame:
    """The incident report as one nested row per scenario (a single table has one).

    Only issues and metrics go in: a few dozen values, whatever the size of the feed.
    """
    incidents = issues.groupBy(SCENARIO).agg(
        F.sort_array(F.collect_list(F.struct("issue_seq", *INCIDENT_FIELDS))).alias("numbered")
    ).select(
        SCENARIO,
        F.transform("numbered", lambda i: i.dropFields("issue_seq")).alias("incidents"),
    )
    shares = missingness(profile).groupBy(SCENARIO).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "missing_percentage"))))
        .alias("missing_value_percentages")
    )
    over = exceeded_missingness(profile).groupBy(SCENARIO).agg(
        F.map_from_entries(F.collect_list(F.struct(
            F.col("field"),
            F.struct("observed_missing_percentage", "maximum_missing_percentage"),
        ))).alias("columns_exceeding_missingness_thresholds")
    )
    metrics = quality_metrics(profile)
    names = [c for c in metrics.columns if c != SCENARIO]
    nested = (
        metrics.join(shares, SCENARIO, "left").join(over, SCENARIO, "left")
        .select(SCENARIO, F.col("total_rows_processed").alias("rows_processed"), F.struct(
            *names, F.col("invalid_numeric_row_count").alias("invalid_coordinate_row_count"),
            "missing_value_percentages", "columns_exceeding_missingness_thresholds",
        ).alias("quality_metrics"))
    )
    origin = metadata.select(F.struct(*metadata.columns).alias("m")).scalar()  # a single row
    seconds = F.lit(runtime_seconds).cast("double")
    return (
        verdict.join(nested, SCENARIO).join(incidents, SCENARIO, "left")
        .withColumn("ingestion_metadata", origin)
        .select(
            SCENARIO,
            F.lit(REPORT_VERSION).alias("report_version"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("run_timestamp_utc"),
            F.lit(profile.contract.dataset_id).alias("source_dataset_id"),
            F.col("ingestion_metadata.source_url").alias("source_url"),
            F.col("ingestion_metadata.latest_created_date").alias("latest_source_data_timestamp"),
            "rows_processed", "reliability_score", "health_status", "validation_passed",
            "schema_passed", "issue_count",
            F.coalesce("incidents", F.array()).alias("incidents"),
            "quality_metrics", "ingestion_metadata",
            F.round(seconds, 3).alias("pipeline_runtime_seconds"),
            F.round(F.try_divide(F.col("rows_processed"), seconds), 3)
            .alias("records_validated_per_second"),
        )
    )


def kpi_overview(verdict: DataFrame, profile: Profile, *extra: DataFrame) -> DataFrame:
    """Headline numbers as (metric, value) rows; ``extra`` tables add those of their single row."""
    base = verdict.join(quality_metrics(profile), SCENARIO).drop(SCENARIO)

    def listed(table: DataFrame) -> DataFrame:
        pairs = F.array(*(
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
            for c in table.columns
        ))
        return table.select(F.explode(pairs).alias("p")).select("p.*")

    return reduce(DataFrame.unionByName, (listed(t) for t in (base, *extra)))


def missingness_vs_threshold(profile: Profile) -> DataFrame:
    return missingness(profile).select(
        SCENARIO, "field", "missing_percentage", "threshold", "exceeded"
    )
