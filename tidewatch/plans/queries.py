"""Every operator as a query over the given tables; doubles are rounded for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.catalog import CLEAN
from tidewatch.contract import ColumnRule, Contract, load_contract
from tidewatch.functions import normalize_label, to_utc_timestamp
from tidewatch.operators import checks as C
from tidewatch.operators import drift as D
from tidewatch.operators import evaluation as E
from tidewatch.operators import faults, issues, quarantine, report, volume
from tidewatch.operators import profile as P
from tidewatch.operators.duplicates import duplicate_rows
from tidewatch.operators.sampling import sample_with_replacement, seeded_sample
from tidewatch.operators.tables import SCENARIO, one_table, split_table, stack_tables
from tidewatch.plans.evaluate import Evaluation, evaluate_faults
from tidewatch.plans.feeds import clean_feed, dirty_feed, read_table
from tidewatch.session import prepare, shared_folder
from tidewatch.sources import landing, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        run.__name__ = name
        REGISTRY[name] = run
        return function

    return register


def feed(spark: SparkSession, folder: str) -> DataFrame:
    return clean_feed(read_table(spark, folder, "events"))


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    return dirty_feed(read_table(spark, folder, "events"))


def dirty_table(spark, folder):
    return one_table(dirty(spark, folder), "row_id")


def dirty_profile(spark, folder) -> P.Profile:
    return P.profile(dirty_table(spark, folder), load_contract())


def r6(name: str) -> Column:
    return F.round(name, 6).alias(name)


# --- ingestion -----------------------------------------------------------------
@query("ingest_project")
def _(spark, folder):
    """A landed table with an extra column and without one of the requested columns."""
    raw = feed(spark, folder).drop("incident_zip").withColumn("resolution", F.lit("n/a"))
    return landing.project_requested(raw)


@query("recent_top_n")
def _(spark, folder):
    return landing.most_recent(feed(spark, folder).drop("row_id"))


@query("ingest_metadata")
def _(spark, folder):
    return landing.ingestion_metadata(feed(spark, folder).drop("row_id"), "events")


@query("ingest_metadata_dirty")
def _(spark, folder):
    """Among unreadable dates the newest readable one counts."""
    return landing.ingestion_metadata(dirty(spark, folder).drop("row_id"), "events")


def _stored(spark, name: str) -> str:
    """A new folder for a query that writes a table and reads it again."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("snapshot_roundtrip")
def _(spark, folder):
    """The dirty feed, landed as a snapshot and read from its stable place."""
    latest, _ = sinks.save_snapshot(dirty(spark, folder), _stored(spark, "snapshot"))
    return spark.read.parquet(latest)


@query("csv_roundtrip")
def _(spark, folder):
    """A feed whose descriptors hold quotes and line breaks, written as CSV and read again."""
    told = F.concat_ws("\n", F.col("descriptor"), F.concat(F.lit('said "'), "status", F.lit('", then')))
    rows = feed(spark, folder).withColumn("descriptor", told)
    path = sinks.save_scenario_csv(rows, _stored(spark, "csv"), "feed")
    return landing.read_csv(spark, path)


@query("scenario_roundtrip")
def _(spark, folder):
    """A scenario's table, rebuilt from the feed and the stored rows that differ."""
    clean = feed(spark, folder)
    plan = faults.plan_faults(clean, names=[faults.REVERSED, faults.DUPLICATED])
    path = sinks.save_by_scenario(faults.changed_rows(plan, list(plan.draws)), _stored(spark, "rows"))
    return faults.rebuild(clean, spark.read.parquet(path), faults.REVERSED)


# --- predicates ----------------------------------------------------------------
@query("blank_rows")
def _(spark, folder):
    table = dirty_table(spark, folder)
    blanks = [F.when(c.condition, F.lit(c.field)) for c in C.blank_checks(table)]
    return table.frame.select("row_id", F.concat_ws(",", *blanks).alias("blank_fields")).where(
        F.col("blank_fields") != ""
    )


def _cells(table, kind: str) -> DataFrame:
    """(row_id, field, value) of the cells that fail one kind of type check."""
    cells = [
        F.when(c.condition, F.struct(F.lit(c.field).alias("field"),
                                     F.col(c.field).cast("string").alias("value")))
        for c in C.type_checks(table, load_contract()) if c.kind == kind
    ]
    found = F.explode(F.array_compact(F.array(*cells)))
    return table.frame.select("row_id", found.alias("c")).select("row_id", "c.*")


@query("invalid_timestamps")
def _(spark, folder):
    return _cells(dirty_table(spark, folder), C.INVALID_TIMESTAMP)


@query("invalid_numerics")
def _(spark, folder):
    return _cells(dirty_table(spark, folder), C.INVALID_NUMERIC)


@query("numeric_out_of_range")
def _(spark, folder):
    return _cells(dirty_table(spark, folder), C.OUT_OF_RANGE)


@query("numeric_out_of_range_customer")
def _(spark, folder):
    """The range check on a typed column: negative account balances."""
    contract = Contract(columns=(ColumnRule("c_acctbal", "numeric", minimum=0.0),))
    table = one_table(read_table(spark, folder, "customer"), "c_custkey")
    check = next(c for c in C.type_checks(table, contract) if c.kind == C.OUT_OF_RANGE)
    return table.frame.where(check.condition).select("c_custkey", "c_acctbal")


@query("date_order_violations")
def _(spark, folder):
    table = dirty_table(spark, folder)
    check, = C.date_order_checks(table, load_contract())
    return table.frame.where(check.condition).select("row_id", "created_date", "closed_date")


@query("date_order_violations_lineitem")
def _(spark, folder):
    """Lines shipped before their order was placed."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    text = "yyyy-MM-dd HH:mm:ss"
    return joined.where(
        to_utc_timestamp(F.col("l_shipdate"), joined.schema["l_shipdate"].dataType)
        < to_utc_timestamp(F.col("o_orderdate"), joined.schema["o_orderdate"].dataType)
    ).select(
        "l_orderkey", "l_linenumber",
        F.date_format("o_orderdate", text).alias("ordered"),
        F.date_format("l_shipdate", text).alias("shipped"),
    )


@query("schema_issues")
def _(spark, folder):
    """A defective feed that also lost one column and carries another under a new name."""
    broken = dirty(spark, folder).drop("agency").withColumnRenamed("complaint_type", "complaint_category")
    found = issues.validation_issues(P.profile(one_table(broken, "row_id"), load_contract()))
    return found.select("issue_type", "affected_field", "severity", "observed_value", "issue_count")


@query("normalize_labels")
def _(spark, folder):
    """Category labels rewritten in ways people type them, brought back to one form."""
    types = read_table(spark, folder, "orders").select("o_orderpriority")
    return (
        types.select(normalize_label(F.concat(F.lit("  "), "o_orderpriority", F.lit(" - Type "))).alias("label"))
        .groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    )


# --- quality metrics -----------------------------------------------------------
@query("missing_keys")
def _(spark, folder):
    shares = P.missingness(dirty_profile(spark, folder)).where(F.col("field") == load_contract().key)
    return shares.select(
        F.col("total_rows").alias("total_rows_processed"),
        F.col("missing_count").alias("missing_unique_key_count"),
    )


@query("missing_required_values")
def _(spark, folder):
    profile = dirty_profile(spark, folder)
    required = C.required_fields(profile.tables, profile.contract)
    shares = P.missingness(profile).where(F.col("field").isin(required) & (F.col("missing_count") > 0))
    return shares.select("field", "missing_count")


@query("missingness")
def _(spark, folder):
    return P.missingness(dirty_profile(spark, folder)).select(
        "field", "total_rows", "missing_count", "missing_percentage"
    )


@query("missingness_exceeded")
def _(spark, folder):
    return P.exceeded_missingness(dirty_profile(spark, folder)).drop(SCENARIO)


@query("missingness_vs_threshold")
def _(spark, folder):
    return report.missingness_vs_threshold(dirty_profile(spark, folder)).drop(SCENARIO)


@query("datatype_profile")
def _(spark, folder):
    return P.datatype_profile(dirty_profile(spark, folder)).drop(SCENARIO)


@query("duplicate_rows")
def _(spark, folder):
    return duplicate_rows(dirty(spark, folder).drop("row_id"))


@query("duplicate_rows_documents")
def _(spark, folder):
    """Documents whose whole text and language repeat."""
    return duplicate_rows(read_table(spark, folder, "documents"), ["text", "lang"])


@query("duplicate_keys")
def _(spark, folder):
    return quarantine.repeated_keys(dirty(spark, folder), ["unique_key"], text_key=True)


@query("duplicate_keys_lineitem")
def _(spark, folder):
    return quarantine.repeated_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_key_rows")
def _(spark, folder):
    rows = dirty(spark, folder).select("row_id", "unique_key", "created_date")
    return quarantine.duplicate_key_rows(rows, ["unique_key"], text_key=True, row_id="row_id")


@query("duplicate_key_rows_lineitem")
def _(spark, folder):
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return quarantine.duplicate_key_rows(lines, ["l_orderkey", "l_linenumber"])


@query("duplicate_key_rows_part")
def _(spark, folder):
    """A typed key with many repeats: parts of one retail price, zero with either sign."""
    parts = read_table(spark, folder, "part").select("p_partkey", "p_retailprice")
    signed = F.when(F.col("p_partkey") % 100 == 0, F.lit(0.0)).when(
        F.col("p_partkey") % 100 == 1, F.lit(-0.0)).otherwise(F.floor("p_retailprice").cast("double"))
    keyed = parts.select("p_partkey", signed.alias("price"))
    return quarantine.duplicate_key_rows(keyed, ["price"], row_id="p_partkey").select("p_partkey")


@query("quality_metrics")
def _(spark, folder):
    return P.quality_metrics(dirty_profile(spark, folder)).drop(SCENARIO)


@query("quality_metrics_clean")
def _(spark, folder):
    table = one_table(feed(spark, folder), "row_id")
    return P.quality_metrics(P.profile(table, load_contract())).drop(SCENARIO)


# --- rejection, issues, score ----------------------------------------------------
@query("rejected_rows")
def _(spark, folder):
    rows = quarantine.rejected_rows(dirty_table(spark, folder), load_contract())
    return rows.select("row_id", F.concat_ws(",", quarantine.REASONS).alias("reasons"))


@query("rejected_count")
def _(spark, folder):
    return P.quality_metrics(dirty_profile(spark, folder)).select("rejected_row_count")


@query("rejected_preview")
def _(spark, folder):
    rows = quarantine.rejected_preview(dirty_table(spark, folder), load_contract())
    return rows.withColumn(quarantine.REASONS, F.concat_ws(",", quarantine.REASONS))


@query("issue_samples")
def _(spark, folder):
    samples = quarantine.issue_samples(dirty_table(spark, folder), load_contract())
    ids = F.concat_ws(",", F.col("sample_row_ids").cast("array<string>"))
    return samples.withColumn("sample_row_ids", ids)


def dirty_issues(spark, folder) -> DataFrame:
    table = dirty_table(spark, folder)
    samples = quarantine.issue_samples(table, load_contract())
    return issues.validation_issues(P.profile(table, load_contract()), samples)


@query("validation_issues")
def _(spark, folder):
    return dirty_issues(spark, folder).select(
        "issue_type", "severity", "affected_field", "observed_value", "issue_count",
        r6("observed_number"),
    )


def _verdicts(spark, folder) -> DataFrame:
    """Clean and dirty feed judged together."""
    both = stack_tables(
        {"clean": feed(spark, folder), "dirty": dirty(spark, folder)}, row_id="row_id"
    )
    found = issues.validation_issues(P.profile(both, load_contract()))
    return issues.validation_verdict(found, both.names_frame())


@query("validation_verdict")
def _(spark, folder):
    return _verdicts(spark, folder).select(SCENARIO, "validation_passed", "schema_passed", "issue_count")


@query("reliability_score")
def _(spark, folder):
    return _verdicts(spark, folder).select(
        SCENARIO, F.col("reliability_score").cast("long").alias("reliability_score"), "health_status"
    )


@query("incidents")
def _(spark, folder):
    found = issues.incidents(dirty_issues(spark, folder))
    return found.select("severity", "issue_type", "affected_field", "observed_value")


@query("report_json")
def _(spark, folder):
    """The whole report of the dirty feed as one JSON document."""
    table = dirty_table(spark, folder)
    profile = P.profile(table, load_contract())
    found = issues.validation_issues(profile, quarantine.issue_samples(table, load_contract()))
    verdict = issues.validation_verdict(found, table.names_frame())
    metadata = landing.ingestion_metadata(table.data.drop("row_id"), "events")
    document = report.reliability_report(profile, found, verdict, metadata)
    names = [c for c in document.columns if c not in (SCENARIO, "run_timestamp_utc")]
    return document.select(
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("report")
    )


@query("report_fields")
def _(spark, folder):
    """The report of the dirty feed, read back from its JSON text field by field."""
    columns = [f"quality_metrics.missing_value_percentages.{c.name}" for c in load_contract().columns]
    metrics = [f"quality_metrics.{c}" for c in P.quality_metrics(dirty_profile(spark, folder)).columns if c != SCENARIO]
    paths = ["source_url", "latest_source_data_timestamp", "rows_processed", "reliability_score", "health_status",
             "validation_passed", "schema_passed", "issue_count", *metrics, *columns]
    cells = F.array(*(
        F.struct(F.lit(p).alias("field"), F.get_json_object("report", f"$.{p}").alias("value")) for p in paths))
    return REGISTRY["report_json"](spark, folder).select(F.explode(cells).alias("c")).select("c.*")


@query("report_incidents")
def _(spark, folder):
    """The incidents of the same report, in order."""
    schema = "array<struct<issue_type:string,severity:string,affected_field:string,observed_value:string>>"
    listed = F.from_json(F.get_json_object("report", "$.incidents"), schema)
    return REGISTRY["report_json"](spark, folder).select(F.explode(listed).alias("i")).select("i.*")


@query("kpi_overview")
def _(spark, folder):
    profile = dirty_profile(spark, folder)
    verdict = issues.validation_verdict(
        issues.validation_issues(profile), profile.tables.names_frame()
    )
    return report.kpi_overview(verdict, profile)


@query("kpi_overview_evaluation")
def _(spark, folder):
    """Headline numbers of the clean feed beside those of the evaluation."""
    run = evaluation(spark, folder).settled()
    clean = run.verdicts.where(F.col(SCENARIO) == CLEAN)
    return report.kpi_overview(clean, run.profile, run.metrics, E.scenario_totals(run.row_counts))


# --- daily volume ----------------------------------------------------------------
def _event_days(spark, folder) -> DataFrame:
    """Events with even ids as the baseline, with odd ids as the current side."""
    events = read_table(spark, folder, "events").select("event_id", "ts")
    even = F.col("event_id") % 2 == 0
    return volume.daily_counts(split_table(events, {"baseline": even, "current": ~even}, "event_id"), "ts")


def _compare(daily, base, current, **options):
    records = volume.compare_daily(daily, base, [current], **options).drop(SCENARIO)
    return records.withColumns({
        "percentage_change": r6("percentage_change"),
        "standardized_count_difference": r6("standardized_count_difference"),
    })


@query("daily_counts")
def _(spark, folder):
    return volume.daily_counts(one_table(feed(spark, folder), "row_id")).drop(SCENARIO)


@query("daily_counts_orders")
def _(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return volume.daily_counts(one_table(orders, "o_orderkey"), "o_orderdate").drop(SCENARIO)


@query("volume_compare")
def _(spark, folder):
    return _compare(_event_days(spark, folder), "baseline", "current")


@query("volume_compare_decrease")
def _(spark, folder):
    """Gates low enough that ordinary days trip them, in both directions."""
    return _compare(
        _event_days(spark, folder), "baseline", "current", detect_decreases=True,
        standardized_threshold=0.5, minimum_absolute_increase=5,
    )


ROLLING = {"standardized_threshold": 1.5, "minimum_absolute_increase": 10}


def _rolling(spark, folder, **options):
    daily = volume.daily_counts(one_table(feed(spark, folder), "row_id"))
    records = volume.rolling_volume(daily, **ROLLING, **options).drop(SCENARIO)
    return records.withColumns({c: r6(c) for c in (
        "rolling_mean", "rolling_standard_deviation", "rolling_z_score")})


@query("volume_rolling")
def _(spark, folder):
    return _rolling(spark, folder)


@query("volume_rolling_decrease")
def _(spark, folder):
    return _rolling(spark, folder, detect_increases=False, detect_decreases=True)


def _spiked_days(spark, folder) -> DataFrame:
    clean = feed(spark, folder)
    plan = faults.plan_faults(clean, names=[faults.SPIKE])
    tables = faults.fan_out(plan, [faults.SPIKE])
    return volume.compare_daily(volume.daily_counts(tables), CLEAN, [faults.SPIKE])


@query("volume_issues")
def _(spark, folder):
    found = volume.volume_issues(_spiked_days(spark, folder))
    return found.select(
        "issue_type", "severity", "affected_field", "issue_count", r6("observed_number"),
        F.get_json_object("observed_value", "$.calendar_date").alias("calendar_date"),
        F.get_json_object("observed_value", "$.baseline_count").cast("long").alias("baseline_count"),
    )


@query("volume_anomaly_days")
def _(spark, folder):
    return volume.anomaly_days(_spiked_days(spark, folder)).select(
        "calendar_date", "baseline_count", "current_count", "absolute_difference"
    )


# --- drift -------------------------------------------------------------------------
def _half_months(spark, folder) -> D.Drift:
    """First against second half of the month, both monitored fields."""
    rows = feed(spark, folder)
    early = F.substring("created_date", 9, 2) < "16"
    return D.detect_drift(split_table(rows, {"first": early, "second": ~early}, "row_id"), "first", ["second"])


YEARS = D.DriftLimits(overall=0.05, change=0.02)


def _order_years(spark, folder) -> D.Drift:
    """Order years that overlap only in part, so that categories come and go."""
    orders = read_table(spark, folder, "orders").select(
        F.year("o_orderdate").cast("string").alias("order_year"), "o_orderpriority"
    )
    year = F.col("order_year")
    return D.detect_drift(
        split_table(orders, {"until_1995": year <= "1995", "from_1994": year >= "1994"}),
        "until_1995", ["from_1994"],
        fields=("order_year", "o_orderpriority"), limits=YEARS, alert_on_new=("order_year",),
    )


def _rounded(frame: DataFrame) -> DataFrame:
    doubles = [f.name for f in frame.schema.fields if f.dataType.simpleString() == "double"]
    return frame.drop(SCENARIO).withColumns({
        c: F.round(c, 9 if c == "jensen_shannon_distance" else 6) for c in doubles
    })


@query("category_frequencies")
def _(spark, folder):
    tables = one_table(feed(spark, folder), "row_id")
    return _rounded(D.category_frequencies(D.category_counts(tables, ("complaint_type", "borough"))))


@query("category_frequencies_documents")
def _(spark, folder):
    tables = one_table(read_table(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id")
    return _rounded(D.category_frequencies(D.category_counts(tables, ("lang", "source"))))


@query("category_frequencies_labels")
def _(spark, folder):
    tables = one_table(read_table(spark, folder, "labels"), "doc_id")
    return _rounded(D.category_frequencies(D.category_counts(tables, ("quality", "toxic"))))


@query("js_distance")
def _(spark, folder):
    return _rounded(D.js_distance(_half_months(spark, folder).aligned))


@query("shifted_categories")
def _(spark, folder):
    return _rounded(D.shifted_categories(_order_years(spark, folder).aligned, YEARS))


@query("new_categories")
def _(spark, folder):
    return _rounded(D.new_categories(_order_years(spark, folder).aligned, YEARS))


@query("disappearing_categories")
def _(spark, folder):
    return _rounded(D.disappearing_categories(_order_years(spark, folder).aligned, YEARS))


@query("disappearing_categories_documents")
def _(spark, folder):
    """Sources of the longer documents that shorter ones lack."""
    docs = read_table(spark, folder, "documents").select(
        F.concat_ws("-", "lang", "source").alias("origin"), "doc_id", "n_chars")
    long_ones = F.col("n_chars") > 500
    parts = split_table(docs, {"long": long_ones, "short": ~long_ones}, "doc_id")
    limits = D.DriftLimits(gone_count=1)
    drift = D.detect_drift(parts, "long", ["short"], fields=("origin",), limits=limits)
    return _rounded(D.disappearing_categories(drift.aligned, limits))


@query("drift_verdict")
def _(spark, folder):
    return _rounded(_order_years(spark, folder).verdict.drop("field_position"))


@query("drift_multi_field")
def _(spark, folder):
    return _rounded(_half_months(spark, folder).verdict.drop("field_position"))


@query("drift_issues")
def _(spark, folder):
    found = _order_years(spark, folder).issues
    seen = lambda name: F.get_json_object("observed_value", f"$.{name}").cast("long").alias(name)
    return found.select(
        "issue_type", "severity", "affected_field", "issue_count",
        F.round("observed_number", 9).alias("observed_number"),
        seen("shifted_count"), seen("disappearing_count"), seen("new_count"),
        F.get_json_object("observed_value", "$.findings_table").alias("findings_table"),
    )


@query("drift_findings")
def _(spark, folder):
    """Every finding of a field with as many categories as there are suppliers and parts."""
    lines = read_table(spark, folder, "lineitem").select(
        F.concat_ws("/", "l_suppkey", F.col("l_partkey") % 16).alias("source"), "l_returnflag"
    )
    returned = F.col("l_returnflag") == "A"
    parts = split_table(lines, {"returned": returned, "other": ~returned})
    limits = D.DriftLimits(change=1e-5, new_count=2, gone_count=2)
    drift = D.detect_drift(parts, "returned", ["other"], fields=("source",), limits=limits)
    return _rounded(drift.findings)


@query("top_categories")
def _(spark, folder):
    """Suppliers with the largest share of returned or of other lines."""
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("supplier"), "l_returnflag"
    )
    returned = F.col("l_returnflag") == "A"
    parts = split_table(lines, {"returned": returned, "other": ~returned})
    drift = D.detect_drift(parts, "returned", ["other"], fields=("supplier",))
    return _rounded(D.top_categories(drift.aligned)).drop("field")


# --- fault injection -----------------------------------------------------------------
@query("seeded_sample")
def _(spark, folder):
    return seeded_sample(feed(spark, folder), 137, 7, "row_id")


@query("sample_with_replacement")
def _(spark, folder):
    """Independent draws from the opened (not yet closed) rows, one row per pick."""
    rows = feed(spark, folder).where(F.col("status") == "Open").select("row_id", "created_date")
    population = rows.count()
    return sample_with_replacement(rows, population // 2, population, 7, "row_id", independent=True)


FAULT_QUERIES = {
    "fault_drop_column": faults.DROPPED,
    "fault_rename_column": faults.RENAMED,
    "fault_invalid_numeric": faults.BAD_NUMBER,
    "fault_duplicate_rows": faults.DUPLICATED,
    "fault_invalid_timestamp": faults.BAD_DATE,
    "fault_missingness_10": "descriptor_missingness_plus_10_points",
    "fault_missingness_25": "descriptor_missingness_plus_25_points",
    "fault_missingness_50": "descriptor_missingness_plus_50_points",
    "fault_volume_spike": faults.SPIKE,
    "fault_category_shift": faults.SHIFT,
    "fault_unseen_category": faults.UNSEEN,
    "fault_reversed_dates": faults.REVERSED,
}


def _fault(scenario: str) -> Query:
    def run(spark, folder):
        return faults.inject(faults.plan_faults(feed(spark, folder), names=[scenario]), scenario)

    return run


for _name, _scenario in FAULT_QUERIES.items():
    query(_name)(_fault(_scenario))


@query("fault_manifest")
def _(spark, folder):
    found = faults.manifest(faults.plan_faults(feed(spark, folder)))
    return found.select(
        "scenario_name", "fault_type",
        F.concat_ws(",", "expected_issue_types").alias("expected_issue_types"),
        F.concat_ws(",", "affected_columns").alias("affected_columns"),
        "affected_row_count", "random_seed",
        "baseline_missingness_percentage", "resulting_missingness_percentage",
    )


@query("affected_rows")
def _(spark, folder):
    """Ground truth of all scenarios that change or append rows."""
    plan = faults.plan_faults(feed(spark, folder))
    names = [n for n in faults.SCENARIO_BY_NAME if n not in (faults.DROPPED, faults.RENAMED)]
    parts = [faults.affected_rows(plan, n) for n in names]
    return reduce(DataFrame.unionByName, parts)


@query("spike_sources")
def _(spark, folder):
    return faults.spike_sources(faults.plan_faults(feed(spark, folder), names=[faults.SPIKE]))


@query("changed_rows")
def _(spark, folder):
    """Every row a scenario changes or appends, as it is afterwards."""
    return faults.changed_rows(faults.plan_faults(feed(spark, folder)))


# --- evaluation ----------------------------------------------------------------------
def evaluation(spark, folder) -> Evaluation:
    return evaluate_faults(faults.plan_faults(feed(spark, folder)), load_contract())


@query("detected_labels")
def _(spark, folder):
    return evaluation(spark, folder).detected


@query("confusion_matrix")
def _(spark, folder):
    return evaluation(spark, folder).matrix.select(
        SCENARIO, "issue_type", "expected", "detected", "outcome"
    )


@query("scenario_results")
def _(spark, folder):
    return evaluation(spark, folder).settled().results.drop("scenario_position")


@query("scenario_totals")
def _(spark, folder):
    return E.scenario_totals(evaluation(spark, folder).row_counts)


@query("evaluation_metrics")
def _(spark, folder):
    return evaluation(spark, folder).metrics


@query("detection_rate")
def _(spark, folder):
    return evaluation(spark, folder).matrix.transform(E.detection_rate).drop("type_position")


@query("scenario_quality_metrics")
def _(spark, folder):
    """Validation counters of the clean feed and all twelve scenarios, from one scan."""
    return evaluation(spark, folder).quality
