"""Queries over what is written and read back: landed records, evaluation report, incident texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import drift as D
from tidewatch.operators import faults, issues, volume
from tidewatch.operators.tables import split_table
from tidewatch.plans.feeds import read_table
from tidewatch.plans.monitor import evaluation_report
from tidewatch.plans.queries import (
    YEARS, _order_years, _rounded, _spiked_days, _stored, dirty_issues, evaluation, feed, query,
)
from tidewatch.sources import landing, sinks

#: Records of one array file.
ARRAY_ROWS = 5000


@query("records_roundtrip")
def _(spark, folder):
    """The feed landed half as files that hold an array, half with one object per line, then read.

    The first reader lands it, a second one finds the snapshot.
    """
    rows, path, store = feed(spark, folder).drop("row_id"), _stored(spark, "records"), _stored(spark, "store")
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    number = F.col("unique_key").cast("long")
    texts = rows.select(number.alias("number"), record.alias("value"))
    texts.where("number % 2 = 0").select("value").write.mode("append").text(path)
    arrays = texts.where("number % 2 = 1").groupBy(F.floor(F.col("number") / ARRAY_ROWS).alias("part")).agg(
        F.concat(F.lit("[\n"), F.concat_ws(",\n", F.collect_list("value")), F.lit("\n]")).alias("value"))
    arrays.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
    landing.load_or_ingest(spark, store, path)
    return landing.load_or_ingest(spark, store, path).drop("row_id")


@query("json_safe_values")
def _(spark, folder):
    """Numbers that JSON cannot hold, at every depth, written as one object per line and read back."""
    lines = read_table(spark, folder, "lineitem")
    odd = F.when(F.col("l_linenumber") % 4 == 1, F.lit(float("nan"))).when(
        F.col("l_linenumber") % 4 == 2, F.lit(float("inf"))).when(
        F.col("l_linenumber") % 4 == 3, F.lit(float("-inf"))).otherwise(F.col("l_quantity"))
    nested = lines.select(
        "l_orderkey", "l_linenumber", odd.alias("plain"), F.array(odd, F.col("l_tax")).alias("listed"),
        F.create_map(F.lit("k"), odd, F.lit("t"), F.col("l_discount")).alias("mapped"),
        F.array(F.struct(odd.alias("deep"), F.struct(odd.cast("float").alias("deeper")).alias("inner"))).alias("records"))
    path = _stored(spark, "json")
    sinks.json_safe(nested).write.option("ignoreNullFields", False).json(path)
    back = spark.read.schema(nested.schema).json(path)
    inner = F.col("records")[0]
    return back.select(
        "l_orderkey", "l_linenumber", "plain", F.col("listed")[0].alias("first"), F.col("listed")[1].alias("second"),
        F.col("mapped")["k"].alias("mapped_k"), F.col("mapped")["t"].alias("mapped_t"),
        inner["deep"].alias("deep"), inner["inner"]["deeper"].cast("double").alias("deeper"))


def _written_evaluation(spark, folder) -> DataFrame:
    """The evaluation report of the clean feed, written as a JSON document and read as text."""
    run = evaluation(spark, folder).settled()
    manifest = faults.manifest(faults.plan_faults(feed(spark, folder)))
    document = evaluation_report(run, manifest, {"latest_report_path": "none"}, 1.0)
    stable, _ = sinks.save_report(document, _stored(spark, "evaluation"), "latest_evaluation", "evaluation_report")
    return spark.read.text(stable)


@query("evaluation_fields")
def _(spark, folder):
    """The numbers of the evaluation report, read back from the written document."""
    names = ["true_positives", "true_negatives", "false_positives", "false_negatives", "precision", "recall", "f1_score",
             "false_positive_rate", "total_rows_evaluated", "peak_scenario_row_count", "manifest_scenario_count"]
    document = _written_evaluation(spark, folder)
    cells = F.array(*(F.struct(F.lit(n).alias("field"), F.get_json_object("value", f"$.{n}").cast("double").alias("number"))
                      for n in names))
    return document.select(F.explode(cells).alias("c")).select("c.field", F.round("c.number", 6).alias("number"))


@query("evaluation_outcomes")
def _(spark, folder):
    """Outcome of every scenario and issue type, and the scenario's rows and score, from the same document."""
    result = ("struct<scenario_name:string,row_count:long,reliability_score:long,"
              "issue_type_matrix:map<string,string>>")
    document = _written_evaluation(spark, folder)
    clean = F.array(F.from_json(F.get_json_object("value", "$.clean_baseline_result"), result))
    rest = F.from_json(F.get_json_object("value", "$.per_scenario_results"), f"array<{result}>")
    rows = document.select(F.explode(F.concat(clean, rest)).alias("r")).select("r.*")
    return rows.select(F.col("scenario_name").alias("scenario"), "row_count",
                       F.explode("issue_type_matrix").alias("issue_type", "outcome"))


def _texts(found: DataFrame) -> DataFrame:
    return found.select("issue_type", "severity", "affected_field", "expected_value", "description", "suggested_action")


@query("incident_texts")
def _(spark, folder):
    """What a validation incident says beside its numbers."""
    return _texts(issues.incidents(dirty_issues(spark, folder)))


@query("volume_incident_texts")
def _(spark, folder):
    return _texts(volume.volume_issues(_spiked_days(spark, folder)))


@query("drift_incident_texts")
def _(spark, folder):
    return _texts(_order_years(spark, folder).issues)


@query("disappearing_categories_years")
def _(spark, folder):
    """Order years that end: all orders against those from 1997 on."""
    orders = read_table(spark, folder, "orders").select(F.year("o_orderdate").cast("string").alias("order_year"), "o_orderkey")
    parts = split_table(orders, {"all": F.lit(True), "late": F.col("order_year") >= "1997"}, "o_orderkey")
    drift = D.detect_drift(parts, "all", ["late"], fields=("order_year",), limits=YEARS)
    return _rounded(D.disappearing_categories(drift.aligned, YEARS))
