from __future__ import annotations

import json

import pytest
from conftest import ROWS, as_set, clean_rows, to_frame
from pyspark.sql import functions as F

from tidewatch.contract import ColumnRule, Contract, load_contract
from tidewatch.operators import issues as I
from tidewatch.operators import profile as P
from tidewatch.operators import quarantine as Q
from tidewatch.operators.duplicates import duplicate_rows
from tidewatch.operators.tables import one_table, stack_tables


def check(frame, contract, row_id="row_id"):
    tables = one_table(frame, row_id)
    profile = P.profile(tables, contract)
    return profile, I.validation_issues(profile)


def types(frame, contract):
    return as_set(check(frame, contract)[1], "issue_type")


def metrics(frame, contract):
    return P.quality_metrics(check(frame, contract)[0]).first()


def test_clean_feed_passes(feed, contract):
    profile, found = check(feed, contract)
    verdict = I.validation_verdict(found, profile.tables.names_frame()).first()
    assert verdict.validation_passed and verdict.schema_passed
    assert (verdict.reliability_score, verdict.health_status) == (100, "Healthy")


# value, rows it is put into (from row 5 on), the finding it makes and how many rows that counts
SPOILED = [
    ("latitude", "12,5", 3, "invalid_numeric_value", 3),
    ("latitude", "-90.5", 2, "numeric_out_of_range", 2),
    ("longitude", "180.001", 1, "numeric_out_of_range", 1),
    ("closed_date", "31.12.2031", 4, "invalid_timestamp", 4),
    ("closed_date", "2031-05-03T23:59:59Z", 6, "invalid_date_order", 6),
    ("borough", "\t", 2, "missing_required_value", 2),
    ("unique_key", "\n ", 5, "missing_unique_key", 5),
    ("unique_key", "7000", 2, "duplicate_unique_key", 3),
    ("descriptor", None, 4, "missingness_threshold_exceeded", 4),
]


@pytest.mark.parametrize("column,value,rows,finding,count", SPOILED)
def test_spoiled_values_are_found_and_counted(feed, contract, column, value, rows, finding, count):
    hit = F.col("row_id").between(5, 4 + rows)
    broken = feed.withColumn(column, F.when(~hit, F.col(column)).otherwise(F.lit(value)))
    found = {r.issue_type: r.issue_count for r in check(broken, contract)[1].collect()
             if column in r.affected_field}
    assert found[finding] == count
    assert set(found) <= {finding, "missingness_threshold_exceeded"}


@pytest.mark.parametrize("column", ["status", "incident_zip"])
def test_columns_that_go_or_come(feed, contract, column):
    assert as_set(check(feed.drop(column), contract)[1], "issue_type", "affected_field") == {
        ("missing_required_column", column)}
    assert as_set(check(feed.withColumn("note", F.col(column)), contract)[1], "issue_type", "affected_field") == {
        ("unexpected_column", "note")}


def test_rejected_rows_are_distinct(spark, contract):
    rows = clean_rows()
    rows[0].update(unique_key=None, created_date="bad-date")
    rows[1].update(closed_date="2025-12-31T00:00:00.000")
    frame = to_frame(spark, rows)
    assert {"missing_unique_key", "invalid_timestamp", "invalid_date_order"} <= types(frame, contract)
    rejected = {r.row_id: r.reject_reasons
                for r in Q.rejected_rows(one_table(frame, "row_id"), contract).collect()}
    assert set(rejected) == {0, 1}
    assert rejected[0] == ["invalid_timestamp:created_date", "missing_unique_key:unique_key"]
    assert metrics(frame, contract).rejected_row_count == 2


def test_duplicate_rows_and_keys_stay_apart(spark, contract):
    rows = clean_rows()
    rows.append({**rows[0], "row_id": ROWS})
    found = metrics(to_frame(spark, rows), contract)
    assert (found.duplicate_row_count, found.duplicate_row_percentage) == (1, 2.7)
    assert (found.duplicate_unique_key_count, found.duplicate_unique_key_percentage) == (2, 5.41)
    assert found.rejected_row_count == 2


def test_absent_columns_do_not_break_dependent_checks(feed, contract):
    found = types(feed.drop("created_date", "latitude"), contract)
    assert found == {"missing_required_column"}


def test_empty_table(spark, feed, contract):
    profile, found = check(feed.limit(0), contract)
    assert found.count() == 0
    row = P.quality_metrics(profile).first()
    assert row.total_rows_processed == 0 and row.duplicate_row_percentage == 0.0
    assert {r.missing_percentage for r in P.missingness(profile).collect()} == {0.0}
    assert I.validation_verdict(found, profile.tables.names_frame()).first().validation_passed


def test_issue_order_and_fields(spark, contract):
    rows = clean_rows()
    rows[0].update(created_date="x", latitude="y", agency=" ")
    rows[1].update(latitude="91", unique_key="")
    rows[2].update(unique_key=rows[3]["unique_key"])
    rows[4].update(closed_date="2020-01-01")
    frame = to_frame(spark, rows).drop("status").withColumn("extra", F.lit(1))
    found = check(frame, contract)[1].orderBy("issue_seq").collect()
    assert [(r.issue_type, r.affected_field) for r in found] == [
        ("missing_required_column", "status"), ("unexpected_column", "extra"),
        ("invalid_timestamp", "created_date"), ("invalid_numeric_value", "latitude"),
        ("numeric_out_of_range", "latitude"), ("missing_unique_key", "unique_key"),
        ("duplicate_unique_key", "unique_key"), ("invalid_date_order", "closed_date/created_date"),
        ("missing_required_value", "agency"), ("missingness_threshold_exceeded", "unique_key"),
        ("missingness_threshold_exceeded", "agency"),
    ]
    assert {r.severity for r in found} == {"error"}
    assert all(r.description and r.suggested_action for r in found)
    by_type = {r.issue_type: r for r in found}
    assert json.loads(by_type["numeric_out_of_range"].expected_value) == {"minimum": -90, "maximum": 90}
    assert by_type["missingness_threshold_exceeded"].observed_value == "2.78"


def test_samples_hold_at_most_ten_smallest_ids(spark, feed, contract):
    frame = feed.withColumn("latitude", F.lit("bad"))
    sample, = Q.issue_samples(one_table(frame, "row_id"), contract).collect()
    assert (sample.issue_type, sample.affected_field) == ("invalid_numeric_value", "latitude")
    assert sample.sample_row_ids == list(range(10))
    found = I.validation_issues(P.profile(one_table(frame, "row_id"), contract),
                                Q.issue_samples(one_table(frame, "row_id"), contract))
    observed = json.loads(found.where("issue_type = 'invalid_numeric_value'").first().observed_value)
    assert observed == {"count": ROWS, "sample_row_ids": list(range(10))}


def test_preview_is_ordered(feed, contract):
    rows = Q.rejected_preview(one_table(feed.withColumn("agency", F.lit("")), "row_id"), contract, 3)
    assert [r.row_id for r in rows.collect()] == [0, 1, 2]


def test_key_serves_as_row_id(feed, contract):
    frame = feed.drop("row_id").withColumn("latitude", F.lit("bad"))
    sample, = Q.issue_samples(one_table(frame), contract).collect()
    assert sample.sample_row_ids[0] == "7000"


def test_results_do_not_depend_on_partitioning(feed, contract):
    broken = feed.withColumn("agency", F.when(F.col("row_id") % 3 == 0, " ").otherwise(F.col("agency")))
    results = [sorted(map(tuple, check(f, contract)[1].collect()))
               for f in (broken, broken.repartition(7, "borough"), broken.coalesce(1))]
    assert results[0] == results[1] == results[2]


def test_many_columns_need_several_mask_words(spark):
    names = [f"c{i}" for i in range(90)]
    contract = Contract(columns=tuple(ColumnRule(n, "numeric", minimum=0.0) for n in names), required=tuple(names))
    row = [str(i) if i % 2 else ("x" if i % 4 else "-1") for i in range(90)]
    frame = spark.createDataFrame([(0, *row), (1, *row)], "row_id long, " + ", ".join(f"{n} string" for n in names))
    profile, found = check(frame, contract)
    counts = {(r.issue_type, r.affected_field): r.issue_count for r in found.collect()}
    assert len(counts) == 45 and set(counts.values()) == {2}
    assert ("numeric_out_of_range", "c88") in counts and ("invalid_numeric_value", "c2") in counts
    assert P.quality_metrics(profile).first().rejected_row_count == 2


def test_digest_tells_nulls_and_borders_apart(spark):
    frame = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "a"), ("a", None), ("", None), (None, None), (None, None), ('a","b', "")],
        "x string, y string")
    assert duplicate_rows(frame).first().duplicate_row_count == 1
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert duplicate_rows(numbers).first().duplicate_row_count == 2


def test_digest_tells_bytes_and_nested_values_apart(spark):
    raw = spark.sql("select * from values (X'ff'), (X'fe'), (X'ff'), (cast(null as binary)) v(b)")
    assert duplicate_rows(raw).first().duplicate_row_count == 1
    nested = spark.sql("""select * from values
        (array(0D), named_struct('x', X'ff', 'y', -0D)), (array(-0D), named_struct('x', X'ff', 'y', 0D)),
        (array(0D), named_struct('x', X'fe', 'y', 0D)), (cast(null as array<double>), null), (null, null) v(a, s)""")
    assert duplicate_rows(nested).first().duplicate_row_count == 2
    maps = spark.sql("select * from values (map('a', 1D, 'b', 0D)), (map('b', -0D, 'a', 1D)), (map('a', 1D)) v(m)")
    assert duplicate_rows(maps).first().duplicate_row_count == 1


def test_zero_of_either_sign_is_one_key(spark, contract):
    rows = [(k // 2 / 4 + 1, k) for k in range(3000)] + [(0.0, 3000), (-0.0, 3001), (-7.5, 3002)]
    frame = spark.createDataFrame(rows, "unique_key double, row_id long").repartition(5)
    for row_id in ("row_id", None):
        found = Q.duplicate_key_rows(frame, ["unique_key"], row_id=row_id)
        assert as_set(found, "row_id") == set(range(3002))
    assert metrics(frame, contract).duplicate_unique_key_count == 3002


def test_row_counters_equal_the_keyed_ones(spark, contract):
    rows = clean_rows() * 3
    rows = [{**r, "row_id": i, "agency": " " if i % 5 == 0 else "PW", "latitude": "x" if i % 7 == 0 else r["latitude"]}
            for i, r in enumerate(rows)]
    profile, _ = check(to_frame(spark, rows), contract)
    light, full = profile.row_counters.first().asDict(), profile.counters.first().asDict()
    assert light == {k: full[k] for k in light} and "duplicate_rows" not in light


def test_several_tables_in_one_pass_equal_single_runs(feed, contract):
    broken = feed.withColumn("latitude", F.lit("bad")).drop("agency")
    both = stack_tables({"a": feed, "b": broken}, "row_id")
    together = {r.scenario: tuple(r)[1:] for r in P.quality_metrics(P.profile(both, contract)).collect()}
    for name, frame in (("a", feed), ("b", broken)):
        assert together[name] == tuple(metrics(frame, contract))[1:]


def test_contract_loader(tmp_path):
    assert load_contract().key == "unique_key"
    path = tmp_path / "list.yaml"
    path.write_text("- a\n- b\n")
    with pytest.raises(ValueError):
        load_contract(path)
    path = tmp_path / "c.json"
    path.write_text('{"columns": {"x": {"datatype": "numeric", "minimum": 1}}, "schema_version": "1"}')
    loaded = load_contract(path)
    assert loaded.rule("x").minimum == 1.0 and loaded.allow_unexpected


def test_extra_columns_are_fine_when_allowed(feed):
    assert types(feed.withColumn("extra", F.lit("x")), Contract()) == set()
