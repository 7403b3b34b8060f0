"""Row checks that a contract defines itself; record layouts told by the caller."""

from __future__ import annotations

import json

import pytest
from conftest import clean_rows, to_frame
from pyspark.sql import functions as F

from tidewatch.contract import Contract, RowCheck
from tidewatch.operators import issues as I
from tidewatch.operators import profile as P
from tidewatch.operators import quarantine
from tidewatch.operators.tables import one_table, stack_tables
from tidewatch.sources.landing import IngestionError, read_records

RAW = {"unique_key_column": "unique_key", "checks": [
    {"name": "late_case", "column": "descriptor", "fails_when": "cast(substring(descriptor, 6) as int) >= 30", "penalty": 25},
    {"name": "quayside", "column": "borough", "fails_when": "borough = 'Quay' and agency is null"},
]}


def broken(spark):
    rows = clean_rows()
    for k in (4, 9, 31):
        rows[k]["agency"] = None
    rows[33]["descriptor"] = None
    return to_frame(spark, rows), rows


def test_an_own_check_is_found_rejects_and_costs(spark):
    frame, rows = broken(spark)
    contract = Contract.from_mapping(RAW)
    table = one_table(frame, "row_id")
    checked = P.profile(table, contract)
    late = {r["row_id"] for r in rows if r["descriptor"] and int(r["descriptor"][5:]) >= 30}
    quay = {r["row_id"] for r in rows if r["borough"] == "Quay" and r["agency"] is None}
    assert len(late) == 5 and quay
    found = I.validation_issues(checked, quarantine.issue_samples(table, contract)).collect()
    assert {r.issue_type: r.issue_count for r in found} == {"late_case": 5, "quayside": len(quay)}
    for r in found:
        assert set(json.loads(r.observed_value)["sample_row_ids"]) == {"late_case": late, "quayside": quay}[r.issue_type]
    kept = {r.row_id: r[quarantine.REASONS] for r in quarantine.rejected_rows(table, contract).collect()}
    assert set(kept) == late | quay and kept[next(iter(quay))][-1] == "quayside:borough"
    assert P.quality_metrics(checked).first().rejected_row_count == len(late | quay)
    verdict = I.validation_verdict(I.validation_issues(checked), table.names_frame(), contract).first()
    assert (verdict.reliability_score, verdict.validation_passed) == (65, False)


def test_tables_without_the_column_skip_the_check(spark):
    frame, _ = broken(spark)
    tables = stack_tables({"whole": frame, "part": frame.drop("borough")}, "row_id")
    found = I.validation_issues(P.profile(tables, Contract.from_mapping(RAW))).collect()
    assert {(r.scenario, r.issue_type) for r in found} == {("whole", "late_case"), ("whole", "quayside"), ("part", "late_case")}


def test_own_checks_join_the_scan_of_the_others(spark, tmp_path):
    frame, _ = broken(spark)
    frame.write.parquet(str(tmp_path / "feed"))
    table = one_table(spark.read.parquet(str(tmp_path / "feed")), "row_id")
    scans = [I.validation_issues(P.profile(table, c))._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
             for c in (Contract(key="unique_key"), Contract.from_mapping(RAW))]
    assert scans[0] == scans[1]


@pytest.mark.parametrize("names", [["invalid_timestamp"], ["twice", "twice"]])
def test_names_of_own_checks_are_new(names):
    with pytest.raises(ValueError):
        Contract(checks=tuple(RowCheck(n, "c", "c = 1") for n in names))


def test_layout_told_by_the_caller(spark, tmp_path):
    rows = [{"unique_key": str(k), "status": "Open"} for k in range(5)]
    (tmp_path / "arrays").mkdir()
    (tmp_path / "arrays" / "a.json").write_text(json.dumps(rows))  # one line
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    for name in ("arrays", "lines"):
        path = str(tmp_path / name)
        for layout in (None, name.rstrip("s") if name == "arrays" else name):
            found = read_records(spark, path, layout=layout)
            assert sorted(r.unique_key for r in found.collect()) == [str(k) for k in range(5)]
    (tmp_path / "lines" / "b.json").write_text("  \n [\n" + json.dumps(rows[0]) + "]")
    assert read_records(spark, str(tmp_path / "lines")).select(F.count("*")).first()[0] == 6
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path / "lines"), layout="csv")
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text(" \n")
    with pytest.raises(IngestionError):
        read_records(spark, str(tmp_path / "none"))
