from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tidewatch.contract import Contract
from tidewatch.sources import landing, sinks


def write(path: Path, text: str) -> str:
    path.write_text(text)
    return str(path)


RECORDS = [
    {"unique_key": "1", "created_date": "2026-01-01T00:00:00.000", "agency": "A", "other": "x"},
    {"unique_key": 2, "created_date": "2026-01-03T00:00:00.000", "agency": "B"},
    {"unique_key": "007", "created_date": "2026-01-02T00:00:00.000"},
]


@pytest.mark.parametrize("layout", ["array", "lines"])
def test_records_keep_requested_columns_newest_first(spark, tmp_path, layout):
    text = json.dumps(RECORDS, indent=1) if layout == "array" else "\n".join(map(json.dumps, RECORDS))
    frame = landing.read_records(spark, write(tmp_path / "r.json", text), limit=2)
    assert frame.columns == ["unique_key", "created_date", "agency"]
    assert [r.unique_key for r in frame.collect()] == ["2", "007"]


def test_known_columns_save_the_inference_pass(spark, tmp_path):
    path = write(tmp_path / "r.json", "\n".join(map(json.dumps, RECORDS)))
    frame = landing.read_records(spark, path, None, present=["agency", "unique_key"])
    assert as_set(frame, *frame.columns) == {("1", "A"), ("2", "B"), ("007", None)}


def test_records_errors(spark, tmp_path):
    for name, text, message in [
        ("bad", "[{not json", "malformed"), ("empty", "[]", "no records"), ("blank", " \n", "no records"),
        ("object", '{"error": "down"}', "unexpected format"),
    ]:
        with pytest.raises(landing.IngestionError, match=message):
            landing.read_records(spark, write(tmp_path / f"{name}.json", text))


@pytest.mark.parametrize("limit", [0, -1, True, 1.5, "5"])
def test_limit_must_be_a_positive_integer(spark, limit):
    with pytest.raises(ValueError):
        landing.read_records(spark, "unused", limit=limit)


def test_csv_keeps_text_and_real_columns(spark, tmp_path):
    path = write(tmp_path / "f.csv", 'unique_key,zip,note\n007,00501,"a,""b"""\n8,N/A,\n')
    frame = landing.read_csv(spark, path)
    assert as_set(frame, *frame.columns) == {("007", "00501", 'a,"b"'), ("8", "N/A", None)}
    tokens = landing.read_csv(spark, path, contract=Contract(na_tokens=("N/A", "NA")))
    assert as_set(tokens, "zip") == {"00501", None}


def test_csv_values_may_hold_line_breaks(spark, tmp_path):
    frame = spark.createDataFrame([("k1", "one\ntwo"), ("k2", 'say "hi",\nthen go')], "unique_key string, descriptor string")
    path = sinks.save_scenario_csv(frame, str(tmp_path), "breaks")
    assert as_set(landing.read_csv(spark, path), "unique_key", "descriptor") == set(map(tuple, frame.collect()))


def test_nothing_is_cut_unless_asked(spark, tmp_path):
    lines = "\n".join(json.dumps({"unique_key": str(k), "agency": "A"}) for k in range(6000))
    path = write(tmp_path / "many.json", lines)
    assert landing.read_records(spark, path).count() == 6000
    assert landing.load_or_ingest(spark, str(tmp_path / "store"), path).count() == 6000
    few = landing.read_records(spark, path, limit=3)
    assert [r.unique_key for r in few.collect()] == ["0", "1", "10"]


def test_newest_date_is_a_point_in_time(feed):
    row = landing.ingestion_metadata(feed.withColumn("created_date", F.when(
        F.col("row_id") == 0, "not-a-date").when(F.col("row_id") == 1, "2031-05-06T00:00:00+02:00").otherwise("2031-05-05"))).first()
    assert row.latest_created_date == "2031-05-05T22:00:00.000"


def test_snapshots(spark, feed, tmp_path):
    latest, snapshot = sinks.save_snapshot(feed, str(tmp_path / "store"), "20260101T000000Z")
    assert snapshot.endswith("snapshots/snapshot_ts=20260101T000000Z")
    assert as_set(spark.read.parquet(latest), *feed.columns) == as_set(spark.read.parquet(snapshot), *feed.columns)
    sinks.save_snapshot(feed.limit(3), str(tmp_path / "store"), "20260102T000000Z")
    assert spark.read.parquet(latest).count() == 3
    both = spark.read.parquet(str(tmp_path / "store" / "snapshots"))
    assert both.groupBy("snapshot_ts").count().count() == 2


def test_load_or_ingest(spark, tmp_path):
    records = write(tmp_path / "r.json", json.dumps(RECORDS))
    store = str(tmp_path / "store")
    first = landing.load_or_ingest(spark, store, records)
    assert first.count() == 3 and first.select("row_id").distinct().count() == 3
    again = landing.load_or_ingest(spark, store, str(tmp_path / "gone.json"))
    assert as_set(again, *again.columns) == as_set(first, *first.columns)


def test_landing_tells_paths_and_time(spark, tmp_path):
    records = write(tmp_path / "r.json", json.dumps(RECORDS))
    row = landing.ingest(spark, str(tmp_path / "store"), records).first()
    assert (row.rows_downloaded, row.columns_downloaded, row.load_seconds > 0) == (3, 3, True)
    assert spark.read.parquet(row.latest_path).count() == spark.read.parquet(row.snapshot_path).count() == 3


def test_metadata(feed):
    row = landing.ingestion_metadata(feed.drop("row_id"), "here").first()
    assert (row.source_url, row.rows_downloaded, row.columns_downloaded) == ("here", 36, 11)
    assert row.latest_created_date == "2031-05-05T17:30:00.000"
    assert landing.ingestion_metadata(feed.select("agency")).first().latest_created_date is None


def test_json_safe(spark):
    frame = spark.sql("select double('NaN') a, double('Infinity') b, 1.5D c, 1 d, 'x' e")
    assert tuple(sinks.json_safe(frame).first()) == (None, None, 1.5, 1, "x")
    nested = spark.sql("""select named_struct('a', double('NaN'), 'b', array(named_struct('c', double('-Infinity'), 'd', 2D))) s,
        map('k', double('Infinity'), 'l', 3D) m, cast(null as struct<x:double>) n, array(double('NaN'), 4D) v""")
    row = sinks.json_safe(nested).first().asDict(recursive=True)
    assert row == {"s": {"a": None, "b": [{"c": None, "d": 2.0}]}, "m": {"k": None, "l": 3.0}, "n": None, "v": [None, 4.0]}


def test_report_is_saved_twice(spark, tmp_path):
    frame = spark.sql("select 1 as n, cast(null as string) as s, named_struct('k', array(1, 2)) as nested")
    latest, snapshot = sinks.save_report(frame, str(tmp_path), "latest_report", "incident_report")
    texts = [spark.read.text(p).first()[0] for p in (latest, snapshot)]
    assert texts[0] == texts[1]
    assert json.loads(texts[0]) == {"n": 1, "s": None, "nested": {"k": [1, 2]}}


def test_scenario_tables(spark, feed, tmp_path):
    path = sinks.save_scenario(feed.drop("agency"), str(tmp_path), "no_agency")
    assert "agency" not in spark.read.parquet(path).columns
    tagged = feed.withColumn("scenario", F.lit("a")).unionByName(feed.withColumn("scenario", F.lit("b")))
    folder = sinks.save_by_scenario(tagged, str(tmp_path / "all"))
    assert spark.read.parquet(folder).where("scenario = 'b'").count() == 36
    csv = sinks.save_scenario_csv(feed, str(tmp_path), "as_csv")
    assert as_set(landing.read_csv(spark, csv), "incident_zip") == {"01234"}


@pytest.mark.parametrize("present", [None, ["agency", "unique_key"]])
def test_a_folder_may_hold_arrays_and_lines(spark, tmp_path, present):
    folder = tmp_path / "landed a%20b"
    folder.mkdir()
    row = lambda k: {"unique_key": str(k), "agency": "A"}
    write(folder / "a one.json", "\n  \n" + json.dumps([row(0), row(1)], indent=1))
    write(folder / "b{2}.json", "\n".join(json.dumps(row(k)) for k in (2, 3, 4)))
    write(folder / "c.json", json.dumps([row(5)]))
    write(folder / "d.json", " \n")
    write(folder / "e.json", json.dumps({"unique_key": "6", "agency": {"x": 1}} if present is None else row(6)))
    path = str(folder)
    found = landing.read_records(spark, path, None, present=present)
    assert sorted(r.unique_key for r in found.collect()) == [str(k) for k in range(7)]
    assert found.dropna().count() == 7
    write(folder / "f.json", "{not json")
    with pytest.raises(Exception, match="malformed|Malformed|MALFORMED"):
        landing.read_records(spark, path, None, present=present).collect()
