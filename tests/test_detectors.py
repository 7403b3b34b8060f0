from __future__ import annotations

import json
import math
import statistics
from collections import Counter

import pytest
from conftest import FIRST_DAY, KINDS, ROWS, SECOND_DAY, SIDES, as_set, clean_rows, to_frame
from pyspark.sql import functions as F

from tidewatch.operators import drift as D
from tidewatch.operators import volume as V
from tidewatch.operators.tables import one_table


def with_rows(spark, extra):
    return to_frame(spark, clean_rows() + extra)


def copies(count, **changes):
    first = clean_rows()[0]
    return [{**first, "row_id": 100 + i, "unique_key": str(90_000 + i), **changes} for i in range(count)]


def drift_types(baseline, current):
    return as_set(D.compare_distributions(baseline, current).issues, "issue_type")


def distances(baseline, current):
    found = D.compare_distributions(baseline, current).verdict.collect()
    return {r.field: round(r.jensen_shannon_distance, 9) for r in found}


def kinds(rows=None):
    return Counter(r["complaint_type"] for r in rows or clean_rows())


def sides(rows=None):
    return Counter(r["borough"] for r in rows or clean_rows())


def distance(base: Counter, now: Counter) -> float:
    """Jensen-Shannon distance of two counts of categories."""
    p, q = ({k: n / c.total() for k, n in c.items()} for c in (base, now))
    total = 0.0
    for k in base | now:
        m = (p.get(k, 0) + q.get(k, 0)) / 2
        total += sum(0.5 * x * math.log2(x / m) for x in (p.get(k, 0), q.get(k, 0)) if x)
    return round(math.sqrt(max(total, 0)), 9)


def test_daily_counts(feed):
    daily = V.daily_counts(one_table(feed, "row_id"))
    assert as_set(daily, "calendar_date", "request_count") == {(FIRST_DAY, 24), (SECOND_DAY, 12)}


@pytest.mark.parametrize("base,added,flagged", [
    (24, 199, False), (24, 200, True),          # either side of the least increase
    (4600, 203, False), (4600, 204, True),      # and of three deviations of a large day
    (24, 0, False), (0, 199, False), (0, 200, True)])
def test_volume_gates_from_both_sides(spark, base, added, flagged):
    day = lambda n: spark.range(n).select(F.lit(f"{FIRST_DAY}T08:00:00").alias("created_date"))
    rows = V.compare_volumes(day(base), day(base + added)).collect()
    assert [(r.calendar_date, r.baseline_count, r.current_count, r.absolute_difference, r.is_anomaly) for r in rows] == [
        (FIRST_DAY, base, base + added, added, flagged)]
    assert math.isclose(rows[0].standardized_count_difference, added / math.sqrt(max(base, 1)))
    assert rows[0].percentage_change == (None if base == 0 else pytest.approx(100 * added / base))


def test_volume_issue(spark, feed):
    records = V.compare_volumes(feed, with_rows(spark, copies(200))).withColumn("scenario", F.lit("s"))
    issue, = V.volume_issues(records).collect()
    assert (issue.issue_type, issue.severity, issue.affected_field) == ("volume_anomaly", "warning", "created_date")
    observed = json.loads(issue.observed_value)
    assert observed["absolute_difference"] == 200 and observed["current_count"] == 224
    assert json.loads(issue.expected_value) == {"minimum_absolute_increase": 200, "standardized_threshold": 3.0}


def test_days_on_one_side_only(spark, feed):
    later = feed.withColumn("created_date", F.lit("2031-06-01"))
    records = {r.calendar_date: r for r in V.compare_volumes(feed, later).collect()}
    assert records["2031-06-01"].baseline_count == 0
    assert records["2031-06-01"].percentage_change is None
    assert records["2031-06-01"].standardized_count_difference == ROWS
    assert records[FIRST_DAY].current_count == 0
    assert records[FIRST_DAY].percentage_change == -100.0


def test_decreases_only_when_asked(spark, feed):
    many = with_rows(spark, copies(300))
    assert V.compare_volumes(many, feed).where("is_anomaly").count() == 0
    assert V.compare_volumes(many, feed, detect_decreases=True).where("is_anomaly").count() == 1


def test_missing_date_column_and_empty_tables(feed):
    assert V.daily_counts(one_table(feed.drop("created_date"), "row_id")).count() == 0
    assert V.compare_volumes(feed.limit(0), feed.limit(0)).count() == 0
    assert V.compare_volumes(feed, feed.drop("created_date")).count() == 2


def test_rolling_needs_history(feed):
    records = V.rolling_volume(V.daily_counts(one_table(feed, "row_id"))).collect()
    assert len(records) == 2 and not any(r.history_sufficient or r.is_anomaly for r in records)
    with pytest.raises(ValueError):
        V.rolling_volume(V.daily_counts(one_table(feed, "row_id")), rolling_window=2, minimum_periods=3)


def test_rolling_against_brute_force(spark):
    counts = [50, 52, 49, 300, 51, 53, 50, 48, 47, 350, 60, 20, 50, 50, 50, 50, 50, 50, 50, 50, 50]
    days = [f"2026-03-{i + 1:02d}" for i in range(len(counts))]
    daily = spark.createDataFrame([("s", d, c) for d, c in zip(days, counts)],
                                  "scenario string, calendar_date string, request_count long")
    got = {r.calendar_date: r for r in
           V.rolling_volume(daily, minimum_absolute_increase=20, detect_decreases=True).collect()}
    for i, day in enumerate(days):
        history = counts[max(0, i - 7):i]
        row = got[day]
        if len(history) < 3:
            assert row.rolling_mean is None and not row.history_sufficient
            continue
        mean, spread = statistics.fmean(history), statistics.pstdev(history)
        assert math.isclose(row.rolling_mean, mean) and math.isclose(row.rolling_standard_deviation, spread, abs_tol=1e-9)
        assert row.history_sufficient == (spread > 0)
        z = (counts[i] - mean) / spread if spread else None
        flagged = z is not None and ((counts[i] - mean >= 20 and z >= 3) or (counts[i] - mean <= -20 and z <= -3))
        assert row.is_anomaly == flagged
    assert got["2026-03-04"].is_anomaly
    issue = V.volume_issues(V.rolling_volume(daily, minimum_absolute_increase=20)).first()
    assert json.loads(issue.observed_value)["percentage_change"] is None


def test_no_drift_against_itself(feed):
    assert distances(feed, feed) == {"complaint_type": 0.0, "borough": 0.0}
    assert drift_types(feed, feed) == set()


def test_one_copied_row_is_no_drift(spark, feed):
    current = with_rows(spark, copies(1))
    more = clean_rows() + copies(1)
    assert distances(feed, current) == {
        "complaint_type": distance(kinds(), kinds(more)), "borough": distance(sides(), sides(more))}
    assert drift_types(feed, current) == set()


def moved(feed, kind):
    """The feed with its first fourteen rows under another kind, as a frame and as counts."""
    early = F.col("row_id") < 14
    rows = [{**r, "complaint_type": kind} if r["row_id"] < 14 else r for r in clean_rows()]
    return feed.withColumn("complaint_type", F.when(early, kind).otherwise(F.col("complaint_type"))), kinds(rows)


def test_shift_to_the_mode(feed):
    current, now = moved(feed, KINDS[0])
    assert drift_types(feed, current) == {"category_drift"}
    assert distances(feed, current)["complaint_type"] == distance(kinds(), now)
    drift = D.compare_distributions(feed, current)
    shifts = {r.category: round(r.absolute_frequency_change, 6) for r in D.shifted_categories(drift.aligned).collect()}
    assert shifts == {k: round(abs(now[k] - n) / ROWS, 6) for k, n in kinds().items()}
    assert len(shifts) == 3


def test_unseen_category(feed):
    current, now = moved(feed, "Noise")
    assert drift_types(feed, current) == {"category_drift", "unexpected_category"}
    assert distances(feed, current)["complaint_type"] == distance(kinds(), now)
    drift = D.compare_distributions(feed, current)
    assert {tuple(r) for r in D.new_categories(drift.aligned).select("category", "count", F.round("frequency", 9)).collect()} == {
        ("Noise", 14, round(14 / ROWS, 9))}
    issue = drift.issues.where("issue_type = 'unexpected_category'").first()
    assert json.loads(issue.observed_value) == {"new_count": 1, "findings_table": D.FINDINGS_TABLE}
    found = as_set(drift.findings.where("field = 'complaint_type'"), "kind", "category", "baseline_count", "current_count")
    assert found == {("new", "Noise", 0, 14)} | {("shifted", k, n, now[k]) for k, n in kinds().items()}


def test_new_category_elsewhere_raises_nothing(feed):
    current = feed.withColumn("borough", F.when(F.col("row_id") == 0, "West").otherwise(F.col("borough")))
    assert "unexpected_category" not in drift_types(feed, current)


def test_spike_of_one_row_also_drifts(spark, feed):
    current = with_rows(spark, copies(200))
    more = clean_rows() + copies(200)
    assert distances(feed, current) == {
        "complaint_type": distance(kinds(), kinds(more)), "borough": distance(sides(), sides(more))}
    assert drift_types(feed, current) == {"category_drift"}


def test_missing_field_is_unavailable(feed):
    drift = D.compare_distributions(feed, feed.drop("complaint_type"))
    found = {r.field: r for r in drift.verdict.collect()}
    assert not found["complaint_type"].field_available
    assert found["complaint_type"].jensen_shannon_distance == 0.0
    assert found["borough"].field_available
    assert drift.issues.count() == 0
    assert D.disappearing_categories(drift.aligned).count() == 0


def test_one_empty_side(spark, feed):
    empty = feed.withColumn("complaint_type", F.lit(" "))
    assert distances(feed, empty)["complaint_type"] == round(math.sqrt(0.5), 9)
    assert distances(empty, empty)["complaint_type"] == 0.0


def test_disappearing_needs_ten_rows(feed):
    common, rare = KINDS[0], KINDS[2]
    assert kinds()[common] >= 10 > kinds()[rare]
    drift = D.compare_distributions(feed, feed.where(F.col("complaint_type") != common))
    gone = D.disappearing_categories(drift.aligned).where("field = 'complaint_type'")
    assert as_set(gone, "category", "baseline_count") == {(common, kinds()[common])}
    few = D.compare_distributions(feed, feed.where(F.col("complaint_type") != rare))
    assert D.disappearing_categories(few.aligned).count() == 0


def test_categories_are_stripped_but_keep_case(spark):
    frame = spark.createDataFrame([(" a ",), ("a",), ("A",), ("",), (None,), (" a",)], "complaint_type string")
    counts = D.category_frequencies(D.category_counts(one_table(frame), ("complaint_type",)))
    assert as_set(counts, "category", "n", "frequency") == {("a", 3, 0.75), ("A", 1, 0.25)}


def test_findings_are_whole_however_many(spark):
    base = spark.range(1, 601).select(F.concat(F.lit("b"), "id").alias("complaint_type"))
    now = spark.range(1, 601).select(F.concat(F.lit("c"), "id").alias("complaint_type"))
    limits = D.DriftLimits(new_count=1, gone_count=1)
    drift = D.compare_distributions(base, now, fields=("complaint_type",), limits=limits)
    row = drift.verdict.first()
    assert (row.new_count, row.disappearing_count) == (600, 600)
    assert drift.findings.count() == 1200
    issues = {r.issue_type: r for r in drift.issues.collect()}
    assert issues["unexpected_category"].issue_count == issues["category_drift"].issue_count == 600
    assert all(len(r.observed_value) < 200 for r in issues.values())


def test_top_categories(feed):
    top = D.top_categories(D.compare_distributions(feed, feed).aligned, 2).collect()
    assert sorted((r.field, r.category) for r in top) == [("borough", SIDES[0]), ("complaint_type", KINDS[0])]
