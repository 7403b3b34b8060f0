from __future__ import annotations

import hashlib
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import FIRST_DAY, KINDS, ROWS, as_set, clean_rows, to_frame
from pyspark.sql import functions as F

from tidewatch.catalog import SCENARIO_BY_NAME, SCENARIOS
from tidewatch.operators import drift as D
from tidewatch.operators import faults, sampling
from tidewatch.operators import profile as P
from tidewatch.operators.issues import validation_issues
from tidewatch.operators.tables import one_table
from tidewatch.operators.volume import daily_counts

#: Sizes of the scenarios on the feed of ``conftest``: each differs, none divides the feed evenly.
SIZES = {
    faults.BAD_NUMBER: 5, faults.BAD_DATE: 7, faults.DUPLICATED: 11, faults.SPIKE: 61,
    faults.SHIFT: 8, faults.UNSEEN: 2, faults.REVERSED: 13,
}


@pytest.fixture(scope="module")
def plan(feed):
    return faults.plan_faults(feed, sizes=SIZES)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def table_of(frame):
    return {r.row_id: r.asDict() for r in frame.collect()}


@pytest.mark.parametrize("factor", [1, 2])
def test_a_scenario_changes_its_rows_and_nothing_else(feed, factor):
    """Invariants of every scenario: exact hits, one column at most, the rest as it was, the same again."""
    plan = faults.plan_faults(feed, sizes={n: k * factor for n, k in SIZES.items()})
    clean = table_of(feed)
    for name, scenario in SCENARIO_BY_NAME.items():
        if name in (faults.DROPPED, faults.RENAMED):
            continue
        hit = as_set(faults.affected_rows(plan, name), "row_id")
        table = table_of(faults.inject(plan, name))
        assert len(hit) == faults.affected_count(plan, name)
        assert all(table[i] == row for i, row in clean.items() if i not in hit), name
        if name in faults.APPENDING:
            assert set(table) == set(clean) | hit and min(hit) > max(clean)
        else:
            assert set(table) == set(clean)
            for i in hit:
                changed = {c for c in clean[i] if table[i][c] != clean[i][c]}
                assert changed and changed <= set(scenario.columns), name
        assert table == table_of(faults.inject(faults.plan_faults(feed.repartition(5), sizes=plan.sizes), name)), name


def test_columns_that_go_or_change_their_name(feed, plan):
    gone, renamed = faults.inject(plan, faults.DROPPED), faults.inject(plan, faults.RENAMED)
    assert set(feed.columns) - set(gone.columns) == {"agency"}
    assert set(feed.columns) ^ set(renamed.columns) == {"complaint_type", "complaint_category"}
    assert sorted(r[0] for r in renamed.select("complaint_category").collect()) == sorted(
        r[0] for r in feed.select("complaint_type").collect())


def test_written_values(plan):
    written = {faults.BAD_NUMBER: ("latitude", "invalid-latitude"), faults.BAD_DATE: ("created_date", "invalid-created-date"),
               faults.UNSEEN: ("complaint_type", "Synthetic Unseen Complaint Type")}
    for name, (column, value) in written.items():
        hit = as_set(faults.inject(plan, name).where(F.col(column) == value), "row_id")
        assert hit == as_set(faults.affected_rows(plan, name), "row_id")


def test_copies_keep_their_keys(feed, plan):
    rows = faults.appended_rows(plan, faults.DUPLICATED).drop("row_id")
    assert rows.count() == rows.intersect(feed.drop("row_id")).count() == SIZES[faults.DUPLICATED]


def test_points_of_missingness(feed):
    for blank in (0, 27):
        part = feed.withColumn("descriptor", F.when(F.col("row_id") < blank, F.lit(" ")).otherwise("x"))
        plan = faults.plan_faults(part)
        for row in faults.manifest(plan).where("fault_type = 'increased_missingness'").collect():
            points = SCENARIO_BY_NAME[row.scenario_name].points
            assert row.affected_row_count == min(ROWS - blank, -(-ROWS * points // 100))
            left = faults.inject(plan, row.scenario_name).where("descriptor = 'x'").count()
            assert left == ROWS - blank - row.affected_row_count
            assert row.baseline_missingness_percentage == round(100 * blank / ROWS, 2)
            assert row.resulting_missingness_percentage == round(100 * (ROWS - left) / ROWS, 2)


def test_reversed_dates_are_a_day_early(feed, plan):
    table, clean = table_of(faults.inject(plan, faults.REVERSED)), table_of(feed)
    for i in as_set(faults.affected_rows(plan, faults.REVERSED), "row_id"):
        closed, created = (datetime.fromisoformat(t) for t in (table[i]["closed_date"], clean[i]["created_date"]))
        assert created - closed == timedelta(days=1) and table[i]["closed_date"].endswith(".000")


@pytest.mark.parametrize("size", [1, 24, 61, 700])
def test_a_spike_adds_rows_of_one_day_under_new_keys(feed, size):
    plan = faults.plan_faults(feed, names=[faults.SPIKE], sizes={faults.SPIKE: size})
    added = faults.appended_rows(plan, faults.SPIKE)
    rows = added.collect()
    keys = {int(r.unique_key) for r in rows}
    assert len(rows) == len(keys) == len({r.row_id for r in rows}) == size
    assert min(keys) > max(int(k) for k in as_set(feed, "unique_key"))
    assert {r.created_date[:10] for r in rows} == {FIRST_DAY}


def test_random_spike_keeps_the_category_mix(spark, feed):
    many = feed.crossJoin(spark.range(80)).withColumn("row_id", F.col("row_id") * 80 + F.col("id")).drop("id")
    spiked = faults.inject(faults.plan_faults(many, names=[faults.SPIKE], sizes={faults.SPIKE: 2500}), faults.SPIKE)
    assert D.compare_distributions(many, spiked).verdict.where("category_drift").count() == 0


def test_spike_with_text_keys(feed):
    named = feed.withColumn("unique_key", F.concat(F.lit("k"), "unique_key"))
    plan = faults.plan_faults(named, names=[faults.SPIKE], sizes={faults.SPIKE: 29})
    keys = as_set(faults.appended_rows(plan, faults.SPIKE), "unique_key")
    assert len(keys) == 29 and all(k.startswith("synthetic-volume-109-") for k in keys)


def test_spike_needs_a_date(feed):
    with pytest.raises(ValueError):
        faults.plan_faults(feed.withColumn("created_date", F.lit("bad")), names=[faults.SPIKE])


def test_shift_raises_the_mode(feed, plan):
    target = plan.population.mode
    assert target == KINDS[0]
    assert faults.inject(plan, faults.SHIFT).where(F.col("complaint_type") == target).count() == ROWS // 2 + SIZES[faults.SHIFT]


def test_sizes_follow_the_feed():
    by_name = {s.name: faults.scaled_size(s, 5000) for s in SCENARIOS if s.size or s.points}
    assert by_name[faults.BAD_NUMBER] == 50 and by_name[faults.SPIKE] == 500 and by_name[faults.SHIFT] == 1000
    assert by_name["descriptor_missingness_plus_25_points"] == 1250
    assert faults.scaled_size(SCENARIO_BY_NAME[faults.SPIKE], 1001) == 101
    assert faults.scaled_size(SCENARIO_BY_NAME[faults.UNSEEN], 100_000) == 5000


def test_fan_out_equals_single_tables(feed, plan):
    tables = faults.fan_out(plan)
    for name in tables.names:
        columns = ["row_id", *tables.columns[name]]
        single = feed if name == "clean_baseline" else faults.inject(plan, name)
        together = sorted(map(tuple, tables.frame.where(tables.member(name)).select(*columns).collect()), key=repr)
        assert together == sorted(map(tuple, single.select(*columns).collect()), key=repr)


def test_manifest(plan):
    rows = faults.manifest(plan).orderBy("position").collect()
    assert [r.scenario_name for r in rows] == [s.name for s in SCENARIOS]
    assert {"scenario_name", "fault_type", "expected_issue_types", "affected_columns", "affected_row_count",
            "parameters", "random_seed", "description", "output_path"} <= set(rows[0].asDict())
    for row in rows:
        assert faults.affected_rows(plan, row.scenario_name).count() == row.affected_row_count


@pytest.mark.parametrize("digits", [1, 3])
@pytest.mark.parametrize("size", [0, 1, 137, 999, 1000, 5000])
def test_sample_is_the_smallest_hashes(spark, monkeypatch, digits, size):
    monkeypatch.setattr(sampling, "PREFIX_DIGITS", digits)
    frame = spark.range(1000).withColumnRenamed("id", "row_id")
    wanted = set(sorted(range(1000), key=lambda i: md5(f"9|{i}"))[:size])
    for version in (frame, frame.repartition(7)):
        assert as_set(sampling.seeded_sample(version, size, 9, "row_id"), "row_id") == wanted


def test_sample_of_eligible_rows(spark):
    frame = spark.range(500).withColumnRenamed("id", "row_id")
    wanted = set(sorted((i for i in range(500) if i % 3 == 0), key=lambda i: md5(f"4|{i}"))[:50])
    assert as_set(sampling.seeded_sample(frame, 50, 4, "row_id", F.col("row_id") % 3 == 0), "row_id") == wanted


@pytest.mark.parametrize("draws", [0, 1, 37, 100, 250, 1600, 1601, 5003])
def test_sample_with_replacement(spark, draws):
    frame = spark.range(100).withColumnRenamed("id", "row_id")
    order = sorted(range(100), key=lambda i: md5(f"5|{i}"))
    sizes = sampling.repeat_sizes(draws, 100)
    assert sum(sizes) == draws and all(0 <= s <= 100 for s in sizes)
    wanted = {(i * len(sizes) + level, i) for level, size in enumerate(sizes) for i in order[:size]}
    for version in (frame, frame.repartition(7)):
        got = sampling.sample_with_replacement(version, draws, 100, 5, "row_id")
        assert got.count() == draws and as_set(got, "pick", "row_id") == wanted


@pytest.mark.parametrize("draws", [0, 1, 37, 250])
def test_independent_picks(spark, draws):
    """Each pick by its own hash; rows that share an id are rows of their own, those without one are the last."""
    ids = [*range(90), *range(5), None, None]
    rows = [(i, f"text {n}") for n, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "row_id long, body string")
    order = sorted(rows, key=lambda r: (r[0] is None, md5(f"5|{r[0]}"), r[1]))
    wanted = {(i, *order[int(md5(f"5|draw|{i}")[:15], 16) % len(rows)]) for i in range(draws)}
    for version in (frame, frame.repartition(7)):
        got = sampling.sample_with_replacement(version, draws, len(rows), 5, "row_id", independent=True)
        assert got.count() == draws and as_set(got, "pick", "row_id", "body") == wanted


def test_the_query_draws_independently(spark):
    import __spark_entry__ as entry

    found = entry.queries()["sample_with_replacement"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.pick for r in found) == list(range(len(found)))
    assert "draw|" in entry.oracle_sql()["sample_with_replacement"]


def test_repeats_are_as_many_as_independent_picks_leave():
    draw = random.Random(3)
    population, draws, rounds = 400, 1000, 300
    seen = [0] * 12
    for _ in range(rounds):
        for n in Counter(draw.choices(range(population), k=draws)).values():
            for level in range(min(n, 12)):
                seen[level] += 1
    for level, size in enumerate(sampling.repeat_sizes(draws, population)[:8]):
        assert abs(size - seen[level] / rounds) < 2 + 0.02 * size


def test_a_draw_is_one_scan(spark, tmp_path):
    spark.range(500).withColumnRenamed("id", "row_id").write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    plan = sampling.sample_with_replacement(frame, 250, 500, 5, "row_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and not any(x in plan for x in ("Exchange", "Sort", "Window", "Join"))


def test_all_scenarios_are_one_scan(spark, feed, tmp_path):
    feed.write.parquet(str(tmp_path / "feed"))
    tables = faults.fan_out(faults.plan_faults(spark.read.parquet(str(tmp_path / "feed")), sizes=SIZES))
    plan = tables.frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan


def test_typed_feed(spark):
    rows = clean_rows()
    frame = to_frame(spark, rows).withColumn("latitude", F.col("latitude").cast("double")).withColumn(
        "unique_key", F.col("unique_key").cast("long"))
    plan = faults.plan_faults(frame, sizes=SIZES)
    assert faults.inject(plan, faults.BAD_NUMBER).where("latitude = 'invalid-latitude'").count() == SIZES[faults.BAD_NUMBER]
    tables = faults.fan_out(plan)
    rows = tables.per_scenario(tables.frame).groupBy("scenario").count()
    assert rows.agg(F.sum("count")).first()[0] == ROWS * 13 + 11 + 61
    changed = sum(d.size for n, d in plan.draws.items() if n != faults.DUPLICATED)
    assert tables.frame.count() <= ROWS * 3 + changed + 11 + 61


def test_shared_rows_give_the_metrics_of_single_tables(spark, contract):
    """A feed with copies and repeated keys, so that shared rows differ in membership."""
    rows = clean_rows()
    rows += [{**r, "row_id": 100 + i} for i, r in enumerate(rows[:12])]
    rows += [{**rows[0], "row_id": 200 + i, "agency": None, "unique_key": " " if i % 2 else "7003"} for i in range(8)]
    plan = faults.plan_faults(to_frame(spark, rows), sizes=SIZES)
    together = P.quality_metrics(P.profile(faults.fan_out(plan), contract)).collect()
    assert len(together) == 13
    for row in together:
        single = plan.feed if row.scenario == "clean_baseline" else faults.inject(plan, row.scenario)
        alone = P.quality_metrics(P.profile(one_table(single, "row_id"), contract)).first()
        assert tuple(row)[1:] == tuple(alone)[1:], row.scenario


def test_narrow_tables_count_like_whole_ones(plan):
    whole = faults.fan_out(plan)
    for columns in ([], ["created_date"], ["complaint_type", "borough"], ["agency"]):
        narrow = faults.fan_out(plan, only=columns)
        for name in whole.names:
            shown = [c for c in columns if c in whole.columns[name]]
            assert set(shown) <= set(narrow.columns[name])
            rows = [sorted(map(tuple, t.frame.where(t.member(name)).select("row_id", *shown).collect()), key=repr)
                    for t in (whole, narrow)]
            assert rows[0] == rows[1], (name, columns)


def test_repeated_ids_at_a_boundary_are_refused(spark):
    frame = spark.range(50).select(F.lit(7).cast("long").alias("row_id"))
    with pytest.raises(ValueError, match="repeated"):
        sampling.seeded_sample(frame, 20, 1, "row_id")
    assert sampling.seeded_sample(frame, 50, 1, "row_id").count() == 50


def test_endless_and_huge_keys_leave_room_for_new_ones(feed):
    odd = F.when(F.col("row_id") == 0, "inf").when(F.col("row_id") == 1, "9223372036854775807")
    strange = feed.withColumn("unique_key", F.coalesce(odd, "unique_key"))
    plan = faults.plan_faults(strange, names=[faults.SPIKE], sizes={faults.SPIKE: 2})
    keys = {int(k) for k in as_set(faults.appended_rows(plan, faults.SPIKE), "unique_key")}
    assert len(keys) == 2 and 7105 < min(keys) and max(keys) < 10_000


def test_stored_rows_rebuild_every_table(feed, plan):
    changed = faults.changed_rows(plan)
    for name in SCENARIO_BY_NAME:
        table, single = faults.rebuild(feed, changed, name), faults.inject(plan, name)
        columns = sorted(single.columns)
        assert sorted(table.columns) == columns
        assert sorted(map(tuple, table.select(columns).collect()), key=repr) == sorted(
            map(tuple, single.select(columns).collect()), key=repr), name
    sizes = {r.scenario: r["count"] for r in changed.groupBy("scenario").count().collect()}
    assert sizes == {n: faults.affected_count(plan, n) for n in SCENARIO_BY_NAME
                     if n not in (faults.DROPPED, faults.RENAMED)}


def test_spike_rows_name_their_sources(feed, plan):
    sources = {r.row_id: r.source_row_id for r in faults.spike_sources(plan).collect()}
    rows = {r.row_id: r for r in feed.collect()}
    for row in faults.appended_rows(plan, faults.SPIKE).collect():
        assert row.created_date == rows[sources[row.row_id]].created_date
        assert row.descriptor == rows[sources[row.row_id]].descriptor


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_scenario_copies_are_made_by_compiled_code(plan):
    """A null filter inside the array would be interpreted, for every row and scenario."""
    assert "lambda" not in optimized(faults.fan_out(plan).frame)


def test_a_counting_pass_reads_conditions_once(feed, plan):
    draws = [*plan.draws.values(), *plan.spike]
    hashed, names = sampling._orders(feed, draws, "row_id")
    assert len(plan.spike) > 1 and len(hashed.columns) == len(plan.draws) + 1 == len(names)
    places = {sampling._place(d, ""): d for d in draws}
    found = optimized(hashed.select(sampling._matching(places, names, 0).alias("m")))
    assert found.count("date_format(") == 1 and found.count("md5(") == len(names)


def test_days_are_read_once(feed):
    assert optimized(daily_counts(one_table(feed, "row_id"))).count("date_format(") == 1


def test_findings_need_no_digests(spark, contract):
    rows = clean_rows()
    rows += [{**r, "row_id": 100 + i} for i, r in enumerate(rows[:5])]
    rows += [{**rows[0], "row_id": 200 + i, "agency": None, "unique_key": " " if i % 2 else None} for i in range(4)]
    found = P.profile(faults.fan_out(faults.plan_faults(to_frame(spark, rows), sizes=SIZES)), contract)
    assert "sha2(" in optimized(found.counters) and "sha2(" not in optimized(validation_issues(found))
    assert "duplicate_rows" not in found.key_counters.columns
    assert as_set(found.counters, *found.key_counters.columns) == as_set(found.key_counters, *found.key_counters.columns)
