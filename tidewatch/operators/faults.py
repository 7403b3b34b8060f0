"""Fault injection: twelve corrupted variants of a clean feed with known ground truth.

Injection has two steps. ``plan_faults`` measures the feed with a few aggregations
(row counts, busiest day, most frequent category, sample thresholds); only those
scalars come to the driver. Applying a scenario is then a lazy projection over the
feed, or a union with the rows it appends. ``fan_out`` applies all scenarios in one
scan, with extra copies of a row only for the scenarios that change it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.catalog import (
    CLEAN,
    INVALID_CREATED_DATE,
    INVALID_LATITUDE,
    DESIGN_ROWS,
    RENAMED_COLUMN,
    SCENARIO_BY_NAME,
    SCENARIOS,
    UNSEEN_CATEGORY,
    Scenario,
)
from tidewatch.functions import calendar_day, is_blank, percent, to_number, to_utc_timestamp
from tidewatch.operators.sampling import Draw, draw_hash, draw_thresholds, in_sample, picked, repeated_draws
from tidewatch.operators.tables import MEMBERS, SCENARIO, Tables, bit, literal_rows

KEY, CREATED, CLOSED = "unique_key", "created_date", "closed_date"
AGENCY, CATEGORY, DETAIL, LATITUDE = "agency", "complaint_type", "descriptor", "latitude"
CLOSED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.000"

DROPPED = "deleted_required_agency_column"
RENAMED = "renamed_complaint_type_column"
BAD_NUMBER = "invalid_latitude_text"
DUPLICATED = "duplicate_rows_preserved_unique_keys"
BAD_DATE = "invalid_created_date_text"
SPIKE = "daily_request_volume_spike"
SHIFT = "complaint_type_frequency_shift"
UNSEEN = "unseen_complaint_type_category"
REVERSED = "closed_date_before_created_date"
APPENDING = (DUPLICATED, SPIKE)
KEY_LIMIT = 1 << 62


@dataclass(frozen=True)
class Population:
    """What the plan needs to know about the clean feed."""

    rows: int
    filled_detail: int
    dated: int
    min_row_id: int | None
    max_row_id: int | None
    max_key: int | None
    busiest_day: str | None
    busiest_rows: int
    mode: str | None
    mode_rows: int


@dataclass(frozen=True)
class FaultPlan:
    """Sizes, samples and scalars of a run; no row data."""

    feed: DataFrame
    row_id: str
    population: Population
    draws: dict[str, Draw]
    thresholds: dict[str, str]
    spike_size: int
    spike: list[Draw] = field(default_factory=list)
    sizes: dict[str, int] = field(default_factory=dict)

    def hit(self, name: str) -> Column:
        return in_sample(self.draws[name], self.thresholds[name], self.row_id)


def _day(frame: DataFrame) -> Column:
    return calendar_day(to_utc_timestamp(F.col(CREATED), frame.schema[CREATED].dataType))


def measure(feed: DataFrame, row_id: str) -> Population:
    """One aggregation for the counters, and a grouping for the days and categories."""
    dtypes = {f.name: f.dataType for f in feed.schema.fields}
    created = to_utc_timestamp(F.col(CREATED), dtypes[CREATED])
    numeric_key = to_number(F.col(KEY), dtypes[KEY])
    # Wide integer keys would lose digits as doubles; whole numbers are read exactly. Keys
    # that leave no room for new ones above them, infinities among them, do not count.
    near = F.when(F.abs(numeric_key) < F.lit(float(KEY_LIMIT)), numeric_key)
    exact_key = F.coalesce(F.col(KEY).try_cast("long"), F.floor(near))
    counts = feed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_blank(F.col(DETAIL), dtypes[DETAIL])).alias("filled"),
        F.count(created).alias("dated"),
        F.min(row_id).alias("low"),
        F.max(row_id).alias("high"),
        F.max(F.when(near.isNotNull(), exact_key)).alias("max_key"),
    ).first()
    # Most frequent day and category together; ties go to the smallest value.
    values = F.explode(F.array(
        F.struct(F.lit("day").alias("kind"), _day(feed).alias("value")),
        F.struct(F.lit("category").alias("kind"), F.col(CATEGORY).cast("string").alias("value")),
    ))
    best = Window.partitionBy("kind").orderBy(F.desc("n"), "value")
    tops = (
        feed.select(values.alias("v")).select("v.*").where(F.col("value").isNotNull())
        .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.row_number().over(best)).where("rank = 1").collect()
    )
    top = {r["kind"]: (r["value"], r["n"]) for r in tops}
    return Population(
        counts["rows"], counts["filled"], counts["dated"], counts["low"], counts["high"],
        counts["max_key"],
        *top.get("day", (None, 0)), *top.get("category", (None, 0)),
    )


def scaled_size(scenario: Scenario, rows: int) -> int:
    """Affected rows: the share of the feed that the scenario states, rounded up."""
    share, of = (scenario.size, DESIGN_ROWS) if scenario.points is None else (scenario.points, 100)
    return -(-rows * share // of)


def plan_faults(
    feed: DataFrame,
    row_id: str = "row_id",
    names: Sequence[str] | None = None,
    sizes: dict[str, int] | None = None,
) -> FaultPlan:
    """Measure the feed and fix every sample. ``sizes`` sets absolute row counts by scenario."""
    names = list(names or SCENARIO_BY_NAME)
    population = measure(feed, row_id)
    dtypes = {f.name: f.dataType for f in feed.schema.fields}
    wanted = {
        n: (sizes or {}).get(n, scaled_size(SCENARIO_BY_NAME[n], population.rows))
        for n in names if n not in (DROPPED, RENAMED)
    }
    if SPIKE in names and population.busiest_day is None:
        raise ValueError("A volume spike needs at least one readable creation date.")
    eligible = {
        SHIFT: (~F.col(CATEGORY).eqNullSafe(F.lit(population.mode)),
                population.rows - population.mode_rows),
        REVERSED: (to_utc_timestamp(F.col(CREATED), dtypes[CREATED]).isNotNull(), population.dated),
    }
    draws = {}
    for name, size in wanted.items():
        if name == SPIKE:
            continue
        scenario = SCENARIO_BY_NAME[name]
        if scenario.points is not None:
            condition, available = ~is_blank(F.col(DETAIL), dtypes[DETAIL]), population.filled_detail
        else:
            condition, available = eligible.get(name, (None, population.rows))
        draws[name] = Draw(name, scenario.seed, min(size, available), available, condition)
    on_the_day = _day(feed) == F.lit(population.busiest_day)
    spike = repeated_draws(
        SPIKE, SCENARIO_BY_NAME[SPIKE].seed, wanted.get(SPIKE, 0), population.busiest_rows, on_the_day)
    thresholds = draw_thresholds(feed, [*draws.values(), *spike], row_id)
    return FaultPlan(feed, row_id, population, draws, thresholds, wanted.get(SPIKE, 0), spike, wanted)


def _overwrites(plan: FaultPlan, name: str) -> dict[str, Column]:
    """New value of each column a value-level scenario changes, where it hits."""
    scenario = SCENARIO_BY_NAME[name]
    if name == BAD_NUMBER:
        return {LATITUDE: F.lit(INVALID_LATITUDE)}
    if name == BAD_DATE:
        return {CREATED: F.lit(INVALID_CREATED_DATE)}
    if scenario.points is not None:
        return {DETAIL: F.lit(None).cast("string")}
    if name == SHIFT:
        return {CATEGORY: F.lit(plan.population.mode)}
    if name == UNSEEN:
        return {CATEGORY: F.lit(UNSEEN_CATEGORY)}
    if name == REVERSED:
        created = to_utc_timestamp(F.col(CREATED), plan.feed.schema[CREATED].dataType)
        earlier = created - F.expr("interval 1 day")
        return {CLOSED: F.date_format(earlier, CLOSED_FORMAT)}
    return {}


def _spike_picks(plan: FaultPlan) -> DataFrame:
    """Rows drawn from the busiest day, with their pick numbers."""
    return picked(plan.feed, plan.spike, plan.thresholds, plan.row_id, plan.population.min_row_id or 0)


def _new_values(plan: FaultPlan, name: str, pick: Column) -> dict[str, Column]:
    """Row id, and key where it is new, of the rows that a scenario adds."""
    pop = plan.population
    first_id = F.lit((pop.max_row_id or 0) + 1)
    if name == DUPLICATED:
        return {plan.row_id: F.col(plan.row_id) - F.lit(pop.min_row_id or 0) + first_id}
    if pop.max_key is None:
        new_key = F.concat(F.lit(f"synthetic-volume-{SCENARIO_BY_NAME[name].seed}-"), pick.cast("string"))
    else:
        new_key = F.lit(int(pop.max_key) + 1) + pick
    return {plan.row_id: first_id + pick, KEY: new_key.cast(plan.feed.schema[KEY].dataType)}


def appended_rows(plan: FaultPlan, name: str) -> DataFrame:
    """Rows a scenario adds, under row ids above the feed's own."""
    rows = plan.feed.where(plan.hit(name)) if name == DUPLICATED else _spike_picks(plan)
    new = _new_values(plan, name, F.col("pick"))
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in plan.feed.columns))


def inject(plan: FaultPlan, name: str) -> DataFrame:
    """The corrupted table of one scenario. The feed itself is never changed."""
    feed = plan.feed
    if name == DROPPED:
        return feed.drop(AGENCY)
    if name == RENAMED:
        return feed.withColumnRenamed(CATEGORY, RENAMED_COLUMN)
    if name in APPENDING:
        return feed.unionByName(appended_rows(plan, name))
    new = {c: F.when(plan.hit(name), v).otherwise(F.col(c).cast("string"))
           for c, v in _overwrites(plan, name).items()}
    return feed.select(*(new[c].alias(c) if c in new else F.col(c) for c in feed.columns))


def affected_rows(plan: FaultPlan, name: str) -> DataFrame:
    """Ground truth as (scenario, row_id): the rows a scenario changed or appended."""
    if name in (DROPPED, RENAMED):
        rows = plan.feed
    elif name in APPENDING:
        rows = appended_rows(plan, name)
    else:
        rows = plan.feed.where(plan.hit(name))
    return rows.select(F.lit(name).alias(SCENARIO), F.col(plan.row_id).alias("row_id"))


def changed_rows(plan: FaultPlan, names: Sequence[str] | None = None) -> DataFrame:
    """The rows that scenarios change or append, as they are afterwards, with the scenario.

    With the feed this is all that is needed to rebuild a scenario's table (``rebuild``);
    the two column faults change no row. The feed is read once for all scenarios.
    """
    names = [n for n in names or SCENARIO_BY_NAME if n not in (DROPPED, RENAMED)]
    tables = fan_out(plan, names, clean=CLEAN)
    changed = tables.frame.where(F.col(MEMBERS).bitwiseAND(bit(tables.names.index(CLEAN))) == 0)
    return changed.select(
        F.explode(F.filter(
            F.array(*(F.when(tables.member(n), F.lit(n)) for n in names)), lambda n: n.isNotNull()
        )).alias(SCENARIO), plan.row_id, *tables.columns[CLEAN],
    )


def rebuild(feed: DataFrame, changed: DataFrame, name: str, row_id: str = "row_id") -> DataFrame:
    """One scenario's table from the feed and the stored ``changed_rows``."""
    if name == DROPPED:
        return feed.drop(AGENCY)
    if name == RENAMED:
        return feed.withColumnRenamed(CATEGORY, RENAMED_COLUMN)
    new = changed.where(F.col(SCENARIO) == name).drop(SCENARIO)
    old = feed.join(new.select(row_id), row_id, "left_anti")
    texts = {c for c in feed.columns if new.schema[c].dataType != feed.schema[c].dataType}
    old = old.select(*(F.col(c).cast(new.schema[c].dataType) if c in texts else F.col(c) for c in feed.columns))
    return old.unionByName(new)


def spike_sources(plan: FaultPlan) -> DataFrame:
    """(row_id, source_row_id) of the rows that the volume spike appends."""
    first_id = F.lit((plan.population.max_row_id or 0) + 1)
    return _spike_picks(plan).select(
        (first_id + F.col("pick")).alias("row_id"), F.col(plan.row_id).alias("source_row_id"))


def fan_out(
    plan: FaultPlan,
    names: Sequence[str] | None = None,
    clean: str | None = CLEAN,
    appended: DataFrame | None = None,
    only: Sequence[str] | None = None,
) -> Tables:
    """Clean feed and all scenarios as one set of tables, read in a single scan.

    A row comes out once for all scenarios that leave it alone, and once more for each
    scenario that changes or repeats it; memberships tell which. With the usual sizes that is a
    third of the rows that separate tables would hold. Appended rows come out of the same
    scan, or by union from ``appended`` if they were stored before. With ``only`` the tables hold just those
    columns, and scenarios that change none of them leave every row alone.
    """
    names = list(names or SCENARIO_BY_NAME)
    feed = plan.feed
    kept = [c for c in feed.columns if only is None or c in only or c == plan.row_id]
    tags = ([clean] if clean else []) + names
    bits = {tag: bit(position) for position, tag in enumerate(tags)}
    reshaping = [n for n, c in ((DROPPED, AGENCY), (RENAMED, CATEGORY)) if n in names and c in kept]
    sampling = [n for n in names if n in plan.draws and set(_overwrites(plan, n)) & set(kept)]
    none = F.lit(0).cast("long")

    hits = [F.when(plan.hit(n), bits[n]).otherwise(none) for n in sampling]
    hit = F.col("_hits")
    everyone = sum(1 << i for i, tag in enumerate(tags) if tag not in reshaping)

    def copy(name: str, members: Column, pick: Column = none) -> Column:
        return F.struct(F.lit(name).alias("variant"), members.alias(MEMBERS), pick.alias("pick"))

    variants = [copy(CLEAN, F.lit(everyone).cast("long") - hit)]
    variants += [copy(n, bits[n]) for n in reshaping]
    variants += [F.when(hit.bitwiseAND(bits[n]) != 0, copy(n, bits[n])) for n in sampling]
    adding = [n for n in APPENDING if n in names and appended is None]
    spiked = F.lit(None).cast("string")
    if DUPLICATED in adding:
        variants.append(F.when(plan.hit(DUPLICATED), copy(DUPLICATED, bits[DUPLICATED])))
    if SPIKE in adding and plan.spike:
        spiked = F.when(plan.spike[0].eligible, draw_hash(plan.spike[0].seed, plan.row_id))
        low = F.lit(plan.population.min_row_id or 0)
        variants += [
            F.when(F.col("_spiked") <= plan.thresholds[d.name],
                   copy(SPIKE, bits[SPIKE], (F.col(plan.row_id) - low) * len(plan.spike) + i))
            for i, d in enumerate(plan.spike)
        ]
    copies = (
        feed.withColumn("_hits", reduce(lambda a, b: a.bitwiseOR(b), hits, none)).withColumn("_spiked", spiked)
        .withColumn("_v", F.explode(F.array(*variants)))
    )
    variant = F.col("_v.variant")
    changes: dict[str, Column] = {}
    for name in sampling:
        for column, value in _overwrites(plan, name).items():
            before = changes.get(column, F.col(column).cast("string"))
            changes[column] = F.when(variant == name, value).otherwise(before)
    for name in adding:
        for column, value in _new_values(plan, name, F.col("_v.pick")).items():
            changes[column] = F.when(variant == name, value).otherwise(changes.get(column, F.col(column)))
    for name, column in ((DROPPED, AGENCY), (RENAMED, CATEGORY)):
        if name in reshaping:
            changes[column] = F.when(variant != name, changes.get(column, F.col(column)))
    new = [changes[c].alias(c) if c in changes else F.col(c) for c in kept]
    if RENAMED in reshaping:
        new.append(F.when(variant == RENAMED, F.col(CATEGORY)).alias(RENAMED_COLUMN))
    # Scenarios that leave a row alone have null copies. A row that every tag left is hit by all
    # of them; it has no common copy.
    frame = copies.select(F.col(f"_v.{MEMBERS}").alias(MEMBERS), *new).where(F.col(MEMBERS) != 0)

    if appended is not None:
        tag = reduce(
            lambda rest, n: F.when(F.col(SCENARIO) == n, bits[n]).otherwise(rest),
            (n for n in names if n in APPENDING), none,
        )
        typed = [F.col(c).cast(frame.schema[c].dataType).alias(c) for c in kept]
        frame = frame.unionByName(appended.select(tag.alias(MEMBERS), *typed), allowMissingColumns=True)
    data = tuple(c for c in kept if c != plan.row_id)
    columns = {t: data for t in tags}
    if DROPPED in reshaping:
        columns[DROPPED] = tuple(c for c in data if c != AGENCY)
    if RENAMED in reshaping:
        columns[RENAMED] = tuple(RENAMED_COLUMN if c == CATEGORY else c for c in data)
    keeping = [t for t in tags if t not in APPENDING]  # no other scenario touches keys
    return Tables(frame, columns, plan.row_id, shared=True,
                  key_groups={t: keeping[0] for t in keeping})


def affected_count(plan: FaultPlan, name: str) -> int:
    if name in (DROPPED, RENAMED):
        return plan.population.rows
    if name == SPIKE:
        return plan.spike_size
    return plan.draws[name].size


def parameters(plan: FaultPlan, name: str) -> dict:
    """The settings of one scenario as recorded in the manifest."""
    pop = plan.population
    if name == DROPPED:
        return {"deleted_column": AGENCY}
    if name == RENAMED:
        return {"original_column": CATEGORY, "renamed_column": RENAMED_COLUMN}
    if name == DUPLICATED:
        return {"appended_row_count": affected_count(plan, name)}
    if name == SPIKE:
        start = f"synthetic-volume-{SCENARIO_BY_NAME[name].seed}-0" if pop.max_key is None else int(pop.max_key) + 1
        return {"target_date": pop.busiest_day, "added_record_count": plan.spike_size,
                "synthetic_unique_key_start": start}
    scenario = SCENARIO_BY_NAME[name]
    if scenario.points is not None:
        blank = pop.rows - pop.filled_detail
        return {"baseline_missing_count": blank,
                "target_additional_percentage_points": scenario.points,
                "resulting_missing_count": blank + affected_count(plan, name)}
    extra = {
        BAD_NUMBER: {"replacement_value": INVALID_LATITUDE},
        BAD_DATE: {"replacement_value": INVALID_CREATED_DATE},
        SHIFT: {"target_category": pop.mode},
        UNSEEN: {"unseen_category": UNSEEN_CATEGORY},
        REVERSED: {"offset_days": -1},
    }[name]
    return {**extra, "requested_affected_count": plan.sizes[name]}


def manifest(plan: FaultPlan, names: Sequence[str] | None = None, folder: str = "injected") -> DataFrame:
    """Ground truth, one row per scenario in run order. It holds no row data.

    The ids of the affected rows are a table of their own (``affected_rows``), since
    they grow with the feed.
    """
    names = [s.name for s in SCENARIOS if s.name in (names or SCENARIO_BY_NAME)]
    chosen = [SCENARIO_BY_NAME[n] for n in names]
    frame = literal_rows(
        plan.feed.sparkSession,
        {
            "position": list(range(len(names))),
            "scenario_name": names,
            "fault_type": [s.fault_type for s in chosen],
            "expected_issue_types": [list(s.expected) for s in chosen],
            "affected_columns": [list(s.columns) for s in chosen],
            "affected_row_count": [affected_count(plan, n) for n in names],
            "parameters": [json.dumps(parameters(plan, n)) for n in names],
            "random_seed": [s.seed for s in chosen],
            "description": [s.description for s in chosen],
            "output_path": [f"{folder}/{n}" for n in names],
            "rows": [plan.population.rows] * len(names),
            "blank_before": [plan.population.rows - plan.population.filled_detail] * len(names),
        },
        "position int, scenario_name string, fault_type string, expected_issue_types array<string>,"
        " affected_columns array<string>, affected_row_count long, parameters string,"
        " random_seed long, description string, output_path string, rows long, blank_before long",
    )
    emptied = F.col("fault_type") == "increased_missingness"
    after = F.col("blank_before") + F.col("affected_row_count")
    return frame.select(
        *[c for c in frame.columns if c not in ("rows", "blank_before")],
        F.when(emptied, percent(F.col("blank_before"), F.col("rows")))
        .alias("baseline_missingness_percentage"),
        F.when(emptied, percent(after, F.col("rows"))).alias("resulting_missingness_percentage"),
    )
