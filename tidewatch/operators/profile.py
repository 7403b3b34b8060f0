"""One-scan quality profile of one or many tables.

Every row is reduced to four narrow facts: the scenarios it belongs to, its key, a
digest of its whole content and a bit mask holding the answers of all row-level checks.
Counting equal facts (first shuffle, pre-aggregated on the map side) is enough to answer
everything:

* summed up, the facts give all row-level counters and the copies of rows (where nobody asks
  for copies, ``key_counters`` have facts without digests; where nobody asks for keys either,
  ``row_counters`` count row by row, without these shuffles);
* counted per key (second shuffle, again pre-aggregated), they give repeated keys and
  the rows to reject, for all scenarios side by side and without a self join.

Both read the same first exchange, so the table is scanned once. A key or a
row that makes up a large part of the table collapses to one fact per map task
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.contract import Contract
from tidewatch.functions import exact_text, percent
from tidewatch.operators import checks as C
from tidewatch.operators.tables import MEMBERS, SCENARIO, Tables, bit, literal_rows

BITS_PER_WORD = 60
KEY, DIGEST, COPIES = "key", "digest", "copies"
KEYED = "duplicate_key_rows"
EXTRA_SLOTS = (KEYED, "invalid_timestamp_rows", "invalid_numeric_rows")


def row_digest(columns: list[tuple[str, T.DataType]]) -> Column:
    """SHA-256 of the whole row; equal exactly when all values are (nulls alike).

    The row goes in as a JSON array of texts, which keeps value borders and nulls apart.
    """
    row = F.to_json(F.array(*(exact_text(F.col(name), dtype) for name, dtype in columns)))
    return F.unhex(F.sha2(row, 256))


@dataclass(frozen=True)
class Profile:
    """Per-scenario counters (one row per scenario) and what their columns mean.

    ``row_counters`` are those that look at one row at a time, from a plain aggregation
    without keys and digests, and ``key_counters`` also those of keys, without digests; None where
    ``counters`` are stored anyway.
    """

    counters: DataFrame
    checks: tuple[C.Check, ...]
    tables: Tables
    contract: Contract
    row_counters: DataFrame | None = None
    key_counters: DataFrame | None = None

    @property
    def by_key(self) -> DataFrame:
        return self.counters if self.key_counters is None else self.key_counters

    @property
    def by_row(self) -> DataFrame:
        return self.counters if self.row_counters is None else self.row_counters

    def count_of(self, kind: str, field: str) -> Column:
        for position, check in enumerate(self.checks):
            if check.kind == kind and check.field == field:
                return F.col(f"c{position}")
        return F.lit(0).cast("long")

    def fields_of(self, kind: str) -> list[str]:
        return [check.field for check in self.checks if check.kind == kind]


def profile(tables: Tables, contract: Contract) -> Profile:
    """All counters of sections missingness, types, keys, duplicates and rejection."""
    checks = (
        C.blank_checks(tables)
        + C.type_checks(tables, contract)
        + C.date_order_checks(tables, contract)
        + C.own_checks(tables, contract)
    )
    words = -(-len(checks) // BITS_PER_WORD) or 1
    masks = [f"m{i}" for i in range(words)]
    has_key = contract.key in tables.all_columns()

    # Physical plan note: conditions are evaluated once, here; later stages only test bits.
    def word(index: int) -> Column:
        members = checks[index * BITS_PER_WORD : (index + 1) * BITS_PER_WORD]
        bits = [F.when(c.condition, bit(i)).otherwise(F.expr("0L")) for i, c in enumerate(members)]
        return reduce(lambda a, b: a.bitwiseOR(b), bits, F.expr("0L"))

    def bit_set(position: int) -> Column:
        return F.expr(f"(m{position // BITS_PER_WORD} & {1 << position % BITS_PER_WORD}L) != 0")

    def any_of(*kinds: str, fields: set[str] | None = None) -> Column:
        chosen = [i for i, c in enumerate(checks)
                  if c.kind in kinds and (fields is None or c.field in fields)]
        tests = []
        for index in range(words):
            in_word = sum(1 << (i % BITS_PER_WORD) for i in chosen if i // BITS_PER_WORD == index)
            if in_word:
                tests.append(F.expr(f"(m{index} & {in_word}L) != 0"))
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    key = F.lit(None).cast("string")
    if has_key:
        key_column = F.col(contract.key)
        blank = C.is_blank(key_column, tables.dtype(contract.key))
        key = F.when(~blank, exact_text(key_column, tables.dtype(contract.key)))

    content = [(name, tables.dtype(name)) for name in tables.all_columns()]
    def counted_facts(digests: bool) -> DataFrame:
        digest = [row_digest(content).alias(DIGEST)] if digests else []
        rows = tables.frame.select(
            F.col(MEMBERS), key.alias(KEY), *digest, *(word(i).alias(masks[i]) for i in range(words)))
        return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))

    must_fill = set(C.required_fields(tables, contract)) | ({contract.key} if has_key else set())
    own = [check.name for check in contract.checks]
    bad = any_of(C.INVALID_TIMESTAMP, C.INVALID_NUMERIC, C.OUT_OF_RANGE, C.DATE_ORDER, *own) | any_of(
        C.BLANK, fields=must_fill
    )

    in_row = {
        "total_rows": F.lit(True),
        **{f"c{i}": bit_set(i) for i in range(len(checks))},
        "invalid_timestamp_rows": any_of(C.INVALID_TIMESTAMP),
        "invalid_numeric_rows": any_of(C.INVALID_NUMERIC, C.OUT_OF_RANGE),
    }
    # A counter for each membership and task is all that is shuffled.
    counted = (
        tables.frame.select(F.col(MEMBERS), *(word(i).alias(masks[i]) for i in range(words)))
        .groupBy(MEMBERS).agg(*(F.count_if(c).alias(n) for n, c in in_row.items()))
    )
    counted = tables.per_scenario(counted).groupBy(SCENARIO).agg(*(F.sum(n).alias(n) for n in in_row))
    row_counters = tables.names_frame().join(F.broadcast(counted), SCENARIO, "left").na.fill(0)

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(COPIES)).otherwise(0))

    def summary(copies: bool) -> DataFrame:
        """Counters of rows and keys, with ``copies`` also of whole rows that occur again."""
        facts = counted_facts(digests=copies)
        sums = {
            **{n: rows_where(c) for n, c in in_row.items()},
            **({"duplicate_rows": F.sum(F.col(COPIES) - 1)} if copies else {}),
            "rejected_without_key": rows_where(F.col(KEY).isNull() & bad),
        }
        # Few distinct memberships, so the first grouping leaves few rows per task.
        per_table = (
            tables.per_scenario(facts.groupBy(MEMBERS).agg(*(s.alias(n) for n, s in sums.items())))
            .groupBy(SCENARIO)
            .agg(*(F.sum(n).alias(n) for n in sums))
        )
        if copies and tables.shared:
            # Copies of a row can differ in membership; then distinct rows are counted instead.
            # The always true condition keeps the count in the plan: without it the facts would
            # be computed a second time, in a slightly smaller form.
            held = F.bit_or(F.when(F.col(COPIES) > 0, F.col(MEMBERS)))
            distinct = facts.groupBy(KEY, DIGEST).agg(held.alias(MEMBERS))
            distinct = tables.per_scenario(
                distinct.groupBy(MEMBERS).agg(F.count(F.lit(1)).alias("distinct_rows"))
            ).groupBy(SCENARIO).agg(F.sum("distinct_rows").alias("distinct_rows"))
            per_table = (
                per_table.join(F.broadcast(distinct), SCENARIO)  # a row per scenario
                .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
                .drop("distinct_rows")
            )

        # Rows of each key are counted once per group of scenarios that hold the same keys.
        # Whether a key is bad matters only where it is unique (a repeated key is rejected
        # anyway), so one bit per scenario says it all. Rows without a key stay in as one
        # null group: a filter on the key would be pushed below the first exchange, and the
        # scan could no longer be shared.
        holders = list(dict.fromkeys(tables.same_keys_as(n) for n in tables.names))
        per_key = facts.groupBy(KEY).agg(
            *(rows_where(tables.member(h)).alias(f"n{i}") for i, h in enumerate(holders)),
            F.bit_or(F.when(bad, F.col(MEMBERS)).otherwise(F.lit(0).cast("long"))).alias(MEMBERS),
        )

        def of_key(name: str) -> Column:
            n = F.col(f"n{holders.index(tables.same_keys_as(name))}")
            known = F.col(KEY).isNotNull()
            repeated = F.when(known & (n > 1), n)
            lone_bad = F.when(known & tables.member(name), 1)
            return F.struct(
                F.sum(F.coalesce(repeated, F.lit(0))).alias("duplicate_key_rows"),
                F.sum(F.coalesce(repeated, lone_bad, F.lit(0))).alias("rejected_with_key"),
            )

        names = tables.names
        keyed = (
            per_key.agg(*(of_key(n).alias(f"s{i}") for i, n in enumerate(names)))
            .select(F.posexplode(F.array(*(F.col(f"s{i}") for i in range(len(names))))).alias("position", "s"))
            .select("position", "s.*")
        )
        # One row per scenario on every side of these joins.
        return (
            tables.names_frame()
            .join(F.broadcast(per_table), SCENARIO, "left")
            .join(F.broadcast(keyed), "position", "left")
            .na.fill(0)
            .withColumn("rejected_rows", F.col("rejected_without_key") + F.col("rejected_with_key"))
            .drop("rejected_without_key", "rejected_with_key")
        )

    return Profile(summary(copies=True), tuple(checks), tables, contract, row_counters, summary(copies=False))


def counted_cells(profile: Profile, described: Mapping[str, list], schema: str) -> DataFrame:
    """Counters as rows (scenario, total_rows, slot, n), joined to a description of each slot.

    Slot *i* is check *i*; the slots after the checks hold ``EXTRA_SLOTS``. The description
    has one entry per scenario and slot to keep, so it is bounded by the contract. Keys are
    counted only if a described slot asks for them, whole rows never.
    """
    keyed = len(profile.checks) + EXTRA_SLOTS.index(KEYED) in described["slot"]
    values = [F.col(f"c{i}") for i in range(len(profile.checks))]
    values += [F.col(c) if keyed or c != KEYED else F.lit(0).cast("long") for c in EXTRA_SLOTS]
    cells = (profile.by_key if keyed else profile.by_row).select(
        SCENARIO, "total_rows", F.posexplode(F.array(*values)).alias("slot", "n")
    )
    about = literal_rows(profile.tables.spark, described, f"{SCENARIO} string, slot int, {schema}")
    return cells.join(F.broadcast(about), [SCENARIO, "slot"])


def described(entries: list[tuple], names: Sequence[str]) -> dict[str, list]:
    """Columns of a description from its rows."""
    return {name: [entry[i] for entry in entries] for i, name in enumerate(names)}


def slot_of(profile: Profile, kind: str, field: str) -> int | None:
    for position, check in enumerate(profile.checks):
        if check.kind == kind and check.field == field:
            return position
    return len(profile.checks) + EXTRA_SLOTS.index(kind) if kind in EXTRA_SLOTS else None


def missingness(profile: Profile) -> DataFrame:
    """Missing share of every column a table really has, next to its contract limit.

    ``threshold`` is null without a limit; ``exceeded`` compares the two-digit share
    with ``>``.
    """
    entries = []
    for name, columns in profile.tables.columns.items():
        for position, column in enumerate(columns):
            rule = profile.contract.rule(column)
            entries.append((name, slot_of(profile, C.BLANK, column), position, column,
                            None if rule is None else rule.max_missing))
    about = described(entries, (SCENARIO, "slot", "column_position", "field", "threshold"))
    cells = counted_cells(profile, about, "column_position int, field string, threshold double")
    return cells.select(
        SCENARIO, "column_position", "field", "total_rows", F.col("n").alias("missing_count"),
        percent(F.col("n"), F.col("total_rows")).alias("missing_percentage"), "threshold",
    ).withColumn("exceeded", F.coalesce(F.col("missing_percentage") > F.col("threshold"), F.lit(False)))


def exceeded_missingness(profile: Profile) -> DataFrame:
    return (
        missingness(profile)
        .where("exceeded")
        .select(
            SCENARIO,
            "field",
            F.col("missing_percentage").alias("observed_missing_percentage"),
            F.col("threshold").alias("maximum_missing_percentage"),
        )
    )


def datatype_profile(profile: Profile) -> DataFrame:
    """Failed type and range checks per column, and distinct failing rows under ``*``."""
    kinds = (C.INVALID_TIMESTAMP, C.INVALID_NUMERIC, C.OUT_OF_RANGE)
    entries = []
    for name, columns in profile.tables.columns.items():
        entries += [(name, i, check.field, check.kind) for i, check in enumerate(profile.checks)
                    if check.kind in kinds and check.field in columns]
        entries += [(name, slot_of(profile, kind, ""), "*", kind)
                    for kind in ("invalid_timestamp_rows", "invalid_numeric_rows")]
    about = described(entries, (SCENARIO, "slot", "field", "check"))
    cells = counted_cells(profile, about, "field string, check string")
    return cells.select(SCENARIO, "field", "check", F.col("n").alias("row_count"))


def quality_metrics(profile: Profile) -> DataFrame:
    """Headline counters and percentages, one row per scenario."""
    total = F.col("total_rows")
    key = profile.contract.key
    order = profile.contract.date_order
    return profile.counters.select(
        SCENARIO,
        total.alias("total_rows_processed"),
        F.col("duplicate_rows").alias("duplicate_row_count"),
        percent(F.col("duplicate_rows"), total).alias("duplicate_row_percentage"),
        F.col("duplicate_key_rows").alias("duplicate_unique_key_count"),
        percent(F.col("duplicate_key_rows"), total).alias("duplicate_unique_key_percentage"),
        F.col("invalid_timestamp_rows").alias("invalid_timestamp_row_count"),
        (profile.count_of(C.DATE_ORDER, order.field) if order else F.lit(0).cast("long"))
        .alias("invalid_date_order_count"),
        F.col("invalid_numeric_rows").alias("invalid_numeric_row_count"),
        profile.count_of(C.BLANK, key).alias("missing_unique_key_count"),
        F.col("rejected_rows").alias("rejected_row_count"),
    )
