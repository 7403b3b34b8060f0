"""Several tables monitored in one pass.

A ``Tables`` value is one DataFrame whose rows say which of the named tables
(scenarios) they belong to, plus the column list each table really had. Membership is
a bit set, so a row that several scenarios share is read, checked and shuffled once.
The column lists are kept apart because a column that is absent and a column that is
full of nulls must stay different things after a union; all scenarios a row belongs to
have the same columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SCENARIO = "scenario"
MEMBERS = "_members"
CURRENT = "current"
MAX_TABLES = 62  # bits of a long; more tables take more passes


def literal_rows(spark: SparkSession, columns: Mapping[str, list], schema: str) -> DataFrame:
    """Driver-side constants as a local relation, so that no job is needed to read them."""
    fields = T.StructType.fromDDL(schema)
    return spark.createDataFrame(pa.table(dict(columns), to_arrow_schema(fields)), fields)


@dataclass(frozen=True)
class Tables:
    frame: DataFrame
    columns: dict[str, tuple[str, ...]]
    row_id: str | None = None
    shared: bool = False  # can a row belong to several scenarios?
    # Scenarios known to hold the same keys, as name -> one representative of the group.
    key_groups: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if len(self.columns) > MAX_TABLES:
            raise ValueError(f"One pass takes up to {MAX_TABLES} tables; use several passes.")

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.columns)

    @property
    def spark(self) -> SparkSession:
        return self.frame.sparkSession

    @property
    def data(self) -> DataFrame:
        """The rows without the membership column."""
        return self.frame.drop(MEMBERS)

    def all_columns(self) -> tuple[str, ...]:
        """Every data column of any scenario, in order of first appearance."""
        return tuple(dict.fromkeys(c for columns in self.columns.values() for c in columns))

    def dtype(self, column: str) -> T.DataType:
        return self.frame.schema[column].dataType

    def holders(self, column: str) -> tuple[str, ...]:
        return tuple(name for name in self.names if column in self.columns[name])

    def same_keys_as(self, name: str) -> str:
        return self.key_groups.get(name, name)

    def member(self, *names: str) -> Column:
        """Does the row belong to one of these scenarios?"""
        bits = sum(1 << self.names.index(name) for name in names)
        return F.expr(f"({MEMBERS} & {bits}L) != 0")

    def where_present(self, condition: Column, column: str) -> Column:
        """Limit a row condition to the scenarios that have the column."""
        holders = self.holders(column)
        return condition if len(holders) == len(self.names) else self.member(*holders) & condition

    def per_scenario(self, grouped: DataFrame) -> DataFrame:
        """Aggregated rows that still carry memberships, once per scenario they belong to."""
        if len(self.names) == 1:
            return grouped.withColumn(SCENARIO, F.lit(self.names[0])).drop(MEMBERS)
        belongs = F.array_compact(F.array(*(F.when(self.member(n), F.lit(n)) for n in self.names)))
        return grouped.withColumn(SCENARIO, F.explode(belongs)).drop(MEMBERS)

    def names_frame(self) -> DataFrame:
        """One row per scenario with its position; the size is the number of scenarios."""
        return literal_rows(
            self.spark,
            {"position": list(range(len(self.names))), SCENARIO: list(self.names)},
            f"position int, {SCENARIO} string",
        )


def bit(position: int) -> Column:
    return F.expr(f"{1 << position}L")


def one_table(frame: DataFrame, row_id: str | None = None, name: str = CURRENT) -> Tables:
    columns = tuple(c for c in frame.columns if c != row_id)
    return Tables(frame.withColumn(MEMBERS, bit(0)), {name: columns}, row_id)


def split_table(
    frame: DataFrame, parts: Mapping[str, Column], row_id: str | None = None
) -> Tables:
    """Parts of one table, given by conditions that may overlap; the table is read once."""
    columns = tuple(c for c in frame.columns if c != row_id)
    members = reduce(
        lambda a, b: a.bitwiseOR(b),
        (F.when(condition, bit(i)).otherwise(F.lit(0).cast("long"))
         for i, condition in enumerate(parts.values())),
    )
    tagged = frame.withColumn(MEMBERS, members).where(F.col(MEMBERS) != 0)
    return Tables(tagged, {name: columns for name in parts}, row_id, shared=len(parts) > 1)


def stack_tables(frames: Mapping[str, DataFrame], row_id: str | None = None) -> Tables:
    """Union tables under their names; a column typed differently across them becomes text."""
    types: dict[str, set[str]] = {}
    for frame in frames.values():
        for column in frame.schema.fields:
            types.setdefault(column.name, set()).add(column.dataType.simpleString())
    mixed = {name for name, seen in types.items() if len(seen) > 1}
    parts = [
        frame.select(
            bit(position).alias(MEMBERS),
            *(F.col(c).cast("string").alias(c) if c in mixed else F.col(c) for c in frame.columns),
        )
        for position, frame in enumerate(frames.values())
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = {
        name: tuple(c for c in frame.columns if c != row_id) for name, frame in frames.items()
    }
    return Tables(union, columns, row_id)
