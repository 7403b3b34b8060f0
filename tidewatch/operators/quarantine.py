"""Rows rejected by the contract, with their reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidewatch.catalog import ISSUE_SAMPLE_LIMIT, REJECTED_PREVIEW_LIMIT
from tidewatch.contract import Contract
from tidewatch.functions import exact_text
from tidewatch.operators import checks as C
from tidewatch.operators.tables import Tables

REASONS = "reject_reasons"
HOT_SHARE = 1000


def repeated_keys(frame: DataFrame, keys: list[str], text_key: bool = False) -> DataFrame:
    """Keys held by more than one row and their row counts. Null keys never repeat.

    With ``text_key`` blank values are left out as well. Map-side counting shrinks a
    hot key before the shuffle.
    """
    usable = _usable(frame, keys, text_key)
    return frame.where(usable).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _usable(frame: DataFrame, keys: list[str], text_key: bool) -> Column:
    if text_key:
        return ~C.is_blank(F.col(keys[0]), frame.schema[keys[0]].dataType)
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def repeated_key_flag(
    frame: DataFrame, keys: list[str], text_key: bool = False, row_id: str | None = None
) -> DataFrame:
    """``frame`` plus a boolean ``repeated``: does another row hold the same key?

    Keys that hold at least a thousandth of all repeated rows are matched by
    broadcast: by that rule there can be no more than a thousand of them. The rows
    so settled, and rows without a key, need no partner in the join for the rest.
    With a unique ``row_id`` they enter it under that id, which spreads them evenly
    (the leading letter keeps ids apart from keys); without one they bypass the join,
    at the price of a second scan.
    """
    counts = repeated_keys(frame, keys, text_key)
    total = counts.agg(F.sum("n").alias("total")).scalar()
    is_hot = F.col("n") * HOT_SHARE >= total
    hot = counts.where(is_hot).select(*keys, F.lit(True).alias("_hot"))
    marked = frame.join(F.broadcast(hot), keys, "left")
    is_open = F.col("_hot").isNull() & _usable(frame, keys, text_key)
    tagged_key = F.concat(F.lit("k"), exact_text(F.col(keys[0]), frame.schema[keys[0]].dataType))
    rest = counts.where(~is_hot).select(
        tagged_key.alias("_tagged"),
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys[1:])),
        F.lit(True).alias("_cold"),
    )

    def match(rows: DataFrame, key: Column) -> DataFrame:
        condition = [F.col("_key") == F.col("_tagged")] + [
            F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys[1:])
        ]
        joined = rows.withColumn("_key", key).join(rest, reduce(lambda a, b: a & b, condition), "left")
        hit = F.coalesce("_hot", F.lit(False)) | F.coalesce("_cold", F.lit(False))
        return joined.select(*frame.columns, hit.alias("repeated"))

    if row_id is not None:
        own = F.concat(F.lit("s"), F.col(row_id).cast("string"))
        return match(marked, F.when(is_open, tagged_key).otherwise(own))
    settled = marked.where(~is_open).select(
        *frame.columns, F.coalesce("_hot", F.lit(False)).alias("repeated")
    )
    return match(marked.where(is_open), tagged_key).unionByName(settled)


def _reason(check: C.Check) -> Column:
    return F.when(check.condition, F.lit(f"{check.kind}:{check.field}"))


def with_reasons(tables: Tables, contract: Contract) -> DataFrame:
    """Every row of a single table with the array of its reject reasons, in issue order."""
    reasons = [_reason(check) for check in C.row_rejections(tables, contract)]
    frame = tables.data
    base = frame.withColumn(REASONS, F.array_compact(F.array(*reasons)) if reasons
                            else F.array().cast("array<string>"))
    if contract.key not in tables.all_columns():
        return base
    text_key = isinstance(tables.dtype(contract.key), T.StringType)
    flagged = repeated_key_flag(base, [contract.key], text_key, tables.row_id)
    duplicate = F.lit(f"{C.DUPLICATE_KEY}:{contract.key}")
    return flagged.withColumn(
        REASONS, F.when(F.col("repeated"), F.array_append(REASONS, duplicate)).otherwise(F.col(REASONS))
    ).drop("repeated")


def rejected_rows(tables: Tables, contract: Contract) -> DataFrame:
    """The quarantine table: rejected rows with all columns and their reasons."""
    return with_reasons(tables, contract).where(F.size(REASONS) > 0)


def duplicate_key_rows(
    frame: DataFrame, keys: list[str], text_key: bool = False, row_id: str | None = None
) -> DataFrame:
    """All rows whose key occurs more than once."""
    return repeated_key_flag(frame, keys, text_key, row_id).where("repeated").drop("repeated")


def rejected_preview(
    tables: Tables, contract: Contract, limit: int = REJECTED_PREVIEW_LIMIT
) -> DataFrame:
    """The first rejected rows by row id (a top-k plan, no full sort)."""
    return rejected_rows(tables, contract).orderBy(_row_id(tables, contract)).limit(limit)


def issue_samples(
    tables: Tables, contract: Contract, limit: int = ISSUE_SAMPLE_LIMIT
) -> DataFrame:
    """Smallest row ids per reason, at most ``limit`` each, with reason type and field.

    The rank filter is cut off inside each map task already, so only ``limit`` rows
    per task and reason are shuffled, however many rows share the reason.
    """
    exploded = rejected_rows(tables, contract).select(
        F.explode(REASONS).alias("reason"), F.col(_row_id(tables, contract)).alias("row_id")
    )
    rank = F.row_number().over(Window.partitionBy("reason").orderBy("row_id"))
    return (
        exploded.withColumn("rank", rank)
        .where(F.col("rank") <= limit)
        .groupBy("reason")
        .agg(F.sort_array(F.collect_list("row_id")).alias("sample_row_ids"))
        .select(
            F.substring_index("reason", ":", 1).alias("issue_type"),
            F.expr("substring(reason, instr(reason, ':') + 1)").alias("affected_field"),
            "sample_row_ids",
        )
    )


def _row_id(tables: Tables, contract: Contract) -> str:
    return tables.row_id or contract.key
