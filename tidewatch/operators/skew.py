"""Joins whose keys may be held by a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has at least one in HEAVY of all rows, so there are at most HEAVY of them.
HEAVY = 1000
#: Places that the rows of a heavy key are dealt to.
SALTS = 64


def is_heavy(n: Column, total: Column) -> Column:
    return (n > 1) & (n * HEAVY >= total)


def join_by_count(
    rows: DataFrame, found: DataFrame, heavy: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """``rows`` joined with ``found``, which has one row for each key.

    ``heavy`` holds the heavy keys, at most HEAVY, so it can be broadcast. Their rows are dealt
    over SALTS places, and their one row in ``found`` is sent to each. Rows with a null key
    match nothing; with ``how`` left they are kept, wherever they lie.
    """
    told = F.broadcast(heavy.select(*(F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)), F.lit(True).alias("_heavy")))
    same = [F.col(k) == F.col(f"_h{i}") for i, k in enumerate(keys)]
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    anywhere = F.monotonically_increasing_id()
    salt = F.when(missing, -1 - anywhere).when(F.col("_heavy"), F.pmod(anywhere, F.lit(SALTS))).otherwise(0)
    salted = rows.join(told, same, "left").select(*rows.columns, salt.alias("_salt"))
    last = F.when(F.col("_heavy"), SALTS - 1).otherwise(0).cast("long")
    others = [c for c in found.columns if c not in keys]
    every = found.join(told, same, "left").select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *others,
        F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_place"))
    same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_salt") == F.col("_place")]
    return salted.join(every, same, how).select(*rows.columns, *others)
