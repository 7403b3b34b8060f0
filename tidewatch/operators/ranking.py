"""Ranks over a whole table without bringing it to one task.

Rows are dealt to ranges of the order, sorted there and numbered; the numbers of rows in
the ranges before, one for each partition, make the numbers global. Ties get their rank from the
first position of their value, counted on the map side, so a value with a third of all rows is
no single task's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.skew import is_heavy, join_by_count
from tidewatch.session import stored

PLACE_BITS = 33  # of monotonically_increasing_id: the number of a row in its partition


def with_positions(frame: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``frame`` with its rows' positions from 0 in ascending ``order``, nulls first.

    The numbered rows are stored, because ranges are chosen from a sample. Rows that are equal
    in all columns of ``order`` lie in one range: end the order with a row id.
    """
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", PLACE_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each partition of the range exchange
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (numbered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, inside + F.col("_before")).drop("_place", "_part", "_before"))


def tile(position: Column, total: Column, tiles: int) -> Column:
    """Tile from 1 of a position: as even as can be, the larger tiles first."""
    size, larger = F.floor(total / tiles), total % tiles
    edge = larger * (size + 1)
    return F.when(position < edge, F.floor(position / (size + 1))).otherwise(
        larger + F.floor((position - edge) / F.greatest(size, F.lit(1)))).cast("long") + 1


def global_ranks(frame: DataFrame, value: str, row_id: Sequence[str], tiles: int = 4) -> DataFrame:
    """``frame`` with row_number, rank, dense_rank, percent_rank, cume_dist and ntile by ``value``.

    Ascending, ties of row_number and ntile in order of ``row_id`` (columns that tell rows apart).
    Rows with a null value have null ranks and count nowhere.
    """
    known = frame.where(F.col(value).isNotNull())
    numbered = with_positions(known.select(F.struct("*").alias("_row"), F.col(value).alias("_value"), *(
        F.col(c).alias(f"_id{i}") for i, c in enumerate(row_id))), ["_value", *(f"_id{i}" for i in range(len(row_id)))], "_at")
    values = numbered.groupBy("_value").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_ties"))
    values = with_positions(values, ["_value"], "_dense")
    total = values.agg(F.sum("_ties")).scalar()
    heavy = values.where(is_heavy(F.col("_ties"), total)).select("_value")
    ranked = join_by_count(numbered, values, heavy, ["_value"], "inner")
    rest = frame.where(F.col(value).isNull()).select(F.struct("*").alias("_row"))
    done = ranked.select(
        "_row", (F.col("_at") + 1).alias("row_number"), (F.col("_first") + 1).alias("rank"),
        (F.col("_dense") + 1).alias("dense_rank"),
        F.when(total > 1, F.col("_first") / (total - 1)).otherwise(0.0).alias("percent_rank"),
        ((F.col("_first") + F.col("_ties")) / total).alias("cume_dist"), tile(F.col("_at"), total, tiles).alias("ntile"))
    return done.unionByName(rest, allowMissingColumns=True).select("_row.*", *done.columns[1:])
