"""Exact copies of whole rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import percent
from tidewatch.operators.profile import row_digest


def duplicate_rows(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Copies beyond the first: count and share of all rows (nulls are equal).

    Only a 32-byte digest per distinct row is shuffled, not the row. One row out.
    """
    names = list(columns or frame.columns)
    content = [(name, frame.schema[name].dataType) for name in names]
    copies = frame.groupBy(row_digest(content).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_row_count"),
    ).withColumn(
        "duplicate_row_percentage", percent(F.col("duplicate_row_count"), F.col("total_rows"))
    )
