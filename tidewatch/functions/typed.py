"""Readings of raw values as timestamps and numbers. What cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: accepted shapes --------------------------------------------
TIMESTAMP_PATTERN = (
    r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?\s*$"
)
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"

KEEP_NULLS = {"ignoreNullFields": "false"}


def to_utc_timestamp(column: Column, dtype: T.DataType) -> Column:
    """ISO date or datetime text as a timestamp; the session runs in UTC.

    The shape is checked first because the cast alone also takes a bare year or a
    bare time of day.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    text = column.cast("string")
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp"))


def to_number(column: Column, dtype: T.DataType) -> Column:
    """Decimal, exponent or infinity text as a double; NaN counts as unreadable."""
    if isinstance(dtype, T.NumericType):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    text = column.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def calendar_day(timestamp: Column) -> Column:
    """UTC calendar day as ``YYYY-MM-DD`` text."""
    return F.date_format(timestamp, "yyyy-MM-dd")


def exact_text(column: Column, dtype: T.DataType) -> Column:
    """A text that is equal exactly for equal values: 0.0 like -0.0, bytes as hex, at any depth."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (column + F.lit(0.0)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    if isinstance(dtype, T.ArrayType):
        return F.to_json(F.transform(column, lambda x: exact_text(x, dtype.elementType)), KEEP_NULLS)
    if isinstance(dtype, T.StructType):
        parts = [exact_text(column.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)]
        return F.when(column.isNotNull(), F.to_json(F.struct(*parts), KEEP_NULLS))
    if isinstance(dtype, T.MapType):
        pairs = F.transform(F.map_entries(column), lambda e: F.struct(
            exact_text(e["key"], dtype.keyType).alias("k"), exact_text(e["value"], dtype.valueType).alias("v")))
        return F.to_json(F.array_sort(pairs), KEEP_NULLS)
    return column.cast("string")
