"""Text predicates and normalisation.

Whitespace means Unicode whitespace plus the four ASCII separators U+001C-U+001F.
Spark's ``trim`` only knows the space character, so these use patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: patterns ---------------------------------------------------
SPACE = r"[\s\x1c-\x1f]"
VISIBLE_PATTERN = r"(?U)[^\s\x1c-\x1f]"
EDGE_PATTERN = rf"(?U)^{SPACE}+|{SPACE}+\z"
RUN_PATTERN = rf"(?U){SPACE}+"


def is_blank(column: Column, dtype: T.DataType) -> Column:
    """Null, NaN, empty or whitespace only. Most texts begin with a visible ASCII character."""
    if isinstance(dtype, T.StringType):
        return column.isNull() | ~(F.ascii(column).between(33, 126) | column.rlike(VISIBLE_PATTERN))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def strip_text(column: Column) -> Column:
    """Text with whitespace removed from both ends; inner case and spacing kept."""
    text = column.cast("string")
    inside = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(inside, text).otherwise(F.regexp_replace(text, EDGE_PATTERN, ""))


def normalize_label(column: Column) -> Column:
    """Lower case, with hyphens and whitespace runs turned into single underscores."""
    spaced = F.replace(F.lower(column.cast("string")), F.lit("-"), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(spaced, EDGE_PATTERN, ""), RUN_PATTERN, "_")
