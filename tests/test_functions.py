from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import functions as fn


def values(spark, items, build, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(build(F.col("v"))).collect()]


def test_blank_covers_unicode_whitespace(spark):
    items = [None, "", " ", "\t\n", "\u00a0", "\u3000", "\x1c", "\x85", "a", " a ", "\u200b", "\u00e9", "0"]
    expected = [v is None or v.strip() == "" for v in items]
    assert values(spark, items, lambda c: fn.is_blank(c, T.StringType())) == expected


def test_blank_numbers_are_null_or_nan(spark):
    got = values(spark, [None, math.nan, 0.0], lambda c: fn.is_blank(c, T.DoubleType()), "double")
    assert got == [True, True, False]


def test_strip_keeps_inner_text(spark):
    items = ["a", " a b ", "\u3000x\u00a0", "\x1cy", "z\n", "\n", "", "\u00e9 "]
    assert values(spark, items, fn.strip_text) == [v.strip() for v in items]


def test_labels(spark):
    items = ["Invalid-Timestamp", "  Category  Drift ", "a - b", "-x-", "already_done"]
    wanted = ["_".join(v.strip().lower().replace("-", " ").split()) for v in items]
    assert values(spark, items, fn.normalize_label) == wanted


@pytest.mark.parametrize("text,seconds", [
    ("2026-01-01T10:00:00.000", 36000), ("2026-01-01", 0), ("2026-01-01 10:00:00", 36000),
    ("2026-01-01T10:00:00Z", 36000), ("2026-01-01T10:00:00+02:00", 28800), (" 2026-01-01 ", 0),
    ("2026", None), ("2026-01", None), ("10:00:00", None), ("bad-date", None), ("", None),
    ("2026-13-01", None), ("2026-01-01T24:00:00", None), (None, None),
])
def test_timestamps(spark, text, seconds):
    got, = values(spark, [text], lambda c: F.unix_timestamp(fn.to_utc_timestamp(c, T.StringType())))
    assert got == (None if seconds is None else 1767225600 + seconds)


@pytest.mark.parametrize("text,number", [
    ("40.7", 40.7), (" -1e5 ", -1e5), (".5", 0.5), ("5.", 5.0), ("inf", math.inf),
    ("-Infinity", -math.inf), ("40.7d", None), ("0x10", None), ("1,000", None), ("1_000", None),
    ("nan", None), ("", None), ("north", None),
])
def test_numbers(spark, text, number):
    got, = values(spark, [text], lambda c: fn.to_number(c, T.StringType()))
    assert got == number


def test_rounding_agrees_with_python(spark):
    generator = random.Random(5)
    items = [0.125, 0.375, 0.145, 0.665, 2.675, 1.005, 99.995, 0.0, 100.0, 4.761904761904762, 1 / 3]
    items += [generator.randrange(0, 20000) / 20000 * 100 for _ in range(500)]
    items += [generator.random() * 100 for _ in range(500)]
    assert values(spark, items, lambda c: fn.round_half_even(c, 2), "double") == [round(v, 2) for v in items]
    assert values(spark, items, lambda c: fn.round_half_even(c, 6), "double") == [round(v, 6) for v in items]


def test_percent_and_ratio_of_nothing_are_zero(spark):
    row = spark.range(1).select(
        fn.percent(F.lit(0), F.lit(0)).alias("p"), fn.safe_ratio(F.lit(1), F.lit(0)).alias("r"),
        fn.percent(F.lit(1), F.lit(21)).alias("q"), fn.safe_ratio(F.lit(2), F.lit(3)).alias("s"),
    ).first()
    assert (row.p, row.r, row.q, row.s) == (0.0, 0.0, 4.76, 0.666667)
