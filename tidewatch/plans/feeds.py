"""A service-request feed derived from the ``events`` table, clean and with defects.

All data columns are text, as they arrive from a landing zone; ``row_id`` is the
stable row identity. The defects follow fixed divisors of the event id, so the same
rows are hit at every run and in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSS"

FEED_COLUMNS = {
    "row_id": "event_id",
    "unique_key": "cast(event_id as string)",
    "created_date": f'date_format(ts, "{TEXT_TIMESTAMP}")',
    "closed_date": "if(event_id % 3 = 0, null, date_format("
    f'ts + make_interval(0, 0, 0, 0, cast(event_id % 50 as int)), "{TEXT_TIMESTAMP}"))',
    "agency": "'A' || cast(user_id % 7 as string)",
    "complaint_type": "event_type",
    "descriptor": "if(event_id % 50 = 0, null, props)",
    "status": "if(event_id % 3 = 0, 'Open', 'Closed')",
    "borough": "'B' || cast(user_id % 5 as string)",
    "incident_zip": "lpad(cast(user_id as string), 5, '0')",
    "latitude": "cast(value / 10 as string)",
    "longitude": "cast(-value / 10 as string)",
}

DEFECTS = {
    "unique_key": "case when event_id % 422 = 0 then '' when event_id % 211 = 0 then '   ' "
    "when event_id % 101 = 0 then cast(event_id - 1 as string) else unique_key end",
    "created_date": "if(event_id % 97 = 0, 'not-a-date', created_date)",
    "closed_date": "if(event_id % 71 = 0, "
    f'date_format(ts - interval 1 day, "{TEXT_TIMESTAMP}"), closed_date)',
    "agency": "if(event_id % 61 = 0, '  ', agency)",
    "latitude": "case when event_id % 89 = 0 then 'north' when event_id % 83 = 0 then '123.5' "
    "else latitude end",
}
COPIED = "event_id % 151 = 0"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def clean_feed(events: DataFrame) -> DataFrame:
    return events.select(*(F.expr(e).alias(name) for name, e in FEED_COLUMNS.items()))


def dirty_feed(events: DataFrame) -> DataFrame:
    """The feed with overlapping defects and exact copies (under row ids below zero)."""
    raw = events.select("event_id", "ts", *(F.expr(e).alias(n) for n, e in FEED_COLUMNS.items()))
    copies = F.when(F.expr(COPIED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = raw.withColumn("_copy", F.explode(copies))
    columns = []
    for name in FEED_COLUMNS:
        column = F.expr(DEFECTS.get(name, name))
        if name == "row_id":
            column = F.when(F.col("_copy") == 1, -1 - F.col("row_id")).otherwise(F.col("row_id"))
        columns.append(column.alias(name))
    return rows.select(*columns)
