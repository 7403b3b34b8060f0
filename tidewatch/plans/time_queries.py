"""Queries over time: streamed volume, keys across snapshots, as-of joins, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import to_utc_timestamp
from tidewatch.operators.asof import asof_join
from tidewatch.operators.history import KeyHistory
from tidewatch.operators.intervals import concurrency, overlap_counts
from tidewatch.operators.volume import COUNT, DAY
from tidewatch.plans.feeds import read_table
from tidewatch.plans.queries import _stored, dirty, feed, query
from tidewatch.streaming.volume import VolumeStream, open_day_counts

LANDINGS = 4


def _landings(spark, folder) -> list[DataFrame]:
    """The dirty feed in four landings by date; one row in twenty comes a landing late."""
    rows = dirty(spark, folder)
    total = read_table(spark, folder, "events").agg(F.max("event_id") + 1).first()[0]
    number = F.when(F.col("row_id") < 0, -1 - F.col("row_id")).otherwise(F.col("row_id"))
    landing = F.floor(number * LANDINGS / total) + F.when(number % 20 == 0, 1).otherwise(0)
    placed = rows.withColumn("_landing", F.least(landing, F.lit(LANDINGS - 1)))
    return [placed.where(F.col("_landing") == k).drop("_landing") for k in range(LANDINGS)]


def _followed(spark, folder, delay: str) -> tuple[VolumeStream, DataFrame]:
    """The landings, each streamed when it arrives, in a run that knows of the others by the folder only."""
    parts, path = _landings(spark, folder), _stored(spark, "landing")
    job = VolumeStream(_stored(spark, "volume"), delay=delay)
    for part in parts:
        # one file: a landing is one batch, whatever the cluster
        part.coalesce(1).write.mode("append").parquet(path)
        job.follow(spark.readStream.schema(part.schema).parquet(path))
    return job, parts[0]


@query("volume_stream")
def _(spark, folder):
    """With a delay longer than the feed no row is late: streamed counts are the batch's."""
    job, _ = _followed(spark, folder, "90 days")
    return job.daily_counts(spark)


@query("volume_stream_open_days")
def _(spark, folder):
    job, _ = _followed(spark, folder, "1 day")
    return job.daily_counts(spark)


@query("volume_stream_late")
def _(spark, folder):
    """The rows that came after their day was closed, with the batch that brought them."""
    job, rows = _followed(spark, folder, "1 day")
    return job.late_rows(spark, rows.schema).select("epoch", "row_id", "created_date")


@query("volume_stream_state")
def _(spark, folder):
    """Spark's own watermark and state: the last count that each day got before it was closed."""
    parts, path, out, progress = _landings(spark, folder), *(_stored(spark, n) for n in ("landing", "days", "state"))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out)

    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(part.schema).parquet(path)
        (open_day_counts(stream, delay="1 day").writeStream.outputMode("update").foreachBatch(keep)
         .option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).groupBy(DAY).agg(F.max_by(COUNT, "epoch").alias(COUNT))


@query("keys_across_snapshots")
def _(spark, folder):
    """Three snapshots of the dirty feed; the third one's keys that the first two hold."""
    rows, history = dirty(spark, folder), KeyHistory(spark, _stored(spark, "keys"), buckets=16)
    part = F.pmod(F.col("row_id"), F.lit(3))
    for k in (0, 1):
        history.remember(rows.where(part == k), f"day {k}", ["unique_key"])
    return history.repeats(rows.where(part == 2), ["unique_key"])


@query("copies_across_snapshots")
def _(spark, folder):
    """Whole rows of lines that an earlier snapshot has, counted by their number of copies."""
    lines = read_table(spark, folder, "lineitem")
    kinds = lines.select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber")
    history = KeyHistory(spark, _stored(spark, "rows"), buckets=16)
    odd = lines["l_orderkey"] % 2 == 1
    history.remember(lines.where(odd).select(*kinds.columns), "odd")
    found = history.repeats(lines.where(~odd).select(*kinds.columns))
    return found.groupBy("rows_now", "rows_before").agg(F.count(F.lit(1)).alias("keys"))


@query("asof_error_after_click")
def _(spark, folder):
    """Each error with the newest click of the same user before it, not older than six hours."""
    events = read_table(spark, folder, "events")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"))
    found = asof_join(errors, clicks, ["user_id"], "ts", "click_ts", ["click_id"], ["click_id"], strict=True, tolerance="6 hours")
    return found.select("event_id", "user_id", "click_id")


@query("asof_orders_events")
def _(spark, folder):
    """Each order, placed somewhere in the month of the events, with the newest event of its hour's kind.

    Times are cut to whole hours, so ties are common: the greatest event id wins.
    """
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    hours = (F.col("o_orderkey") * 7 % 720).cast("int")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 5).alias("part"),
        (start + F.make_dt_interval(F.lit(0), hours)).alias("placed"))
    events = read_table(spark, folder, "events").select(
        (F.col("user_id") % 5).alias("part"), F.date_trunc("hour", "ts").alias("hour"), "event_id", "value")
    found = asof_join(orders, events, ["part"], "placed", "hour", ["event_id", "value"], ["event_id"])
    return found.select("o_orderkey", "event_id", "value")


def _requests(spark, folder) -> DataFrame:
    rows = dirty(spark, folder)
    read = lambda c: to_utc_timestamp(F.col(c), rows.schema[c].dataType).alias(c)
    return rows.select("row_id", "agency", "borough", read("created_date"), read("closed_date"))


@query("requests_open_per_hour")
def _(spark, folder):
    """Open requests of every borough in every hour; a request without a closing date stays open."""
    found = concurrency(_requests(spark, folder), "created_date", "closed_date", ["borough"])
    return found.withColumn("span_start", F.date_format("span_start", "yyyy-MM-dd HH:mm:ss"))


@query("requests_open_per_day")
def _(spark, folder):
    """The same without groups, day by day."""
    found = concurrency(_requests(spark, folder), "created_date", "closed_date", width=86_400_000_000)
    return found.withColumn("span_start", F.date_format("span_start", "yyyy-MM-dd HH:mm:ss"))


@query("overlapping_requests")
def _(spark, folder):
    """How many other requests of its agency were open while a request was."""
    found = overlap_counts(_requests(spark, folder), "created_date", "closed_date", ["agency"])
    return found.select("row_id", "overlap_count")


