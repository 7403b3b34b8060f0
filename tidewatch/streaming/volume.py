"""Daily volume of a feed that arrives in pieces, with late rows told apart.

A day is closed once the newest creation date seen in earlier batches lies ``delay`` behind its
end. Rows of open days are counted; rows of closed days come too late to change a count that
others may have acted on, and are listed instead.

``open_day_counts`` is that rule as Spark's own watermark and state: it drops late rows without a
word. ``VolumeStream`` keeps them. It writes two tables, batch by batch: counts for each day, late
or not, with the newest date, and the late rows themselves. A batch is one partition of each,
written over if the batch is run again; its counts are written last and make it valid. The mark a
batch is judged by comes from the counts of earlier batches, one row for each batch and day, so
the state outlives runs, drivers and executors, and every row is in exactly one of the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import calendar_day, to_utc_timestamp
from tidewatch.operators.volume import COUNT, DAY

COUNTS = f"epoch long, {DAY} string, is_late boolean, n long, newest timestamp"


def open_day_counts(stream: DataFrame, date_column: str = "created_date", delay: str = "2 days") -> DataFrame:
    """(calendar_date, request_count) as a streaming aggregation under a watermark.

    In update mode every batch gives the new counts of the days it touched, in append mode each
    day comes once, when it is closed. State is one number for each open day. Unreadable
    dates are left out, as in ``daily_counts``.
    """
    at = to_utc_timestamp(F.col(date_column), stream.schema[date_column].dataType)
    days = stream.select(at.alias("at")).where("at is not null").withWatermark("at", delay).groupBy(
        F.window("at", "1 day").alias("w")).agg(F.count(F.lit(1)).alias(COUNT))
    return days.select(calendar_day(F.col("w.start")).alias(DAY), COUNT)


@dataclass(frozen=True)
class VolumeStream:
    """Counts and late rows of a stream, under ``folder``."""

    folder: str
    date_column: str = "created_date"
    delay: str = "2 days"

    def follow(self, stream: DataFrame, **trigger) -> None:
        """Take what has arrived, then stop; ``trigger`` sets another trigger, such as processingTime.

        A folder is followed by one query at a time. A run that was cut off goes on with the
        batch it was in.
        """
        query = (
            stream.writeStream.foreachBatch(self._take)
            .option("checkpointLocation", f"{self.folder}/_progress")
            .trigger(**(trigger or {"availableNow": True})).start())
        if not trigger:
            query.awaitTermination()

    def _take(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        at = to_utc_timestamp(F.col(self.date_column), batch.schema[self.date_column].dataType)
        day_end = F.date_trunc("day", at) + F.expr("interval 1 day")
        mark = self._entries(spark).where(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
        is_late = F.lit(False) if mark is None else _closed(day_end, mark, self.delay)
        dated = batch.where(at.isNotNull())
        if mark is not None:
            late = dated.where(is_late)
            late.write.mode("overwrite").parquet(f"{self.folder}/late/epoch={epoch}")
        counted = dated.groupBy(calendar_day(at).alias(DAY), is_late.alias("is_late")).agg(
            F.count(F.lit(1)).alias("n"), F.max(at).alias("newest"))
        # one row for each day: a single small file a batch
        counted.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/counts/epoch={epoch}")

    def _entries(self, spark: SparkSession) -> DataFrame:
        return _read(spark, f"{self.folder}/counts", T.StructType.fromDDL(COUNTS))

    def daily_counts(self, spark: SparkSession, with_late: bool = False) -> DataFrame:
        """(calendar_date, request_count) of all batches so far; with ``with_late`` of late rows, too."""
        rows = self._entries(spark)
        rows = rows if with_late else rows.where("not is_late")
        return rows.groupBy(DAY).agg(F.sum("n").alias(COUNT))

    def late_counts(self, spark: SparkSession) -> DataFrame:
        """(epoch, calendar_date, late_rows): what each batch brought for closed days."""
        return self._entries(spark).where("is_late").select("epoch", DAY, F.col("n").alias("late_rows"))

    def late_rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The late rows of all batches with the ``epoch`` that brought them; ``schema`` is the stream's."""
        valid = self._entries(spark).select("epoch").distinct()
        rows = _read(spark, f"{self.folder}/late", T.StructType([*schema.fields, T.StructField("epoch", T.LongType())]))
        return rows.join(F.broadcast(valid), "epoch", "left_semi")  # one row for each batch


def _closed(day_end: Column, mark, delay: str) -> Column:
    return day_end <= F.lit(mark) - F.expr(f"interval {delay}")


def _read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A partitioned table, or no rows where nothing has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    reader = spark.read.schema(schema)
    return reader.parquet(folder) if there else spark.createDataFrame([], schema)
