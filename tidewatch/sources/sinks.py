"""Writers for snapshots, scenario tables, the manifest and reports."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.catalog import MANIFEST_VERSION
from tidewatch.operators.tables import SCENARIO


def utc_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a stored table? Asked through Spark, so any file system will do."""
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False


def latest_path(store: str) -> str:
    return f"{store}/latest"


def save_snapshot(frame: DataFrame, store: str, stamp: str | None = None) -> tuple[str, str]:
    """A timestamped copy under ``snapshot_ts=`` and the stable ``latest`` one.

    The source is evaluated once; ``latest`` is copied from the stored snapshot.
    """
    snapshot = f"{store}/snapshots/snapshot_ts={stamp or utc_stamp()}"
    frame.write.mode("overwrite").parquet(snapshot)
    spark = frame.sparkSession
    spark.read.parquet(snapshot).write.mode("overwrite").parquet(latest_path(store))
    return latest_path(store), snapshot


def save_scenario(frame: DataFrame, folder: str, name: str) -> str:
    """One corrupted table. Each scenario has its own folder, hence its own column set."""
    path = f"{folder}/{name}"
    frame.write.mode("overwrite").parquet(path)
    return path


def save_scenario_csv(frame: DataFrame, folder: str, name: str) -> str:
    path = f"{folder}/{name}"
    frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def save_manifest(manifest: DataFrame, folder: str, source: str) -> str:
    """The manifest as one JSON document."""
    path = f"{folder}/fault_manifest"
    document = manifest.agg(
        F.count(F.lit(1)).alias("scenario_count"),
        F.sort_array(F.collect_list(F.struct(*manifest.columns))).alias("scenarios"),
    ).select(
        F.lit(MANIFEST_VERSION).alias("manifest_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at_utc"),
        F.lit(source).alias("source_data_path"),
        "scenario_count",
        "scenarios",
    )
    _write_json(document, path)
    return path


def load_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Scenario rows of a stored manifest."""
    return spark.read.json(f"{folder}/fault_manifest").select(F.explode("scenarios").alias("s")).select("s.*")


def json_safe(frame: DataFrame) -> DataFrame:
    """Doubles that JSON cannot hold (NaN and the infinities) become null, at any depth."""
    return frame.select(*(
        _finite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in frame.schema.fields
    ))


def _finite(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~(F.isnan(column) | (F.abs(column) == F.lit(float("inf")))), column)
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda x: _finite(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda _, v: _finite(v, dtype.valueType))
    if isinstance(dtype, T.StructType):
        parts = [_finite(column.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    return column


def _write_json(frame: DataFrame, path: str) -> None:
    """One document; the frame holds a single row."""
    json_safe(frame).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_report(report: DataFrame, folder: str, latest: str, prefix: str, stamp: str | None = None
                ) -> tuple[str, str]:
    """The same JSON document under a stable and a timestamped name."""
    snapshot = f"{folder}/{prefix}_{stamp or utc_stamp()}"
    _write_json(report, snapshot)
    spark = report.sparkSession
    stable = f"{folder}/{latest}"
    spark.read.text(snapshot).coalesce(1).write.mode("overwrite").text(stable)
    return stable, snapshot


def save_quarantine(rejected: DataFrame, folder: str) -> str:
    path = f"{folder}/rejected_rows"
    rejected.write.mode("overwrite").parquet(path)
    return path


def save_by_scenario(frame: DataFrame, folder: str) -> str:
    """Scenarios that share their columns, as one table partitioned by scenario."""
    frame.write.mode("overwrite").partitionBy(SCENARIO).parquet(folder)
    return folder
