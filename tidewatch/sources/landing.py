"""Readers for landed snapshots: JSON records, CSV, and the latest stored snapshot."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tidewatch.catalog import RECENT_LIMIT
from tidewatch.contract import Contract, load_contract
from tidewatch.functions import strip_text, to_utc_timestamp

# --- fixed values: columns a snapshot asks for, in order -----------------------
REQUESTED_COLUMNS = (
    "unique_key", "created_date", "closed_date", "agency", "complaint_type", "descriptor",
    "status", "borough", "incident_zip", "latitude", "longitude",
)


class IngestionError(RuntimeError):
    """The landed data cannot be used."""


def project_requested(
    frame: DataFrame, requested: Sequence[str] = REQUESTED_COLUMNS
) -> DataFrame:
    """Keep the requested columns that exist, in requested order; values stay as they are."""
    return frame.select(*(c for c in requested if c in frame.columns))


def _checked(limit: int) -> int:
    """A number of rows to keep; anything else is a mistake of the caller."""
    if type(limit) is int and limit > 0:
        return limit
    raise ValueError(f"cannot keep {limit!r} rows")


def most_recent(
    frame: DataFrame, limit: int = RECENT_LIMIT, order: str = "created_date", key: str = "unique_key"
) -> DataFrame:
    """Newest rows first (a top-k plan: each task keeps its own ``limit`` best rows)."""
    return frame.orderBy(F.desc_nulls_last(order), key).limit(_checked(limit))


CORRUPT = "_corrupt_record"


def read_records(
    spark: SparkSession,
    path: str,
    limit: int | None = None,
    requested: Sequence[str] = REQUESTED_COLUMNS,
    present: Sequence[str] | None = None,
    layout: str | None = None,
) -> DataFrame:
    """JSON records landed as arrays or as one object per line; values are read as text.

    Each file is read as what its first character says, so a folder may hold both kinds.
    Raises ``IngestionError`` for unreadable files, for files that hold no records, and
    for empty payloads. Every record is kept; a ``limit`` keeps the newest ones, or, in a feed
    without creation dates, the first in order of its columns. Finding out which columns there
    are takes a pass over the files; ``present`` names them and saves that pass. Finding out what
    each file holds takes another, and one name for each file on the driver; ``layout``, ``array``
    or ``lines`` for all files, saves both.
    """
    if layout not in (None, "array", "lines"):
        raise ValueError(f"layout must be array or lines, not {layout!r}")
    if limit is not None:
        _checked(limit)
    def read(array: bool, paths: str | list[str], schema: StructType | str | None) -> DataFrame:
        # One object per line splits across tasks; a pretty-printed array does not.
        reader = spark.read.option("primitivesAsString", True).option("multiLine", array)
        if isinstance(paths, list) and not re.search(r"[*?\[{]", path):
            reader = reader.option("basePath", path)  # keeps the columns that folder names give
        if schema is not None:
            reader = reader.schema(schema)
        if present is not None:
            reader = reader.option("mode", "FAILFAST")
        return reader.option("columnNameOfCorruptRecord", CORRUPT).json(paths)

    schema = None if present is None else ", ".join(f"`{c}` string" for c in present)
    arrays, lines = _layouts(spark, path) if layout is None else ([], [])
    if not (arrays and lines):
        frame = read(bool(arrays) or layout == "array", path, schema)
        names = frame.columns
    else:
        parts = [(True, arrays), (False, lines)]
        if schema is None:
            found = [read(array, files, None).schema for array, files in parts]
            schema = _merged(*found)
        frame = read(*parts[0], schema).unionByName(read(*parts[1], schema))
        names = schema.names if isinstance(schema, StructType) else frame.columns
    if CORRUPT in names:
        raise IngestionError(f"Landed records are malformed: {path}")
    kept = project_requested(frame, requested)
    if frame.columns and not kept.columns:
        raise IngestionError(f"Landed JSON has an unexpected format: {path}")
    if not kept.columns or kept.isEmpty():
        raise IngestionError(f"Landed files hold no records: {path}")
    if limit is None:
        return kept
    if "created_date" in kept.columns:
        return most_recent(kept, limit, key=kept.columns[0])
    return kept.orderBy(*kept.columns).limit(limit)


def _layouts(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files that hold an array and those with one object per line; empty files are neither."""
    # a record ends at a brace, so an array on one line is not one value; all before the first brace is the first record
    text = spark.read.option("lineSep", "{").text(path)
    first = F.when(F.regexp_extract("value", r"^[\s\uFEFF]*([^\s\uFEFF])", 1) == "[", "[").otherwise("{")
    # a split is read in order, and splits of a file start at its blocks
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), first.alias("first"))
    files = text.select(F.col("_metadata.file_path").alias("file"), place.alias("place"))
    found = files.groupBy("file").agg((F.min("place")["first"] == "[").alias("array")).collect()
    if not found:
        raise IngestionError(f"Landed files hold no records: {path}")
    name = lambda r: re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(r["file"]))
    return [name(r) for r in found if r["array"]], [name(r) for r in found if not r["array"]]


def _merged(a: DataType, b: DataType) -> DataType:
    """A type that holds the values of both; text where they differ."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        other = {f.name: f.dataType for f in b}
        fields = [StructField(f.name, _merged(f.dataType, other.pop(f.name, f.dataType))) for f in a]
        return StructType(fields + [StructField(name, kind) for name, kind in other.items()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_merged(a.elementType, b.elementType))
    return a if a == b else StringType()


def read_csv(
    spark: SparkSession, path: str, na_tokens: Sequence[str] | None = None,
    contract: Contract | None = None,
) -> DataFrame:
    """CSV with a header. Every column is text, so identifiers keep leading zeros.

    Quoted values may hold line breaks, as the writer leaves them in. So one file is read by
    one task; land large feeds as many files.

    The columns are those of the file, so that missing and renamed ones stay visible.
    Values listed in ``na_tokens`` (default: those of the contract) become null.
    """
    frame = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("multiLine", True).option("escape", '"').csv(path)
    )
    if na_tokens is None:
        na_tokens = (contract or load_contract()).na_tokens
    if not na_tokens:
        return frame
    return frame.select(*(
        F.when(~strip_text(F.col(c)).isin(list(na_tokens)), F.col(c)).alias(c) for c in frame.columns
    ))


def stamp_row_ids(frame: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique row ids, given once at landing. Store the result: ids follow the file splits."""
    return frame.withColumn(name, F.monotonically_increasing_id())


def ingestion_metadata(
    frame: DataFrame, source: str = "", created: str = "created_date", **written: str | float
) -> DataFrame:
    """Row count, columns and newest creation date of a snapshot; one row, one aggregation.

    Dates are compared as points in time; unreadable ones are left out. ``written`` adds what
    the caller knows of the landing, such as the paths of the snapshot and the seconds it took.
    """
    latest = F.lit(None).cast("string")
    if created in frame.columns:
        newest = F.max(to_utc_timestamp(F.col(created), frame.schema[created].dataType))
        latest = F.date_format(newest, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return frame.agg(
        F.count(F.lit(1)).alias("rows_downloaded"),
        latest.alias("latest_created_date"),
    ).select(
        F.lit(source).alias("source_url"),
        "rows_downloaded",
        F.lit(len(frame.columns)).cast("long").alias("columns_downloaded"),
        F.lit(",".join(frame.columns)).alias("column_names"),
        "latest_created_date",
        *(F.lit(value).alias(name) for name, value in written.items()),
    )


def ingest(spark: SparkSession, store: str, records: str, limit: int | None = None) -> DataFrame:
    """Land records as a snapshot; returns its metadata with both paths and the load time."""
    from tidewatch.sources.sinks import save_snapshot

    started = time.perf_counter()
    latest, snapshot = save_snapshot(stamp_row_ids(read_records(spark, records, limit)), store)
    landed = spark.read.parquet(latest)
    return ingestion_metadata(
        landed.drop("row_id"), records, latest_path=latest, snapshot_path=snapshot,
        load_seconds=round(time.perf_counter() - started, 3))


def load_or_ingest(
    spark: SparkSession, store: str, records: str, limit: int | None = None
) -> DataFrame:
    """The latest stored snapshot if there is one, else the landed records, stored first."""
    from tidewatch.sources.sinks import latest_path, path_exists

    if not path_exists(spark, latest_path(store)):
        ingest(spark, store, records, limit)
    return spark.read.parquet(latest_path(store))
