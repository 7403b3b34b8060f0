"""Keys that repeat across snapshots, found without reading earlier snapshots.

The keys of every snapshot are kept in a table of their own, bucketed by key: one row for each
key and snapshot, with the number of its rows. A new snapshot is reduced to its distinct keys
(which combines on the map side, so a hot key is one row for each task), dealt to the same
buckets and joined there; the history itself is never shuffled, however long it is.

The folder is the state. A table over it is declared in the session's catalog, so a later session
goes on where the last one ended. A snapshot's keys become visible all at once, when its write
commits; remembering the same snapshot again is refused, so a repeated run counts nothing twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import exact_text, is_blank
from tidewatch.operators.profile import row_digest

BUCKETS = 256


@dataclass(frozen=True)
class KeyHistory:
    """The keys of earlier snapshots, in ``folder``. ``buckets`` is fixed by the first use."""

    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    @property
    def table(self) -> str:
        return "key_history_" + hashlib.md5(f"{self.folder}|{self.buckets}".encode()).hexdigest()

    def _declare(self) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (key STRING, snapshot STRING, number BIGINT, n BIGINT) "
            f"USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'")
        self.spark.catalog.refreshTable(self.table)

    def entries(self) -> DataFrame:
        """(key, snapshot, number, n): snapshots are numbered in the order they were remembered."""
        self._declare()
        return self.spark.table(self.table)

    def snapshots(self) -> DataFrame:
        """(snapshot, number, keys, rows) of what is remembered."""
        return self.entries().groupBy("snapshot", "number").agg(
            F.count(F.lit(1)).alias("keys"), F.sum("n").alias("rows"))

    def counted(self, snapshot: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """(key, rows_now) of a snapshot. Rows with a null or blank key column have no key.

        A key of one column is its exact text, one of several columns a JSON list of theirs;
        without ``keys`` the whole row is the key, as a digest.
        """
        types = {f.name: f.dataType for f in snapshot.schema.fields}
        if keys is None:
            content = [(name, types[name]) for name in snapshot.columns]
            named, usable = F.hex(row_digest(content)), F.lit(True)
        else:
            texts = [exact_text(F.col(k), types[k]) for k in keys]
            named = texts[0] if len(keys) == 1 else F.to_json(F.array(*texts))
            usable = reduce(lambda a, b: a & b, (~is_blank(F.col(k), types[k]) for k in keys))
        found = snapshot.where(usable).select(named.alias("key"))
        return found.groupBy("key").agg(F.count(F.lit(1)).alias("rows_now"))

    def repeats(self, snapshot: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """Keys of ``snapshot`` that earlier snapshots hold.

        (key, rows_now, first_snapshot, snapshots_before, rows_before). ``snapshot`` itself should
        not be remembered yet.
        """
        before = self.entries().groupBy("key").agg(
            F.min_by("snapshot", "number").alias("first_snapshot"),
            F.count(F.lit(1)).alias("snapshots_before"), F.sum("n").alias("rows_before"))
        now = self.counted(snapshot, keys).repartition(self.buckets, "key")
        return now.join(before.hint("merge"), "key").select(
            "key", "rows_now", "first_snapshot", "snapshots_before", "rows_before")

    def remember(self, snapshot: DataFrame, name: str, keys: Sequence[str] | None = None) -> int:
        """Add a snapshot's keys under ``name``; returns its number."""
        known = self.entries().agg(
            F.coalesce(F.max("number") + 1, F.lit(0)).alias("next"), F.max(F.col("snapshot") == F.lit(name)).alias("there")).first()
        if known["there"]:
            raise ValueError(f"snapshot {name} is remembered already")
        rows = self.counted(snapshot, keys).repartition(self.buckets, "key").select(
            "key", F.lit(name).alias("snapshot"), F.lit(known["next"]).cast("long").alias("number"), F.col("rows_now").alias("n"))
        rows.write.insertInto(self.table)
        return known["next"]

    def check(self, snapshot: DataFrame, name: str, path: str, keys: Sequence[str] | None = None) -> DataFrame:
        """Write the repeats of a snapshot to ``path``, remember it, and return what was written."""
        self.repeats(snapshot, keys).write.mode("overwrite").parquet(path)
        self.remember(snapshot, name, keys)
        return self.spark.read.parquet(path)


def repeats_summary(repeats: DataFrame) -> DataFrame:
    """One row: repeated keys, their rows in the new snapshot, and the most snapshots a key was in."""
    total: list[Column] = [
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum("rows_now"), F.lit(0)).alias("rows_now"),
        F.coalesce(F.max("snapshots_before"), F.lit(0)).alias("most_snapshots"),
    ]
    return repeats.agg(*total)
