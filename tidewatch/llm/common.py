"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.ranking import with_positions
from tidewatch.session import cut_lineage as checkpoint
from tidewatch.session import stored

__all__ = ["checkpoint", "documents", "each", "following", "held", "let_go", "read", "stored", "streamed", "text_bytes", "with_carried"]

#: bytes.translate table that lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Upper- and lower-case letters for translate() in SQL.
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_HELD: dict[object, object] = {}


def held(key: object, make: Callable[[], object]) -> object:
    """What an operator keeps in a Python worker between tasks, such as remembered words.

    Workers outlive stages. Only the last operator's value is kept, so the stages of a
    pipeline do not pile up theirs.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def let_go(key: object = None) -> None:
    """Forgets what other operators held in this worker (all but ``key``)."""
    if key not in _HELD:
        _HELD.clear()


def streamed(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], key: object = None):
    """A function for ``mapInArrow`` that is tidy with its worker's memory.

    It lets go of what other operators held there (all but ``key``), and gives Arrow's memory
    back when its task ends.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(key)
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def each(column: pa.Array) -> Iterator:
    """A column's values one at a time; a list of all would double a batch of long texts."""
    return (value.as_py() for value in column)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """A text as UTF-8 bytes; null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def documents(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The two columns the operators read; extra columns cannot clash with theirs.

    Columns named in ``carry`` come along in one struct, ``carried``.
    """
    carried = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried")] if carry else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), *carried)


def with_carried(schema: str, rows: DataFrame) -> str:
    """``schema`` with the carried struct of ``rows``, if there is one."""
    if "carried" not in rows.columns:
        return schema
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema["carried"].dataType.fields)
    return f"{schema}, carried struct<{fields}>"


def following(keys: DataFrame) -> DataFrame:
    """For each distinct whole number ``key`` the next larger one, ``next_key`` (null for the last).

    The numbers are dealt to ranges and numbered; a number's successor is the one with the next
    position, however far apart or close together they are.
    """
    placed = with_positions(keys.select("key"), ["key"], "at")
    after = placed.select((F.col("at") - 1).alias("at"), F.col("key").alias("next_key"))
    return placed.join(after, "at", "left").select("key", "next_key")
