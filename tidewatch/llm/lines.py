"""Line dedup in DataFrame functions only: lines found in many documents go everywhere.

1. Every document's distinct keys (lines stripped and lower-cased) are exploded, hashed to
   128 bits and counted; a document counts once for a key, so a count is a number of
   documents. Counting combines on the map side: a line that every document holds is one
   record for each task.
2. Lines are exploded again with their positions, as hashes without text, and joined with the
   frequent keys. A key with at least a thousandth of all counts is dealt over ``SALTS``
   places; there are at most a thousand such keys, so they can be broadcast.
3. The positions to drop meet their document by doc_id and a hash of the text. Texts are
   shuffled once, here; the other lines are joined again in order of position.

A document is a row. What goes depends on nothing but the text, so rows need no other identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, UPPER_AZ, checkpoint

#: Keys of at least this many code points, in at least this many documents.
LEAST, DOCUMENTS = 1, 10
#: A key (or a repeated row) with this share of all counts is dealt over SALTS places.
HEAVY, SALTS = 1000, 64
WHITE = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    ascii_only = F.octet_length(line) == F.length(line)  # lower() changes other letters too
    lowered = F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER_AZ, LOWER_AZ))
    return F.btrim(lowered, F.lit(WHITE))


def _hash128(value: Column, names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(7), value).alias(names[1])]


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def frequent_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(k1, k2, n): hashes of the keys found in at least ``documents`` documents, and in how many."""
    keys = F.array_distinct(F.transform(_lines(), line_key))
    found = _texts(docs).select(F.explode(keys).alias("key")).filter(F.length("key") >= least)
    counted = found.select(*_hash128(F.col("key"), ("k1", "k2"))).groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= documents)


def _salted(rows: DataFrame, heavy: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """Rows with a ``salt``: one of SALTS for keys in ``heavy`` (at most HEAVY rows), else 0."""
    marked = heavy.select(*(F.col(k).alias(f"_{k}") for k in keys), F.lit(True).alias("_heavy"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    salt = F.when(F.col("_heavy"), F.pmod(by, F.lit(SALTS))).otherwise(0).cast("int")
    return rows.join(F.broadcast(marked), same, "left").select(*rows.columns, salt.alias("salt"))


def _every_salt(rows: DataFrame, is_heavy: Column) -> DataFrame:
    last = F.when(is_heavy, SALTS - 1).otherwise(0)
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), last)))


def _dropped(texts: DataFrame, frequent: DataFrame, least: int) -> DataFrame:
    """(doc_id, t1, t2, gone, copies): positions of the lines to drop, and rows that share them."""
    total = frequent.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * HEAVY >= total
    placed = texts.select("doc_id", "t1", "t2", F.posexplode(_lines()).alias("pos", "line"))
    placed = placed.select("doc_id", "t1", "t2", "pos", line_key(F.col("line")).alias("key"))
    placed = placed.filter(F.length("key") >= least).select(
        "doc_id", "t1", "t2", "pos", *_hash128(F.col("key"), ("k1", "k2")))
    placed = _salted(placed, frequent.filter(is_heavy), ["k1", "k2"], F.xxhash64("doc_id", "t1", "pos"))
    frequent = _every_salt(frequent, is_heavy).select("k1", "k2", "salt")
    lost = placed.join(frequent, ["k1", "k2", "salt"], "left_semi")
    return lost.groupBy("doc_id", "t1", "t2", "pos").agg(F.count(F.lit(1)).alias("copies")).groupBy(
        "doc_id", "t1", "t2").agg(F.collect_list("pos").alias("gone"), F.max("copies").alias("copies"))


def dedup(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row of ``docs`` (doc_id, text).

    Lines end at \\n and nowhere else. A line's key is the line without ASCII white space at
    its ends, A-Z lower-cased; keys of at least ``least`` code points in at least
    ``documents`` rows lose all their lines. ``text`` holds the other lines as they were, joined by \\n; it
    is empty if none is left. Null and empty texts are one empty line, which stays unless
    ``least`` is 0. A line that a row repeats counts once for that row; rows that repeat a
    doc_id, or have none, are documents of their own and all come back. No rows: no rows.
    Extra columns are ignored.
    """
    texts = _texts(docs).select("*", *_hash128(F.col("text"), ("t1", "t2")))
    frequent = checkpoint(frequent_lines(docs, least, documents))
    dropped = checkpoint(_dropped(texts, frequent, least))
    total = texts.agg(F.count(F.lit(1))).first()[0]
    is_heavy = (F.col("copies") > 1) & (F.col("copies") * HEAVY >= total)

    own = ["doc_id", "t1", "t2"]
    at_random = F.monotonically_increasing_id()  # copies may lie anywhere: all salts know their positions
    rows = _salted(texts, dropped.filter(is_heavy), own, at_random)
    # a blank text loses nothing: such rows need no partner, and are dealt freely
    blank = (F.btrim("text", F.lit(WHITE)) == "") if least > 0 else F.lit(False)
    rows = rows.withColumn("salt", F.when(blank, SALTS + F.pmod(at_random, F.lit(1 << 20))).otherwise(F.col("salt")).cast("int"))
    found = _every_salt(dropped, is_heavy).select(*(F.col(k).alias(f"_{k}") for k in own), F.col("salt").alias("_salt"), "gone")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in own] + [F.col("salt") == F.col("_salt")]
    rows = rows.join(found, same, "left").select("doc_id", "text", "gone")

    # a row of its own for the lines, or the split would be done again for each position
    rows = rows.select("doc_id", "text", "gone", F.explode(F.array(F.when(F.col("gone").isNotNull(), _lines()))).alias("lines"))
    n = F.when(F.col("gone").isNotNull(), F.size("lines")).otherwise(
        F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.array_join(F.transform(kept, lambda p: F.get("lines", p)), "\n")
    return rows.select(
        "doc_id", n.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNotNull(), left).otherwise(F.col("text")).alias("text"))
