"""I-Match document fingerprints in DataFrame functions only.

The lexicon holds the terms whose document frequency, counted over all documents, lies in a
band of shares. A text's lexicon terms, distinct and sorted, are hashed once for each of 88
randomised sub-lexicons: 8 disjoint ones with a 16th of the lexicon each, 16 with a 64th, 32
with a 256th and 32 with a 1024th, so that short and long texts both have subsets that hold
some of their terms and survive an edit.

A band that begins at a share of all documents bounds the lexicon at any corpus size: it has
at most (mean distinct terms of a document) / ``LEAST`` terms, here about 200,000. It travels
to the tasks as a bit set of ``SLOTS`` bits (128 KB); a term belongs to the lexicon if the
slot of its hash is set.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpoint, following

#: Shares of all documents between which a term's document frequency must lie.
LEAST, MOST = 1 / 500, 1 / 20
#: Bits of a term hash that choose its slot.
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
#: (share of the lexicon in a sub-lexicon is one in, sub-lexicons, first bit of the hash that deals)
SCALES = [(16, 8, 20), (64, 16, 24), (256, 32, 30), (1024, 32, 38)]
SUBSETS = sum(count for _, count, _ in SCALES)
#: 2 ** 9 neighbouring doc_ids are brought together to see each other's texts.
STRETCH_BITS = 9


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct lower-cased words of a text."""
    words = F.split(F.lower(text), r"[\x20\x09-\x0D]+")
    return F.array_distinct(F.array_remove(F.transform(words, lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def lexicon(texts: DataFrame, total: int, least: float = LEAST, most: float = MOST) -> Column:
    """The band's slots as a literal of SLOTS / 64 longs; the driver sees no more than those."""
    counts = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").count()
    kept = counts.filter(F.col("count").between(least * total, most * total))
    slot = F.col("term").bitwiseAND(F.lit(SLOTS - 1))
    rows = kept.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(_bit(F.col("term"))).alias("bits")).collect()
    bits = [0] * (SLOTS // 64)
    for row in rows:
        bits[row["word"]] = row["bits"]
    return F.from_json(F.lit(json.dumps(bits)), "array<bigint>")  # folded to one literal


def fingerprint(text: Column, bits: Column) -> tuple[Column, callable]:
    """The sorted terms that count for a text, and what makes subset hashes of them.

    A text without lexicon terms is stood for by all its terms, one without words by its own
    hash, so every text has something to compare.
    """
    terms = term_hashes(text)
    known = F.filter(terms, lambda h: F.get(
        bits, F.shiftright(h.bitwiseAND(F.lit(SLOTS - 1)), 6).cast("int")).bitwiseAND(_bit(h)) != 0)
    chosen = F.when(F.size(known) > 0, known).when(F.size(terms) > 0, terms).otherwise(F.array(F.xxhash64(text)))
    return F.sort_array(chosen), _subset_hashes


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))


def _dealt(terms: Column, size: int, count: int, first: int) -> Column:
    """A hash for each of ``count`` sub-lexicons that hold one in ``size`` terms."""
    mask = F.lit((size - 1) << first).cast("long")
    near = F.filter(terms, lambda h: h.bitwiseAND(mask) < F.lit(count << first).cast("long"))
    wanted = F.array(*[F.lit(k << first).cast("long") for k in range(count)])
    return F.transform(wanted, lambda k: F.xxhash64(F.filter(near, lambda h: h.bitwiseAND(mask) == k)))


def _subset_hashes(terms: Column) -> Column:
    """SUBSETS ints; 0 for a subset without terms of the text."""
    hashes = F.concat(*[_dealt(terms, *scale) for scale in SCALES])
    # the hash of an empty array is its seed, 42
    return F.transform(hashes, lambda x: F.when(x == 42, F.lit(0)).otherwise(
        x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))


def add_prints(frame: DataFrame, bits: Column, text: str, name: str) -> DataFrame:
    terms, hashes = fingerprint(F.col(text), bits)
    return frame.withColumn("_terms", terms).withColumn(name, hashes(F.col("_terms"))).drop("_terms")


def print_text(prints: str) -> Column:
    return F.array_join(F.transform(prints, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Share of the subsets that are equal among those with terms of either text."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != 0)), lambda z: z))
    some = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != 0) | (y != 0)), lambda z: z))
    return F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.coalesce(equal / some, F.lit(0.0)))


def fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row; null text: empty."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bits = lexicon(texts, texts.count(), least, most)
    return add_prints(texts, bits, "text", "_prints").select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), print_text("_prints").alias("fingerprint"))


def edited_fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Fingerprints of whole texts and of edited ones, for every row of ``docs`` (doc_id, text).

    The edited text has its last quarter replaced by the beginning of the next document's
    text, in ascending doc_id (rows of one doc_id by text), after the last the first. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null text: empty. A row without doc_id has no place in the order: its last quarter is cut
    and near_next is 0. No rows: no rows. Extra columns are ignored.

    Texts are shuffled once, to stretches of 512 neighbouring doc_ids; only the first text of
    every stretch is looked up from outside. doc_ids are expected to be fairly dense.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    facts = texts.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low")).first()
    bits = lexicon(texts, facts["n"], least, most)
    stretch = F.shiftright("doc_id", STRETCH_BITS)
    placed = texts.filter("doc_id is not null").withColumn("stretch", stretch)

    firsts = placed.groupBy("stretch").agg(F.min(F.struct("doc_id", "text")).alias("f"))
    firsts = checkpoint(firsts.select("stretch", "f.text"))
    order = following(firsts.select(F.col("stretch").alias("key")))
    lowest = F.lit((facts["low"] or 0) >> STRETCH_BITS).cast("long")
    order = order.select(F.col("key").alias("stretch"), F.coalesce("next_key", lowest).alias("after"))
    after = order.join(firsts.select(F.col("stretch").alias("after"), F.col("text").alias("after_text")), "after")
    after = add_prints(after, bits, "after_text", "after_prints").drop("after")

    beside = W.partitionBy("stretch").orderBy("doc_id", "text")
    rows = add_prints(placed, bits, "text", "prints").select(
        "stretch", "doc_id", "text", "prints",
        F.lead("text").over(beside).alias("lead_text"), F.lead("prints").over(beside).alias("lead_prints"))
    rows = rows.join(after, "stretch", "left").select(
        "doc_id", "text", "prints", F.coalesce("lead_text", "after_text").alias("next_text"),
        F.coalesce("lead_prints", "after_prints").alias("next_prints"))
    rest = add_prints(texts.filter("doc_id is null"), bits, "text", "prints").select(
        "doc_id", "text", "prints", F.lit("").alias("next_text"),
        F.array_repeat(F.lit(0), SUBSETS).alias("next_prints"))

    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.unionByName(rest).select("doc_id", n.cast("long").alias("n_chars"), "prints", "next_prints", edited.alias("edited"))
    rows = add_prints(rows, bits, "edited", "edited_prints")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        print_text("prints").alias("fingerprint"), print_text("edited_prints").alias("edited_fingerprint"),
        likeness("prints", "edited_prints").alias("near_edited"), likeness("prints", "next_prints").alias("near_next"))
