"""SimHash near-duplicates by bit-sliced comparison.

1. Fingerprints: words, shingles and their XXH64 are made in Arrow batches, row by row.
2. Equal fingerprints are one node, so copies cost nothing from here on.
3. Candidates: the 64 bits are cut into ``radius + agree`` blocks. Two prints within the radius
   agree on at least ``agree`` whole blocks, so each print is dealt to one bucket for every
   choice of so many blocks, and every linked pair meets in some bucket. More prints mean a
   larger ``agree``, hence longer keys, so that buckets do not grow with the corpus. A bucket
   with more than ``CELL`` prints is dealt out as pairs of its parts, each compared in a task
   of its own.
4. Comparison: the prints of a run of buckets are stored as 64 vertical bit planes. A print
   is compared with 64 others at once: plane by plane the differences run through carry-save
   adders into a counter that overflows past the radius, and a word of 64 comparisons is
   dropped as soon as all of them have overflowed.
5. A bucket yields a spanning forest of its links, never all its pairs; components of the
   forests are found with ``connected_components``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, checkpoint, documents, each, streamed, text_bytes
from .components import SALTS, connected_components

#: Prints in one part of a bucket; larger buckets are split into parts of about this size.
CELL = 4096
#: Rows gathered before a run of whole buckets is compared.
RUN = 1 << 16
#: Words of 64 comparisons handled at once.
SLICE = 1 << 15
SEED = 42


def fingerprint(text: bytes, size: int) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - size + 1].tolist()
        grams = [joined[a:b] for a, b in zip(starts, ends[size - 1:].tolist())]
        hashes = list(map(xxhash.xxh64_intdigest, grams, repeat(SEED)))
    values = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), RUN):
        part = values[at: at + RUN].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, fp, t1, t2) for every row; fp as a signed long. Null text: no words.

    t1 and t2 are a hash of the text: with doc_id they tell rows of one doc_id apart.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in each(batch["text"])], np.uint64)
            yield pa.record_batch(
                [batch["doc_id"], pa.array(prints.view(np.int64)), batch["t1"], batch["t2"]], names=["doc_id", "fp", "t1", "t2"])

    rows = documents(docs).select("doc_id", "text", *text_hash(F.col("text")))
    return rows.mapInArrow(streamed(work), "doc_id long, fp long, t1 long, t2 long")


def text_hash(text: Column) -> list[Column]:
    """128 bits of a text as two longs, t1 and t2."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words; bit r of row b is bit b of print r."""
    rows = -(-len(prints) // 64) * 64
    bits = np.zeros((rows, 64), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _compare(planes, own, word, alive, radius):
    """Bits of ``alive`` that stay within the radius; words without any are dropped on the way.

    ``own`` are prints, ``word`` the word of 64 prints each is compared with.
    """
    index = np.arange(len(own))
    width = radius.bit_length()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    start = (1 << width) - radius - 1  # the counter overflows at radius + 1
    counter = [np.full(len(own), full if start >> j & 1 else 0, np.uint64) for j in range(width)]
    for bit in range(0, 64, 2):
        x, y = (planes[b][word] ^ np.negative(own >> np.uint64(b) & np.uint64(1)) for b in (bit, bit + 1))
        if not width:
            over = x | y
        else:
            half = x ^ y
            over = (x & y) | (counter[0] & half)
            counter[0] ^= half
            for j in range(1, width):
                over, counter[j] = counter[j] & over, counter[j] ^ over
        alive = alive & ~over
        if bit % 8 == 6:
            keep = alive != 0
            if keep.sum() < 0.75 * len(keep):
                index, own, word, alive = index[keep], own[keep], word[keep], alive[keep]
                counter = [c[keep] for c in counter]
                if not len(alive):
                    break
    return index, alive


def near_pairs(prints: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int) -> Iterator[tuple]:
    """Pairs (i, j) within the radius, row i against the rows low[i] <= j < high[i]."""
    planes = bit_planes(prints)
    rows = np.flatnonzero(high > low)
    first, last = low[rows] >> 6, (high[rows] - 1) >> 6
    ends = np.cumsum(last - first + 1)
    for at in range(0, int(ends[-1]) if len(ends) else 0, SLICE):
        item = np.arange(at, min(at + SLICE, int(ends[-1])))
        k = np.searchsorted(ends, item, "right")
        row, word = rows[k], last[k] - (ends[k] - 1 - item)
        alive = np.full(len(item), 0xFFFFFFFFFFFFFFFF, np.uint64)
        below, above = np.maximum(low[row] - 64 * word, 0), np.minimum(high[row] - 64 * word, 64)
        alive <<= below.astype(np.uint64)
        alive &= alive[:0].dtype.type(0xFFFFFFFFFFFFFFFF) >> (64 - above).astype(np.uint64)
        index, alive = _compare(planes, prints[row], word, alive, radius)
        hit, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        yield row[index[hit]], 64 * word[index[hit]] + bit


def join_roots(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining rows i and j; a label is the smallest row of its component."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up


def _links(radius: int):
    """Rows (group..., side, fp) sorted by group and side; yields a forest for each group."""
    def run(columns: list[np.ndarray]) -> pa.RecordBatch:
        *group, side, prints = columns
        n = len(prints)
        new = np.zeros(n, bool)
        new[0] = True
        for c in group:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        end = np.append(starts[1:], n)[number]
        split = end - np.add.reduceat(side, starts)[number]  # where the other part begins
        crossed = split < end
        low = np.where(crossed, split, np.arange(n) + 1)
        high = np.where(crossed & (side == 1), 0, end)
        label = np.arange(n)
        for i, j in near_pairs(prints.view(np.uint64), low, high, radius):
            label = join_roots(label, i, j)
        hung = np.flatnonzero(label != np.arange(n))
        return pa.record_batch([pa.array(prints[hung]), pa.array(prints[label[hung]])], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = [np.concatenate(x) for x in zip(kept, columns)] if kept else columns
            if len(kept[0]) < RUN:
                continue
            last = np.ones(len(kept[0]), bool)  # the last group may go on in the next batch
            for c in kept[:-2]:
                last &= c == c[-1]
            if not last.all():
                cut = len(last) - int(last.sum())
                yield run([c[:cut] for c in kept])
                kept = [c[cut:] for c in kept]
        if kept:
            yield run(kept)

    return work


def blocks_to_agree(radius: int, prints: int) -> int:
    """How many blocks a bucket's key has: the cheapest choice for so many prints.

    A print costs its buckets, each worth about 64 comparisons, and the comparisons in them.
    """
    def cost(agree: int) -> float:
        return comb(radius + agree, agree) * (64 + prints / 2.0 ** (64 * agree // (radius + agree)))

    return min(range(2, 9), key=cost)


def _masks(radius: int, agree: int) -> list[int]:
    """The bits of every choice of ``agree`` among ``radius + agree`` blocks, as signed longs."""
    count = radius + agree
    edges = [64 * k // count for k in range(count + 1)]
    blocks = [sum(1 << b for b in range(x, y)) for x, y in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in map(sum, combinations(blocks, agree))]


def links(prints: DataFrame, radius: int, agree: int | None = None) -> DataFrame:
    """(a, b): forests that connect exactly the distinct prints linked within ``radius`` bits."""
    if not 0 <= radius < 31:
        raise ValueError("radius must be 0 to 30")
    masks = _masks(radius, agree or blocks_to_agree(radius, prints.count()))
    bands = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("band", "key")
    dealt = prints.select("fp", bands)
    full = dealt.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL)
    parts = F.coalesce(F.ceil(F.col("n") / CELL), F.lit(1)).cast("int")
    cells = dealt.join(full, ["band", "key"], "left").select(
        "fp", "band", "key", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("own"))
    cells = cells.select("fp", "band", "key", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    x, y = F.least("own", "other"), F.greatest("own", "other")
    cells = cells.select(
        "band", "key", x.alias("x"), y.alias("y"), ((x < y) & (F.col("own") == y)).cast("long").alias("side"), "fp")
    return (cells.repartition("band", "key", "x", "y").sortWithinPartitions("band", "key", "x", "y", "side", "fp")
            .mapInArrow(streamed(_links(radius)), "a long, b long"))


def _named(prints: DataFrame, radius: int, name: str, named: str) -> DataFrame:
    """``prints`` (fp, ...) with ``named``, the smallest ``name`` of each print's component.

    Prints without links name themselves; only the others are joined, a component's prints
    dealt over SALTS tasks.
    """
    members = connected_components(links(prints.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = prints.join(members, "fp", "left")
    alone = rooted.filter("component is null").select("*", F.col(name).alias(named)).drop("component")
    linked = rooted.filter("component is not null").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    names = linked.groupBy("component").agg(F.min(name).alias(named)).select("component", named, every)
    return linked.join(names, ["component", "salt"]).drop("component", "salt").unionByName(alone)


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    Documents are linked if their fingerprints differ in at most ``radius`` bits; a component
    is named by its smallest doc_id. Null and empty texts have no words and fingerprint zero,
    linked like any other; texts of fewer than ``size`` words have one shingle. Repeated rows
    come back as often as they went in. A null doc_id keeps its row and is never the smallest;
    a component without any other id has a null name. No rows: no rows. Extra columns are
    ignored.
    """
    rows = checkpoint(fingerprints(docs, size).select("doc_id", "fp"))
    prints = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    by_print = _named(prints, radius, "least_id", "component_id").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component, with all its columns.

    A row stands for itself, whatever other rows share its doc_id. Of a component the row with
    the smallest doc_id stays, of equal ones that with the smaller text hash; rows without
    doc_id come last. Of rows with the same doc_id and text any one stays. Null and empty texts are copies of
    each other. No rows: no rows.
    """
    rows = checkpoint(fingerprints(docs, size))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    prints = checkpoint(rows.groupBy("fp").agg(F.min(first).alias("least"), F.count(F.lit(1)).alias("n")))
    named = _named(prints, radius, "least", "kept")
    named = named.filter((F.col("n") > 1) | (F.col("least") != F.col("kept"))).select("fp", "kept")
    stays = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("t1") == F.col("kept.t1")) & (F.col("t2") == F.col("kept.t2"))
    found = rows.join(named, "fp").groupBy("doc_id", "t1", "t2").agg(
        F.max(stays).alias("stays"), F.count(F.lit(1)).alias("copies"))
    # what is not named here is a component's only row
    found = checkpoint(found.filter(~F.col("stays") | (F.col("copies") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "stays"))
    text = text_bytes()
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), *text_hash(text))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    kept = whole.join(found, same, "left_anti")
    repeated = found.filter("stays")
    if not repeated.isEmpty():
        kept = kept.unionByName(whole.join(repeated, same).select("row", "doc_id", "t1", "t2").dropDuplicates(["doc_id", "t1", "t2"]))
    return kept.select("row.*")
