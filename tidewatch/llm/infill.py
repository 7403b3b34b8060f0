"""Fill-in-middle transformation as a pipeline of pyarrow.compute kernels.

A unit is a word with the white space before it; white space at the end of a text is a unit of
its own. For each batch of texts, column by column:

    split      white space and words into two list arrays, of n + 1 entries each
    flatten    both with their parent indices, join gap and word to units, drop the empty ones
    ordinals   a unit's number in its text, and from it its role: prefix, middle or suffix
    filter     the units of one role, rebuild them to lists by the sizes the cuts give
    join       each list to a string, and the strings with the marks to the output

No value becomes a Python object. Where a text is cut follows from SHA-256 of seed and doc_id,
which Spark computes beside the texts, so a lost task makes the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import streamed

SEED = 42
#: Marks before prefix, suffix and middle. None is the end and the beginning of another.
MARKS = ("<P>", "<S>", "<M>")
#: Per cent of texts that are transformed, and of those the ones that begin with the suffix.
RATE, SUFFIX_FIRST = 50, 80
#: Bytes of text worked on at a time; a longer text is worked on alone.
STRETCH = 4 << 20
GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _rebuilt(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    return pa.ListArray.from_arrays(offsets, values)


def units(texts: pa.Array) -> pa.Array:
    """The units of every text (strings without nulls) as a list array."""
    spaced = pc.binary_join_element_wise(" ", texts, " ", "")
    words = pc.split_pattern_regex(spaced, GAP)  # an empty string, the words, an empty string
    gaps = pc.split_pattern_regex(texts, WORD)  # one more than words
    parents, flat = pc.list_parent_indices(words), pc.list_flatten(words)
    first = np.ones(len(flat), bool)
    first[1:] = np.diff(parents.to_numpy()) != 0
    joined = pc.binary_join_element_wise(pc.list_flatten(gaps), pc.filter(flat, pa.array(~first)), "")
    parents = pc.list_parent_indices(gaps)
    filled = pc.greater(pc.binary_length(joined), 0)
    counts = np.bincount(pc.filter(parents, filled).to_numpy(), minlength=len(texts))
    return _rebuilt(pc.filter(joined, filled), counts)


def _any_mark(texts: pa.Array) -> np.ndarray:
    found = np.zeros(len(texts), bool)
    for mark in MARKS:
        found |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    return found


def _transform(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.fill_null(batch["text"].cast(pa.string()), "")
    draws = [batch[f"h{k}"].to_numpy().astype(np.int64) for k in (1, 2, 3, 4)]
    lists = units(texts)
    n = _sizes(lists)
    plain = (n == 0) | _any_mark(texts) | (draws[2] % 100 >= RATE)
    one, other = draws[0] % (n + 1), draws[1] % (n + 1)
    a, b = np.minimum(one, other), np.maximum(one, other)

    cut = pa.array(~plain)
    lists, a, b, left = lists.filter(cut), a[~plain], b[~plain], n[~plain]
    parents, flat = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
    ordinals = np.arange(len(flat)) - np.repeat(np.cumsum(left) - left, left)
    role = (ordinals >= a[parents]).astype(np.int8) + (ordinals >= b[parents])
    prefix, middle, suffix = (
        pc.binary_join(_rebuilt(pc.filter(flat, pa.array(role == k)), sizes), "")
        for k, sizes in enumerate((a, b - a, left - b)))

    tail_first = (draws[3] % 100 < SUFFIX_FIRST)[~plain]
    front, back, hole = MARKS
    psm = pc.binary_join_element_wise(front, prefix, back, suffix, hole, middle, "")
    spm = pc.binary_join_element_wise(back, suffix, front, prefix, hole, middle, "")
    made = pc.if_else(pa.array(tail_first), spm, psm)
    form = np.full(len(n), "plain", object)
    form[~plain] = np.where(tail_first, "spm", "psm")

    place = np.cumsum(~plain) - 1
    where = pa.array(place, pa.int64(), mask=plain)  # null for plain texts
    chars = [pc.take(pc.utf8_length(part), where).cast(pa.int64()) for part in (prefix, middle)]
    output = pc.coalesce(pc.take(made, where), texts)
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], pa.array(n), pa.array(form, pa.string()), *chars, output],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def stretches(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(lengths, dtype=np.int64), 0
    while at < len(lengths):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in stretches(batch, STRETCH):
            yield _transform(part)


def _draw(seed: int, number: int) -> Column:
    """The ``number``-th group of eight hex digits, from 1, of the hash of seed and doc_id."""
    known = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = F.substring(F.sha2(known.cast("binary"), 256), 8 * number - 7, 8)
    return F.conv(part, 16, 10).cast("long")


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``.

    ``n`` counts the units of a text. ``form`` is plain (the text as it is; no character counts),
    psm (marked prefix, suffix, middle) or spm (marked suffix, prefix, middle). Null and empty
    texts are plain and empty; so stay texts that hold a mark, which ``restore`` could not tell
    apart. Rows of one doc_id are cut by the same draws; without doc_id the draws are those of an
    empty id. Repeated rows come back as often as they went in. No rows: no rows. Extra columns
    are ignored. Row by row: nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = rows.select("*", *(_draw(seed, k).alias(f"h{k}") for k in (1, 2, 3, 4)))
    return drawn.mapInArrow(streamed(_cuts), SCHEMA)


def restore(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``, the text that each output and form came from.

    A mark cannot begin inside a part and end in the next mark, and no part holds one, so the
    first of each kind is the one that was set.
    """
    front, back, hole = MARKS
    until = lambda c, mark: F.substring_index(c, mark, 1)
    after = lambda c, mark: F.substring_index(c, mark, -1)
    output, middle = F.col("output"), after(F.col("output"), hole)
    outer = until(output, hole)
    psm = F.concat(after(until(outer, back), front), middle, after(outer, back))
    spm = F.concat(after(outer, front), middle, after(until(outer, front), back))
    return made.withColumn("restored", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(output))
