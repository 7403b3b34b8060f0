"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period q, at least four periods and six words long,
that neither neighbour extends. Texts are taken together as one sequence of word numbers, with
a number of its own between two texts, so no run crosses a border.

Scale B, a power of two, finds the periods from B to 2B - 1:

1. The sequence is cut into blocks of B words. A block is compared with the words B to 3B - 2
   behind its start at all B distances at once: the sums of squared differences of the numbers
   are a correlation, computed by number-theoretic transforms modulo primes. Residues of zero
   modulo primes whose product exceeds any possible sum mean a sum of zero, hence equal words:
   nothing is rounded and no hash is trusted. Blocks with a word that does not come again
   within 2B words cannot have an occurrence, and are left out before.
2. A run of period d holds two neighbouring blocks, at least, that both occur again at distance
   d. Such groups of blocks are seeds: the stretch of equal words at that distance is followed
   to both sides, word by word, to its ends.
3. A stretch whose distance is a multiple of a run's period found at a lower scale is that run.

Long and short texts cost n log n transforms each; texts that hardly repeat are cheaper.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import streamed
from .infill import stretches

#: A run has at least so many periods, and so many words.
PERIODS, WORDS = 4, 6
#: Bytes of text taken together; a longer text is a sequence of its own.
STRETCH = 1 << 20
#: Numbers in one transform call.
TRANSFORM = 1 << 19
#: Primes k * 2**e + 1 below 2**31, with a generator of their units.
PRIMES = ((2013265921, 31), (1811939329, 13), (2113929217, 5))
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = ("doc_id long, runs array<struct<start:long,length:long,period:long>>, "
          "strongest struct<start:long,length:long,period:long>, collapsed string")


@cache
def _powers(size: int, prime: int, generator: int, back: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``, or of its inverse."""
    root = pow(generator, (prime - 1) // size * (size - 1 if back else 1), prime)
    powers = np.ones(1, np.uint64)
    while len(powers) < size // 2:
        step = np.uint64(pow(root, len(powers), prime))
        powers = np.concatenate((powers, powers * step % np.uint64(prime)))
    return powers


def _forward(rows: np.ndarray, prime: int, generator: int, back: bool) -> np.ndarray:
    """Transforms of the rows, in bit-reversed order; ``back`` takes the inverse root."""
    m, size = rows.shape
    p, half = np.uint64(prime), size // 2
    while half:
        pair = rows.reshape(m, -1, 2, half)
        low, high = pair[:, :, 0], pair[:, :, 1]
        out = np.empty_like(pair)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder((low + (p - high)) * _powers(2 * half, prime, generator, back), p, out=out[:, :, 1])
        rows, half = out.reshape(m, size), half // 2
    return rows


def _backward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Undoes ``_forward``."""
    m, size = rows.shape
    p, half = np.uint64(prime), 1
    while half < size:
        pair = rows.reshape(m, -1, 2, half)
        low, high = pair[:, :, 0], pair[:, :, 1] * _powers(2 * half, prime, generator, True) % p
        out = np.empty_like(pair)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder(low + (p - high), p, out=out[:, :, 1])
        rows, half = out.reshape(m, size), 2 * half
    return rows * np.uint64(pow(size, -1, prime)) % p


def _zero_distances(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Where the sum of squared differences of a block (B numbers) and its window (2B) is 0 modulo the prime."""
    p, size = np.uint64(prime), blocks.shape[1]
    padded = np.zeros_like(windows)
    padded[:, :size] = blocks
    product = _forward(padded, prime, generator, True) * _forward(windows, prime, generator, False) % p
    cross = _backward(product, prime, generator)[:, :size]
    squares = np.zeros((len(windows), 2 * size + 1), np.uint64)
    np.cumsum(windows * windows % p, axis=1, out=squares[:, 1:])
    theirs = squares[:, size:2 * size] - squares[:, :size]
    ours = (blocks * blocks % p).sum(axis=1, dtype=np.uint64)[:, None]
    return (ours + theirs + np.uint64(2) * (p - cross)) % p == 0


def _occurrences(words: np.ndarray, which: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every block in ``which`` that occurs again ``size`` to 2 * size - 1 words later."""
    end = int(words.max(initial=0)) + 1  # behind the sequence: equal to none
    most, primes, product = size * end * end, [], 1
    for prime in PRIMES:
        if product <= most:
            primes.append(prime)
            product *= prime[0]
    if product <= most:
        raise ValueError(f"a text of {len(words)} words is too long for exact sums")
    inside, ahead = np.arange(size), np.arange(size, 3 * size)
    found, step = [], max(1, TRANSFORM // (2 * size))
    for at in range(0, len(which), step):
        starts = which[at: at + step, None] * size
        blocks = words[starts + inside].astype(np.uint64)
        places = starts + ahead
        windows = np.where(places < len(words), words[np.minimum(places, len(words) - 1)], end).astype(np.uint64)
        zero = _zero_distances(blocks, windows, *primes[0])
        for prime in primes[1:]:
            zero &= _zero_distances(blocks, windows, *prime)
        block, distance = np.nonzero(zero)
        found.append((which[at + block], distance + size))
    return tuple(np.concatenate(x) for x in zip(*found))


def _equal_words(words: np.ndarray, start: np.ndarray, distance: np.ndarray, step: int, width: int) -> np.ndarray:
    """How many words from ``start`` on, in direction ``step``, equal those at their distance."""
    total, going, offsets = np.zeros(len(start), np.int64), np.arange(len(start)), np.arange(width)
    last = len(words) - 1
    while len(going):
        still = []
        for part in np.array_split(going, -(-len(going) * width // TRANSFORM)):
            here = start[part, None] + step * (total[part, None] + offsets)
            there = here + distance[part, None]
            same = (here >= 0) & (there <= last)
            same &= words[np.clip(here, 0, last)] == words[np.clip(there, 0, last)]
            length = np.where(same.all(axis=1), width, same.argmin(axis=1))
            total[part] += length
            still.append(part[length == width])
        going = np.concatenate(still)
    return total


def _again(words: np.ndarray) -> np.ndarray:
    """Distance to the next equal word; the number of all words if there is none."""
    order = np.argsort(words, kind="stable")
    away = np.full(len(words), len(words), np.int64)
    same = words[order[1:]] == words[order[:-1]]
    away[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return away


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) of all runs, by start and period, of a sequence of whole numbers from 0.

    ``longest`` bounds the length of a run.
    """
    n = len(words)
    found = []
    cover_end, cover_period = np.zeros(n, np.int64), np.ones(n, np.int64)
    size, away = 1, _again(words)  # the farthest next equal word, for each block
    while PERIODS * size <= longest and len(away) > 1:
        live = away < 2 * size
        live[:-1] &= live[1:] | np.append(False, live[:-2])  # a seed has a neighbour
        live[-1] &= live[-2]
        which = np.flatnonzero(live)
        new = _at_scale(words, which, size, cover_end, cover_period) if len(which) else []
        for start, length, period in new:
            here = slice(start, start + length)
            farther = cover_end[here] < start + length
            cover_end[here][farther] = start + length
            cover_period[here][farther] = period
        found += new
        size *= 2
        away = away[:len(away) // 2 * 2].reshape(-1, 2).max(axis=1)
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _at_scale(words, which, size, cover_end, cover_period) -> list[tuple[int, int, int]]:
    """Runs with a period from ``size`` to 2 * size - 1."""
    block, distance = _occurrences(words, which, size)
    start = block * size
    # inside a run of a lower scale, at a multiple of its period: nothing new
    known = (cover_end[start] >= start + distance + size) & (distance % cover_period[start] == 0)
    block, distance = block[~known], distance[~known]
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    if not len(block):
        return []
    first = np.append(True, (np.diff(block) != 1) | (np.diff(distance) != 0))
    heads = np.flatnonzero(first)
    counts = np.diff(np.append(heads, len(block)))
    heads, counts = heads[counts > 1], counts[counts > 1]
    if not len(heads):
        return []
    distance, left = distance[heads], block[heads] * size
    right = left + counts * size
    left = left - _equal_words(words, left - 1, distance, -1, size)
    right = right + _equal_words(words, right, distance, 1, size) + distance
    length = right - left
    whole = length >= np.maximum(WORDS, PERIODS * distance)
    whole &= (cover_end[left] < right) | (distance % cover_period[left] != 0)
    return sorted(set(zip(left[whole].tolist(), length[whole].tolist(), distance[whole].tolist())))


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; of equal ones that with the smallest start, then period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _find(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = pc.fill_null(batch["text"].cast(pa.string()), "")
    lists = pc.ascii_split_whitespace(texts)
    parents, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    filled = pc.greater(pc.binary_length(flat), 0)
    parents, flat = pc.filter(parents, filled).to_numpy(), pc.filter(flat, filled)
    counts = np.bincount(parents, minlength=len(texts)).astype(np.int64)
    numbers = pc.dictionary_encode(flat)
    # each text is followed by a number that no word and no other text has
    words = np.empty(len(flat) + len(texts), np.int64)
    begins = np.cumsum(counts) - counts + np.arange(len(texts))
    words[np.arange(len(flat)) + parents] = numbers.indices.to_numpy()
    words[begins + counts] = len(numbers.dictionary) + np.arange(len(texts))

    runs = runs_of(words, int(counts.max(initial=0)))
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    lost = (np.cumsum(edge[:-1]) > 0)[np.arange(len(flat)) + parents]
    runs[:, 0] -= begins[owner]

    kept = np.bincount(parents[~lost], minlength=len(texts))
    offsets = pa.array(np.concatenate(([0], np.cumsum(kept))), pa.int32())
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, pc.filter(flat, pa.array(~lost))), " ")
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    listed = [tuple(r) for r in runs.tolist()]
    strongest = [_strongest(listed[a:b]) for a, b in zip(offsets, offsets[1:])]
    columns = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in runs.T], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), columns),
         pa.array([None if r is None else dict(zip(("start", "length", "period"), r)) for r in strongest], RUN),
         collapsed],
        ["doc_id", "runs", "strongest", "collapsed"])


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in stretches(batch, STRETCH):
            yield _find(part)


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, strongest, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` holds start (a word number, from 0), length and period of every run, by start and
    period; ``strongest`` is the one with most periods, of equal ones that with the smallest
    start, then period (null: no run). ``collapsed`` is the text with the first period of every
    run only: its words, without those that some run holds behind its first period, joined by
    one space. Words are runs of characters other than ASCII white space, compared as they are.
    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Rows are
    judged one by one: rows that repeat a doc_id, or have none, all come back. No rows: no
    rows. Extra columns are ignored. Nothing is shuffled; a task holds one stretch of texts, or
    one long text, at a time.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(streamed(_work), SCHEMA)
