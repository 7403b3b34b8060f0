from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidewatch.llm import repeats
from tidewatch.llm.queries import op12_periodic_runs

SCHEMA = "doc_id long, text string, runs string, start int, collapsed int"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    """All runs by trying every period; a stretch belongs to its smallest one."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    lost = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in lost)


def row(doc_id, text):
    words = split(text)
    runs = brute(words)
    return doc_id, [tuple(r) for r in runs], collapsed(words, runs)


def order(rows):
    return sorted(rows, key=repr)


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(2)
    found = repeats.find_runs(frame).collect()
    for r in found:
        best = max(r.runs, key=lambda x: (x.length / x.period, -x.start, -x.period), default=None)
        assert r.strongest == best
    return order((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found)


def numbers(seed):
    draw = random.Random(seed)
    out = []
    while len(out) < 300:
        part = [draw.randrange(draw.choice([1, 2, 3, 50])) for _ in range(draw.randrange(1, 25))]
        out += (part * draw.randrange(1, 9))[:draw.randrange(1, 120)]
    return out


@pytest.mark.parametrize("seed", range(30))
def test_sequences_against_brute_force(seed):
    words = numbers(seed)
    found = repeats.runs_of(np.array(words, np.int64), len(words))
    assert [tuple(r) for r in found.tolist()] == brute(words)


@pytest.mark.parametrize("words", [[0] * 5, [0] * 6, [0] * 1000, [0, 1] * 500 + [0], ([0] * 7 + [1]) * 40,
                                   list(range(33)) * 5 + [7] * 64, ([0, 1] * 3 + [2]) * 9 + [0, 1, 0, 1]])
def test_sequences_of_one_kind(words):
    found = repeats.runs_of(np.array(words, np.int64), len(words))
    assert [tuple(r) for r in found.tolist()] == brute(words)


@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_sums_are_exact(size):
    draw = np.random.default_rng(size)
    blocks = draw.integers(0, 4, (9, size)).astype(np.uint64)
    windows = draw.integers(0, 4, (9, 2 * size)).astype(np.uint64)
    windows[3, size // 2: size // 2 + size] = blocks[3]
    for prime in repeats.PRIMES:
        zero = repeats._zero_distances(blocks, windows, *prime)
        wanted = [[(b == w[d: d + size]).all() for d in range(size)] for b, w in zip(blocks, windows)]
        assert zero.tolist() == wanted and zero[3, size // 2]
        back = repeats._backward(repeats._forward(windows, *prime, False), *prime)
        assert (back == windows).all()


def test_more_primes_where_numbers_are_large(monkeypatch):
    monkeypatch.setattr(repeats, "PRIMES", ((97, 5), (193, 5), (257, 3)))  # transforms of up to 32 numbers
    words = np.array([0, 39, 0, 0, 39, 39] * 2 + [5] * 9 + [3, 4, 9] * 5, np.int64)
    assert [tuple(r) for r in repeats.runs_of(words, 30).tolist()] == brute(words.tolist())
    with pytest.raises(ValueError):
        repeats.runs_of(np.array([4000, 1] * 60, np.int64), 120)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(repeats, "STRETCH", 400)
    draw = random.Random(1)
    text = lambda: draw.choice([" ", "\n", " \t"]).join(draw.choice("a b A é".split()) for _ in range(draw.randrange(60)))
    rows = [(draw.choice([k, 3, None]), text()) for k in range(120)]
    rows += [(1, None), (None, None), (2, ""), (4, " \n"), (5, "a a a a a"), (6, "\ta a a a a a "), (6, "a a a a a a"),
             (7, "b c d e f " * 900 + "end"), (8, "a " * 3000), (9, "a a a"), (10, "a a a")]
    assert run(spark, rows) == order(row(i, t) for i, t in rows)
    assert run(spark, []) == []


def test_whole_table_against_brute_force(spark):
    folder, wanted = "/root/testdata/sf0.01", []
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = split(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        number = {}
        runs = brute_by_numpy(np.array([number.setdefault(w, len(number)) for w in words], np.int64))
        best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2]), default=None)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        wanted.append((doc_id, len(runs), *shown, sha(listed), sha(collapsed(words, runs))))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    found = op12_periodic_runs(spark, folder).select(*names).collect()
    assert order(map(tuple, found)) == order(wanted)
    assert sum(r.n_runs for r in found) > 50


def brute_by_numpy(words):
    seen, out = set(), []
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate(([False], words[q:] == words[:-q], [False])).astype(np.int8)
        if same.sum() < 3 * q:
            continue
        edges = np.flatnonzero(np.diff(same))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
    return sorted(out, key=lambda r: (r[0], r[2]))
