from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tidewatch.llm import simhash

SCHEMA = "doc_id long, text string, component_id string, fp int"


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    pairs = [(i, j) for i, x in enumerate(prints) for j, y in enumerate(prints[:i]) if (x ^ y).bit_count() <= radius]
    label, before = list(range(len(prints))), None
    while label != before:
        before = list(label)
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return label


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [brute_print(t) for _, t in rows]
    label = brute_components(prints, 4)
    wanted = {i: (f"{p:016x}", rows[k][0]) for (i, _), p, k in zip(rows, prints, label)}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == wanted
    assert len({c for _, c in found.values()}) < len(rows)


def test_odd_rows(spark):
    rows = [(5, None, "x", 1), (3, "", "y", 2), (None, "a b", "z", 3), (7, "A  B", None, None), (7, "a b", "", 0),
            (9, " \t\n", "q", 1), (11, "one two three four five six seven " * 4000, "q", 1)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = {(r.doc_id, r.fingerprint): r.component_id for r in found}
    assert len(found) == len(rows)
    assert by_id[(5, "0" * 16)] == by_id[(9, "0" * 16)] == 3
    ab = f"{brute_print('a b'):016x}"
    assert by_id[(None, ab)] == by_id[(7, ab)] == 7
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_planes_find_the_same_pairs_as_counting(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = base[rng.integers(0, 6, 300)]
    for _ in range(5):
        prints ^= np.where(rng.random(300) < 0.6, np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64), np.uint64(0))
    n = len(prints)
    high = np.minimum(np.arange(n) + 1 + rng.integers(0, 200, n), n)
    got = {(int(i), int(j)) for a, b in simhash.near_pairs(prints, np.arange(n) + 1, high, radius) for i, j in zip(a, b)}
    want = {(i, j) for i in range(n) for j in range(i + 1, high[i]) if int(prints[i] ^ prints[j]).bit_count() <= radius}
    assert got == want


def test_a_full_bucket_is_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL", 8)
    rng = np.random.default_rng(3)
    near = [0x1234567890ABCDEF ^ (1 << int(b)) ^ (1 << int(c)) for b, c in rng.integers(0, 64, (60, 2))]
    far = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in near + far})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(frame, 4).collect()]
    label = {p: p for p in prints}
    for _ in prints:
        for a, b in edges:
            assert bin((a ^ b) & (2**64 - 1)).count("1") <= 64
            label[a] = label[b] = min(label[a], label[b])
    whole = brute_components([p & (2**64 - 1) for p in prints], 4)
    assert {p: label[p] for p in prints} == {p: prints[k] for p, k in zip(prints, whole)}


@pytest.mark.parametrize("radius,agree", [(4, 2), (4, 3), (4, 4), (0, 2), (2, 5)])
def test_every_choice_of_blocks_finds_the_same_components(spark, radius, agree):
    rng = np.random.default_rng(agree)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)[rng.integers(0, 12, 90)]
    for _ in range(4):
        base ^= np.where(rng.random(90) < 0.7, np.uint64(1) << rng.integers(0, 64, 90).astype(np.uint64), np.uint64(0))
    prints = sorted(set(base.view(np.int64).tolist()))
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius, agree).collect()
    label = {p: p for p in prints}
    for _ in prints:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    whole = brute_components([p & (2**64 - 1) for p in prints], radius)
    assert {p: label[p] for p in prints} == {p: prints[k] for p, k in zip(prints, whole)}


def test_more_prints_take_longer_keys():
    found = [simhash.blocks_to_agree(4, n) for n in (0, 10**6, 10**9, 10**11)]
    assert found[0] == 2 and found == sorted(found) and found[-1] >= 4


def test_one_row_of_each_component_stays(spark):
    one, two, other = "alpha beta gamma delta epsilon", "zeta eta theta iota kappa", "lamda mu nu xi omicron"
    rows = [(1, one, "a"), (2, one, "b"), (2, two, "c"), (2, two, "d"), (1, other, "e"), (None, two, "f"), (None, "pi rho sigma tau", "g"),
            (None, "pi rho sigma tau", "h"), (5, None, "i"), (6, "", "j"), (None, None, "k"), (7, other, "l")]
    frame = spark.createDataFrame([(i, t, c, 1) for i, t, c in rows], "doc_id long, text string, t1 string, row int").repartition(3)
    found = simhash.keep_one(frame)
    assert found.columns == frame.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    assert kept == sorted([(1, one), (2, two), (1, other), (None, "pi rho sigma tau"), (5, None)], key=repr)
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_kept_rows_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    assert found == sorted({r.component_id for r in simhash.near_duplicates(docs).collect()})
