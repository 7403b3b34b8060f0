from __future__ import annotations

import hashlib
import random
import re

import pytest

from tidewatch.llm import substrings
from tidewatch.llm.queries import op7_substring_dedup

SCHEMA = "doc_id long, text string, chunk string, n_words int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept words) by a dictionary of all windows."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def order(rows):
    return sorted(rows, key=repr)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    wanted = brute([(r.doc_id, r.text) for r in docs], 20)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = op7_substring_dedup(spark, "/root/testdata/sf0.01")
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert order(found) == order((i, n, k, sha(t)) for i, n, k, t in wanted)
    assert sum(k for _, _, k, _ in found) > 1000


@pytest.mark.parametrize("seed,window,phrase", [(1, 5, 3), (2, 5, 5), (3, 4, 1), (4, 6, 2)])
def test_random_texts_of_few_words(spark, monkeypatch, seed, window, phrase):
    monkeypatch.setattr(substrings, "CHUNK_BITS", 2)
    draw = random.Random(seed)
    rows = [(draw.choice([k, k, 7 * k, None]), draw.choice([" ", "\n", "\t  "]).join(
        draw.choice("a b ab É".split()) for _ in range(draw.randrange(0, 40)))) for k in range(60)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = substrings.dedup(frame, window, phrase).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, " ".join(words(r.text))) for r in found]
    assert order(got) == order(brute(rows, window))


def test_odd_rows(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(5, None), (3, ""), (9000, passage), (2, "head  " + passage + "\ntail"), (None, passage), (7, " \t"),
            (2, "head  " + passage + "\ntail"), (4, "z " * 30000), (8, "clean  text\n stays")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = substrings.dedup(frame).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, " ".join(words(r.text))) for r in found]
    assert order(got) == order(brute(rows, 20))
    texts = {r.doc_id: r.text for r in found if r.n_removed == 0}
    assert texts[8] == "clean  text\n stays" and texts[2] == "head  " + passage + "\ntail"
    assert substrings.dedup(frame.limit(0)).count() == 0


def test_long_texts_make_smaller_chunks():
    bits = [substrings.chunk_bits(1000, 1000 * mean) for mean in (0, 3000, 12_000, 200_000, 10**8)]
    assert bits == [10, 10, 8, 4, 4] and substrings.chunk_bits(0, 0) == 10
    assert all((12_000 + substrings.ROW) << b <= substrings.HEAVY // 2 for b in bits[2:3])


@pytest.mark.parametrize("hot,most", [(None, 1000), (6, 1000), (6, 2)])
def test_rows_that_share_an_id_are_split(spark, monkeypatch, hot, most):
    monkeypatch.setattr(substrings, "CHUNK_BITS", 2)
    monkeypatch.setattr(substrings, "HEAVY", 4000)
    monkeypatch.setattr(substrings, "PART", 2000)
    monkeypatch.setattr(substrings, "MOST_PARTITIONS", most)
    draw = random.Random(9)
    text = lambda: " ".join(draw.choice("a b ab É ö".split()) for _ in range(draw.randrange(0, 40)))
    rows = [(k, text()) for k in range(40)]
    if hot is None:  # their order among themselves is free: texts that share no window, and copies of one
        rows += [(None, " ".join(f"n{k}-{j}" for j in range(20))) for k in range(100)]
    else:
        rows += [(hot, text()) for _ in range(100)] + [(80, text()) for _ in range(100)]
    rows += [(hot, " ".join(f"same{j}" for j in range(20)))] * 100
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    dealt, _ = substrings.chunked(substrings.documents(frame))
    sizes = [r["count"] for r in dealt.groupBy("chunk").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 80 and len(sizes) > 12
    found = substrings.dedup(frame, 5, 3).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, " ".join(words(r.text))) for r in found]
    assert order(got) == order(brute(rows, 5))
