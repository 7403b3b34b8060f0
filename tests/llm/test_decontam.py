from __future__ import annotations

import hashlib
import random
import re

import pytest

from tidewatch.llm import decontam

ITEMS = "item_id long, text string, extra string"
DOCS = "doc_id long, text string, n_hit string"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(doc, items, window):
    """(n_words, n_hit, item ids) by comparing every place with every window."""
    w, hit, found = words(doc), set(), set()
    for item, text in items:
        v = words(text)
        size = min(window, len(v))
        if not size:
            continue
        grams = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in grams:
                hit.update(range(i, i + size))
                found.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(found)


def expect(doc, items, window=13):
    n, hit, found = brute(doc, items, window)
    sha = hashlib.sha256(",".join(found).encode()).hexdigest()
    return n, hit, len(found), sha, hit > 0 and 20 * hit >= n


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    found = {r.doc_id: tuple(r)[1:] for r in decontam.contamination(docs, bench).collect()}
    assert found == {r.doc_id: expect(r.text, items) for r in docs.collect()}
    assert any(x[-1] for x in found.values())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block", [100_000, 12])
def test_random_texts_of_few_words(spark, seed, block):
    draw = random.Random(seed)
    text = lambda n: " ".join(draw.choice("a b c é".split()) for _ in range(n))
    items = [(draw.choice([1, 2, 30, 4, None]), text(draw.randrange(0, 9))) for _ in range(12)]
    docs = [(i, text(draw.randrange(0, 30))) for i in range(60)]
    matched = decontam.match_spans(
        spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS), window=4, block_words=block)
    found = {r.doc_id: tuple(r)[1:] for r in decontam.report(matched).collect()}
    assert found == {i: expect(t, items, 4) for i, t in docs}


def test_odd_rows_and_empty_tables(spark):
    items = [(1, "Alpha beta"), (2, None), (3, "--"), (1, "alpha BETA"), (None, "gamma")]
    docs = [(1, "ALPHA, beta! gamma", "q"), (1, "ALPHA, beta! gamma", "q"), (None, "nothing", "q"), (2, None, "q"),
            (3, "", "q"), (4, "filler " * 30000 + "alpha beta", None)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = sorted((r.doc_id or 0, *tuple(r)[1:]) for r in decontam.contamination(frame, bench).collect())
    assert found == sorted((i or 0, *expect(t, items)) for i, t, _ in docs)
    assert decontam.contamination(frame.limit(0), bench).count() == 0
    assert all(r.n_hit == 0 for r in decontam.contamination(frame, bench.limit(0)).collect())


def test_cutting_leaves_clean_texts_alone(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen", "")], ITEMS)
    passage = "One, two three four five six seven eight nine ten eleven twelve - thirteen"
    long = "word " * 400 + passage
    frame = spark.createDataFrame([(1, f"Before {passage}. After", ""), (2, long, ""), (3, "clean", ""), (4, None, "")], DOCS)
    found = {r.doc_id: (r.text, r.n_cut) for r in decontam.decontaminate(frame, bench).collect()}
    assert found == {1: ("Before . After", 13), 2: (long, 0), 3: ("clean", 0), 4: ("", 0)}


def test_a_long_item_is_cut_into_blocks(spark):
    draw = random.Random(4)
    long = " ".join(draw.choice("a b c d e f".split()) for _ in range(200))
    items = [(1, long), (2, "e f a b"), (3, "a b")]
    bench = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = list(decontam.blocks(bench, 10, 4))
    assert all(sum(len(words(t.decode())) for _, t in block) <= 10 for block in found) and len(found) > 20
    docs = [(k, long[draw.randrange(100):][:draw.randrange(60)]) for k in range(40)]
    matched = decontam.match_spans(
        spark.createDataFrame([(i, t, "x") for i, t in docs], DOCS), bench, window=4, block_words=80)
    assert {r.doc_id: tuple(r)[1:] for r in decontam.report(matched).collect()} == {i: expect(t, items, 4) for i, t in docs}
