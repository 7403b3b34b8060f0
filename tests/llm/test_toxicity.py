from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidewatch.llm import toxicity
from tidewatch.llm.queries import op4_toxicity

DOCS = "doc_id long, text string, label string, toxic int"


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learn, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    model = toxicity.train(docs, learn)
    rows = toxicity.grade(docs, model).join(held.withColumnRenamed("toxic", "truth"), "doc_id").collect()
    bad, clean = [r for r in rows if r.truth == 1], [r for r in rows if r.truth == 0]
    assert np.mean([r.toxic for r in bad]) > 0.85 and np.mean([r.toxic for r in clean]) < 0.005
    assert all(0 <= r.severity <= 2 and (r.severity > r.p_toxic or r.p_toxic < 1e-9) for r in rows)
    assert {r.grade for r in bad} >= {1, 2}
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).select("doc_id").collect()}
    assert {r.doc_id for r in toxicity.grade(docs, model).filter("toxic").collect()}.isdisjoint(kept)


def test_ordered_thresholds_recover_a_known_model():
    rng = np.random.default_rng(5)
    n, width = 4000, 6
    x = rng.random((n, width)) < 0.5
    score = x @ np.array([2.0, -1.0, 1.5, 0.0, 0.5, -2.0])
    noise = rng.logistic(size=n)
    grades = np.digitize(score + noise, [0.0, 1.0, 2.5])
    rows, codes = np.nonzero(x)
    w, at = toxicity.fit(grades, rows, codes, width, 4)
    assert (np.diff(at) > 0).all()
    fitted = toxicity.sigmoid((x @ w)[:, None] - at).sum(axis=1)
    true = toxicity.sigmoid(score[:, None] - np.array([0.0, 1.0, 2.5])).sum(axis=1)
    assert np.corrcoef(fitted, true)[0, 1] > 0.99 and abs(fitted - true).mean() < 0.15


def test_odd_rows(spark):
    draw = random.Random(2)
    words = [f"word{k}" for k in range(50)]
    text = lambda bad: " ".join(draw.choices(words, k=20) + (["Vile!", "vilest"] if bad else []))
    rows = [(k, text(k % 4 == 0), "x", k % 4 == 0) for k in range(400)]
    odd = [(None, "vile vilest", "x", None), (900, None, "x", None), (901, "", "x", None), (902, "vile, vilest " * 20000, "x", None)]
    frame = spark.createDataFrame([(i, t, x, None) for i, t, x, _ in rows + odd] * 2, DOCS)
    labels = spark.createDataFrame([(i, int(b), "x") for i, _, _, b in rows] + [(None, 1, "x"), (7, None, "x"), (7777, 1, "x")],
                                   "doc_id long, toxic int, text string")
    model = toxicity.train(frame, labels)
    found = toxicity.grade(frame, model).collect()
    assert len(found) == 2 * len(rows + odd)
    truth = {i: bool(b) for i, _, _, b in rows} | {None: True, 900: False, 901: False, 902: True}
    assert all(r.toxic == truth[r.doc_id] for r in found)
    assert toxicity.keep_clean(frame, model).columns == frame.columns
    assert toxicity.keep_clean(frame, model).count() == 2 * sum(not b for b in truth.values())
    assert toxicity.grade(frame.limit(0), model).count() == 0
    untrained = toxicity.train(frame, labels.limit(0))
    assert not any(r.toxic for r in toxicity.grade(frame, untrained).collect())


def test_given_grades(spark):
    rows = [(k, f"{'bad ' if k % 3 else ''}{'worse' if k % 3 == 2 else 'plain'} filler{k % 5}", "x", 0) for k in range(300)]
    frame = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(k, k % 3) for k in range(300)], "doc_id long, level int")
    model = toxicity.train(frame, labels, grade=F.col("level"))
    found = toxicity.grade(frame, model).collect()
    assert all(r.grade == r.doc_id % 3 for r in found)
    mean = [np.mean([r.severity for r in found if r.doc_id % 3 == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2] and not any(map(math.isnan, mean))


def test_scores_are_the_models_weights_one_by_one(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    weight = dict(zip(model.kept.tolist(), model.weights.tolist()))
    assert len(weight) > 20 and (np.diff(model.at) > 0).all()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in op4_toxicity(spark, folder).collect():
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[row.doc_id])
        words = set(re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower))
        found = {zlib.crc32(w.encode()) for w in words} | {zlib.crc32(b"-" + w[:4].encode()) for w in words}
        score = math.fsum(weight.get(f, 0.0) for f in found)
        over = [1 / (1 + math.exp(-(score - t))) for t in model.at]
        exact = [1 - over[0], over[0] - over[1], over[1]]
        assert math.isclose(row.p_toxic, over[0], abs_tol=1e-9) and math.isclose(row.severity, sum(over), abs_tol=1e-9)
        assert row.toxic == (over[0] >= 0.5) and math.isclose(exact[row.grade], max(exact), abs_tol=1e-9)


def test_rows_that_share_a_label_count_once(spark):
    rows = [(k, f"{'vile' if k % 2 else 'kind'} word{k % 7}") for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = spark.createDataFrame(rows + rows[:3] * 500, "doc_id long, text string").repartition(3)
    a, b = toxicity.train(once, labels), toxicity.train(often, labels)
    assert (a.kept == b.kept).all() and np.allclose(a.weights, b.weights) and np.allclose(a.at, b.at)


def test_a_fit_needs_little_more_memory_than_its_features():
    """Rare features, which most are, are counted and never numbered."""
    rng = np.random.default_rng(11)
    label = (np.arange(1500) % 5 == 0).astype(np.int64)
    found = [np.unique(np.concatenate([rng.integers(100, 2**32, 1000, dtype=np.uint32), np.array([7 + b, 20 + k % 9], np.uint32)]))
             for k, b in enumerate(label)]
    tracemalloc.start()
    model = toxicity.fit_texts(label, found, 3, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * sum(x.nbytes for x in found)
    assert {7, 8} <= set(model.kept.tolist())


def test_features_are_counted_once_a_text():
    found = [np.array(x, np.uint32) for x in ([1, 5, 9], [], [5], [5, 9, 2**32 - 1])]
    flat = toxicity.ordered(found)
    for least in range(1, 6):
        names = toxicity.shared_by(flat, least)
        assert names.tolist() == [x for x, n in ((1, 1), (5, 3), (9, 2), (2**32 - 1, 1)) if n >= least]
    assert toxicity.times(flat, np.array([1, 4, 5, 9], np.uint32)).tolist() == [1, 0, 3, 2]
    rows, at = toxicity.pairs(found, np.array([5, 2**32 - 1], np.uint32))
    assert list(zip(rows.tolist(), at.tolist())) == [(0, 0), (2, 0), (3, 0), (3, 1)]
    none = toxicity.ordered([])
    assert not len(toxicity.shared_by(none, 5)) and [len(x) for x in toxicity.pairs(found, none)] == [0, 0]
