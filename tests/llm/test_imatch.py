from __future__ import annotations

import hashlib
import math
import random

from tidewatch.llm import imatch

SCHEMA = "doc_id long, text string, prints string, stretch int, prints_2 int"


def edited(rows):
    """(doc_id, n_chars, sha) by doing the edit in Python."""
    rows = sorted(((i, t or "") for i, t in rows if i is not None))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()))
    return sorted(out)


def brute_prints(spark, texts):
    """Fingerprints from counts and hashes taken apart from the operator's own expressions."""
    from pyspark.sql import functions as F
    split = {t: {w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t.lower()) if w} for t in texts}
    vocabulary = sorted(set().union(*split.values()))
    code = {r.w: r.h for r in spark.createDataFrame([(w,) for w in vocabulary], "w string")
            .select("w", F.xxhash64("w").alias("h")).collect()}
    count = {}
    for t in texts:
        for w in split[t]:
            count[w] = count.get(w, 0) + 1
    kept = {w for w, n in count.items() if imatch.LEAST * len(texts) <= n <= imatch.MOST * len(texts)}
    slots = {code[w] % imatch.SLOTS for w in kept}
    return {t: sorted(code[w] for w in split[t] if code[w] % imatch.SLOTS in slots) for t in texts}


def test_whole_table_edits_and_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = imatch.edited_fingerprints(docs).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == edited(rows)
    by_text = {}
    for r in found:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in by_text.values())
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    mean = lambda name: sum(r[name] for r in found) / len(found)
    assert mean("near_edited") > 3 * mean("near_next")
    # equal terms mean equal fingerprints, and other terms other ones
    terms = brute_prints(spark, [t for _, t in rows])
    seen = {}
    for r in found:
        key = tuple(terms[dict(rows)[r.doc_id]])
        if key:
            assert seen.setdefault(key, r.fingerprint) == r.fingerprint
    assert len(set(seen.values())) == len(seen)


def test_odd_rows(spark):
    rows = [(5, None), (1, ""), (9000, "four five six seven"), (None, "abcdefgh"), (2, "a b c d"), (2, "a b c d"),
            (-7, "ü" * 41), (10**12, "long text " * 20000), (3, " \t ")]
    frame = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)
    found = imatch.edited_fingerprints(frame).collect()
    assert len(found) == len(rows)
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found if r.doc_id is not None) == edited(rows)
    lost = [r for r in found if r.doc_id is None]
    assert [(r.n_chars, r.near_next) for r in lost] == [(8, 0.0)]
    assert lost[0].edited_sha256 == hashlib.sha256(b"abcdef").hexdigest()
    assert len({r.fingerprint for r in found if r.n_chars == 0}) == 1
    assert imatch.edited_fingerprints(frame.limit(0)).count() == 0
    assert {r.near_next for r in imatch.edited_fingerprints(frame.filter("doc_id = 9000")).collect()} == {1.0}


def test_following_reaches_over_any_gap(spark):
    from tidewatch.llm.common import following
    keys = [-(1 << 62), -9, -1, 0, 3, 4, 5, 17, 18, 64, 65, 1000, 70000, 1 << 61]
    frame = spark.createDataFrame([(k,) for k in keys], "key long").repartition(5)
    assert {r.key: r.next_key for r in following(frame).collect()} == dict(zip(keys, keys[1:] + [None]))
    assert following(frame.limit(0)).count() == 0


def test_ids_like_hashes(spark):
    draw = random.Random(8)
    rows = [(draw.randrange(-(1 << 63), 1 << 63), f"text {k} " + "word " * draw.randrange(30)) for k in range(60)]
    found = imatch.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == edited(rows)


def test_likeness_is_that_of_the_shown_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = imatch.edited_fingerprints(docs).orderBy("doc_id").collect()

    def like(a, b):
        a, b = ([int(x[k:k + 8], 16) for k in range(0, len(x), 8)] for x in (a, b))
        pairs = [(x, y) for x, y in zip(a, b) if x or y]
        return 1.0 if a == b else sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0

    for k, r in enumerate(found):
        after = found[(k + 1) % len(found)]
        assert math.isclose(r.near_edited, like(r.fingerprint, r.edited_fingerprint), abs_tol=1e-12)
        assert math.isclose(r.near_next, like(r.fingerprint, after.fingerprint), abs_tol=1e-12)
