from __future__ import annotations

import hashlib
import random

import pytest

from compare import connect, mismatch
from tidewatch.llm import lines
from tidewatch.llm.queries import LLM_ORACLE, op13_line_dedup

SCHEMA = "doc_id long, text string, key string, lines int, salt int, pos int, gone int"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\f\r").translate(AZ)


def brute(rows, least=1, documents=10):
    count = {}
    for _, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            count[k] = count.get(k, 0) + 1
    gone = {k for k, n in count.items() if n >= documents and len(k) >= least}
    out = []
    for doc_id, text in rows:
        cut = (text or "").split("\n")
        kept = [x for x in cut if key(x) not in gone]
        out.append((doc_id, len(cut), len(cut) - len(kept), "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=repr)


def run(spark, rows, **limits):
    frame = spark.createDataFrame([(i, t, "x", 1, 2, 3, None) for i, t in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in lines.dedup(frame, **limits).select("doc_id", "n_lines", "n_dropped", "text").collect()]


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = [(i, n, k, sha(t)) for i, n, k, t in brute([tuple(r) for r in docs])]
    found = op13_line_dedup(spark, "/root/testdata/sf0.01")
    found = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found.collect()]
    assert order(found) == order(wanted)
    assert sum(r[2] for r in found) > 50


@pytest.mark.parametrize("seed,least,documents", [(1, 1, 3), (2, 0, 4), (3, 3, 2), (4, 1, 1)])
def test_random_lines(spark, seed, least, documents):
    draw = random.Random(seed)
    line = lambda: draw.choice([" ", "", "\t", "\r"]) + draw.choice("Ab É éx abc AB ß".split() + [str(draw.randrange(30)), ""]) + draw.choice(["", " \x0b"])
    rows = [(draw.choice([k, 3, None]), draw.choice([None, ""] + ["\n".join(line() for _ in range(draw.randrange(1, 9)))] * 8)) for k in range(60)]
    assert order(run(spark, rows, least=least, documents=documents)) == order(brute(rows, least, documents))


def test_odd_rows(spark):
    many = "\n".join(f"line {k % 50}" for k in range(20000))
    rows = [(1, None), (1, ""), (None, None), (None, "Foot"), (2, "foot\n\n \nhead\n"), (3, many), (4, many + "\nown"), (5, "\n\n")]
    assert order(run(spark, rows, documents=2)) == order(brute(rows, documents=2))
    assert run(spark, []) == []


@pytest.mark.parametrize("heavy", [1000, 2])
def test_hot_lines_and_copies_are_dealt_out(spark, monkeypatch, heavy):
    monkeypatch.setattr(lines, "HEAVY", heavy)
    monkeypatch.setattr(lines, "SALTS", 5)
    rows = [(k, f"FOOT\nown {k}\nfoot ") for k in range(80)] + [(7, "a\nFoot\nb")] * 70 + [(None, "a\nFoot\nb")] * 70 + [(None, None)] * 60
    assert order(run(spark, rows)) == order(brute(rows))
    texts = lines._texts(spark.createDataFrame(rows, "doc_id long, text string"))
    heavy_keys = spark.createDataFrame([(None, "a\nFoot\nb"), (7, "a\nFoot\nb")], "doc_id long, text string")
    from pyspark.sql import functions as F
    dealt = lines._salted(texts, heavy_keys, ["doc_id", "text"], F.monotonically_increasing_id())
    sizes = [r["count"] for r in dealt.filter("text like 'a%'").groupBy("doc_id", "salt").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 30


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert mismatch(op13_line_dedup(spark, folder), connect(folder).sql(LLM_ORACLE["op13_line_dedup"])) is None
