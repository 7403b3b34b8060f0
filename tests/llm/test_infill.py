from __future__ import annotations

import hashlib
import random
import re

from compare import connect, mismatch
from tidewatch.llm import infill
from tidewatch.llm.queries import LLM_ORACLE, op11_fill_in_middle

SCHEMA = "doc_id long, text string, n string, form int, h1 int, output int"
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    text = text or ""
    cut = UNITS.findall(text)
    n = len(cut)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(cut[:a]), "".join(cut[a:b]), "".join(cut[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def order(rows):
    return sorted(rows, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA).repartition(2)
    found = infill.restore(infill.transform(frame)).collect()
    assert order(tuple(r)[:6] for r in found) == order(brute(i, t) for i, t in rows)
    assert order((r.doc_id, r.restored) for r in found) == order((i, t or "") for i, t in rows)
    return found


def test_whole_table_against_brute_force_and_sql(spark):
    folder = "/root/testdata/sf0.01"
    found = op11_fill_in_middle(spark, folder)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = [(*brute(i, t)[:5], sha(brute(i, t)[5]), sha(t or "")) for i, t in docs]
    assert order(map(tuple, found.collect())) == order(wanted)
    assert mismatch(found, connect(folder).sql(LLM_ORACLE["op11_fill_in_middle"])) is None


def test_odd_texts_round_trip(spark, monkeypatch):
    monkeypatch.setattr(infill, "STRETCH", 200)
    draw = random.Random(5)
    piece = lambda: draw.choice(["a", "é", "<P", "P>", "<", "S>", "<S", "M>", "<M", " ", "\n", "\t ", "\x0b", " ", "😀x", "\0", "\x1c"])
    rows = [(draw.choice([k, k, 7, None]), "".join(piece() for _ in range(draw.randrange(0, 30)))) for k in range(400)]
    rows += [(1, None), (None, None), (2, ""), (3, " "), (4, "x"), (5, " x"), (6, "x "), (8, "a<M>b"), (9, "word " * 60000)]
    forms = {r.form for r in check(spark, rows)}
    assert forms == {"plain", "psm", "spm"}


def test_empty_table_and_repeated_rows(spark):
    check(spark, [(12, "one two three")] * 40 + [(13, " ")] * 3)
    assert infill.transform(spark.createDataFrame([], SCHEMA)).count() == 0
