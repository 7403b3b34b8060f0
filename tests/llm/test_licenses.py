from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np

from tidewatch.llm import licenses
from tidewatch.llm.queries import op10_license_scans

SCHEMA = "doc_id long, text string, license string, notice int"


def found_in(text):
    return [(r[0], round(r[2], 3)) for r in licenses.Scanner(licenses.TEMPLATES).scan(text.encode())]


def test_every_notice_is_found_where_it_stands():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, texts in licenses.TEMPLATES.items():
        for number, text in enumerate(texts):
            found = scanner.scan(f"Éa some words. {text} and others".encode())
            assert [(r[0], r[2]) for r in found] == [(name, 1.0)], (name, number)
            whole = f"Éa some words. {text} and others".encode()
            assert whole[found[0][5]:found[0][6]].decode().strip('." ') == text.strip('." ')


def test_changed_notices():
    assert found_in("Released under THE MIT license.") == [("MIT", 1.0)]
    assert found_in("Licensed under the fine Apache License, Version 2.0") == [("Apache-2.0", 1.0)]
    text = "This work is hereby licensed under the GNU Public License, version 3"
    assert found_in(text) == [("GPL-3.0", 0.917)]
    assert found_in("This work is in print. A license is under review by the public.") == []
    assert found_in("x " * 9 + "Released under the MIT License " * 2) == [("MIT", 1.0)] * 2
    assert found_in("Licensed under CC BY-NC 4.0") == [("CC-BY-NC-4.0", 1.0)]


def test_alignment_against_all_subsequences():
    draw = random.Random(6)
    for _ in range(200):
        document = [draw.randrange(4) for _ in range(draw.randrange(1, 9))]
        template = [draw.randrange(4) for _ in range(draw.randrange(1, 6))]
        low = draw.randrange(-3, 4)
        high = low + draw.randrange(0, 5)
        best = 0
        for size in range(1, min(len(document), len(template)) + 1):
            for places in combinations(range(len(document)), size):
                for wanted in combinations(range(len(template)), size):
                    if all(document[p] == template[w] and low <= p - w <= high for p, w in zip(places, wanted)):
                        best = max(best, size)
        count, a, b = licenses.align(np.array(document), template, low, high)
        assert count == best and (not count or count <= b - a)


def test_winnowing_keeps_one_of_every_window():
    draw = random.Random(2)
    words = [draw.choice([b"a", b"b", b"c"]) for _ in range(60)]
    kept = licenses.winnow(words, 3, 4)
    assert all(any(at + k in kept for k in range(4)) for at in range(58 - 3))
    assert licenses.winnow([b"a"], 3, 2).keys() == {0}


def test_table_against_plain_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = licenses.scan(docs).collect()
    rows = {r.doc_id: r.text for r in docs.collect()}
    for name, phrase in (("MIT", "Released under the MIT License"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
                         ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
                         ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0")):
        plain = {i: t.count(phrase) for i, t in rows.items() if phrase in t}
        assert plain
        ours = [r for r in found if r.license == name and r.coverage == 1]
        assert {i: sum(r.doc_id == i for r in ours) for i in plain} == plain
        assert all(rows[r.doc_id].encode()[r.first_byte:r.last_byte].decode() == r.matched for r in ours)
    assert all(r.coverage >= licenses.COVERAGE for r in found)


def test_odd_rows(spark):
    notice = "Released under the MIT License"
    rows = [(1, None), (2, ""), (None, notice), (3, notice), (3, notice), (4, "word " * 30000 + notice), (5, "\n\t")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = sorted((r.doc_id or 0, r.license, r.first_word) for r in licenses.scan(frame).collect())
    assert found == [(0, "MIT", 0), (3, "MIT", 0), (3, "MIT", 0), (4, "MIT", 30000)]
    assert licenses.scan(frame.limit(0)).count() == 0
    assert licenses.scan(frame, templates={}).count() == 0


def test_licenses_that_differ_in_a_word():
    gnu = "under the terms of the GNU {} License as published by the Free Software Foundation, either version {} of the License"
    assert found_in(gnu.format("Lesser General Public", "3")) == [("LGPL-3.0", 1.0)]
    assert found_in(gnu.format("Lesser General Public", "2.1")) == [("LGPL-2.1", 1.0)]
    assert found_in(gnu.format("Library General Public", "2")) == [("LGPL-2.0", 1.0)]
    assert found_in(gnu.format("Affero General Public", "3")) == [("AGPL-3.0", 1.0)]
    assert found_in(gnu.format("General Public", "3")) == [("GPL-3.0", 1.0)]
    assert found_in("licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License") == []
    assert [n for n, _ in found_in("Released under MIT License")] == ["MIT"]
    assert [n for n, _ in found_in("It is released under the ISC License.")] == ["ISC"]
    assert found_in("It was released under the table, and the work is under a cloud.") == []


def test_whole_texts_of_near_relatives():
    texts = {name: [t for t in notices if len(t) > 150][-1:] for name, notices in licenses.TEMPLATES.items()}
    for name in ("MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"):
        for text in texts[name]:
            numbered = text.replace("Redistributions", "* Redistributions").replace("Neither", "3. Neither")
            for version in (text, numbered, text.upper(), "Copyright 2031 A. Nother\n\n" + text.replace(" ", "\n   ", 40)):
                assert [n for n, _ in found_in(version)] == [name]


def test_query_against_alignment_of_every_place(spark):
    """Every template at every place of every text that holds enough of its words."""
    folder = "/root/testdata/sf0.01"
    scanner = licenses.Scanner(licenses.TEMPLATES)
    index, band = scanner.index, scanner.band
    wanted = []
    for doc_id, text in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        words = text.encode().translate(licenses._WORDS).split()
        codes = np.array([index.code.get(w, -1) for w in words], np.int64)
        found = []
        for number, template in enumerate(index.words):
            held = Counter(codes.tolist())
            if sum(min(n, held[w]) for w, n in Counter(template).items()) < 0.8 * len(template):
                continue
            first = {w for w in template}
            starts = [d for d in range(-len(template), len(codes)) if d + len(template) > 0]
            near = np.isin(codes, list(first))
            for d in starts[::band]:
                here = near[max(0, d - band): d + len(template) + 2 * band]
                if here.sum() < 0.8 * len(template):
                    continue
                count, a, b = licenses.align(codes, template, d - band, d + 2 * band)
                if count >= 0.8 * len(template) and not index.qualifiers.intersection(codes[a:b].tolist()) - first:
                    found.append((count, *index.names[number], count / len(template), a, b))
        wanted += [(doc_id, r[0]) for r in licenses.strongest(sorted(set(found)))]
    got = [(r.doc_id, r.license) for r in op10_license_scans(spark, folder).collect()]
    assert sorted(got) == sorted(wanted) and len(got) > 3
