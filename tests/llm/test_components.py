from __future__ import annotations

import random

from tidewatch.llm.components import connected_components


def roots(pairs):
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_chains_stars_and_random_edges(spark):
    draw = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 60)]
    pairs += [(draw.randrange(1000, 1200), draw.randrange(1000, 1200)) for _ in range(120)]
    pairs = [p for p in pairs if p[0] != p[1]]
    frame = spark.createDataFrame(pairs + pairs[:9] + [(7, 7), (8, None), (None, None)], "x long, y long")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == roots(pairs)


def test_texts_and_no_edges(spark):
    frame = spark.createDataFrame([("b", "a"), ("c", "b"), ("e", "d")], "x string, y string")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert connected_components(frame.limit(0)).count() == 0
