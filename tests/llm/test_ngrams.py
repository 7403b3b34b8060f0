from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidewatch.llm import ngrams
from tidewatch.llm.common import LOWER

SCHEMA = "doc_id long, text string, chunk string, score int"


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def brute(rows, order=ngrams.ORDER, priors=ngrams.PRIORS):
    """Counts and scores with dictionaries."""
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = collections.Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            t = tokens(text)
            count.update(tuple(t[k: k + n]) for n in range(1, order + 1) for k in range(len(t) - n + 1))
    one = {g[0]: c for g, c in count.items() if len(g) == 1}
    n, v = sum(one.values()), len(one)

    def after(context, w):
        if not context:
            return (one.get(w, 0) + 1) / (n + v + 1)
        shorter = after(context[1:], w)
        if not count[context]:
            return shorter
        prior = priors[min(len(context), len(priors)) - 1]
        return (count[(*context, w)] + prior * shorter) / (count[context] + prior)

    found = []
    for (i, text), out in zip(rows, held):
        t = tokens(text)
        score = sum(math.log10(after(tuple(t[max(0, k - order + 1): k]), w)) for k, w in enumerate(t))
        found.append((i, out, len(t), sum(w in one for w in t), n, sum(math.log10(after((), w)) for w in t), score))
    return found, one, after


def compare(found, wanted, order=ngrams.ORDER):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found, wanted = sorted(map(tuple, found), key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    step = ngrams.FLOOR / ngrams.STEPS
    for a, b in zip(found, wanted):
        assert math.isclose(a[5], b[5], rel_tol=1e-11)
        assert abs(a[6] - b[6]) <= 0.51 * step * order * a[2] + 1e-9


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_whole_table_against_dictionaries(spark, monkeypatch, order):
    monkeypatch.setattr(ngrams, "CHUNK_DOCS", 64)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    wanted, one, after = brute(rows, order)
    found = ngrams.score(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), order).collect()
    compare(found, wanted, order)
    # probabilities after a context add up to one with one unseen word
    common = [w for w, _ in collections.Counter(one).most_common(3) if w]
    for context in [(), (common[0],), tuple(common[:2]), (*common, common[0]), ("never seen",)]:
        context = context[:order - 1]
        assert math.isclose(sum(after(context, w) for w in one) + after(context, "another"), 1, rel_tol=1e-9)
    # held-out texts are likelier than under the base, as soon as there is a context
    held = [r for r in found if r.held_out]
    gain = sum(r.score for r in held) - sum(r.base_score for r in held)
    assert gain > 0 if order > 1 else abs(gain) < 1


def test_longer_contexts_predict_held_out_texts_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a_token = [ngrams.score(docs, order).filter("held_out").agg({"score": "sum", "n_tokens": "sum"}).first() for order in (1, 2, 3)]
    one, two, three = (r["sum(score)"] / r["sum(n_tokens)"] for r in a_token)
    assert one < two < three


def test_tokens_are_those_of_split():
    texts = [b"", b" ", b"  A\x0bb\tA\xc3\x89 \x1c \r\n", b"\xff\xfe a\xa0b A", b"a", b"\x0c\x0c", "ÀB\u2003\x85 x".encode()]
    for few in (texts, texts[:2], [b"a"]):
        keys, at, counts = ngrams._tokens(pa.chunked_array([few[:1], few[1:]], pa.binary()))
        wanted = [[xxhash.xxh64_intdigest(w) for w in t.translate(LOWER).split()] + [int(ngrams.END)] for t in few]
        assert counts.tolist() == [len(w) for w in wanted]
        assert keys[at].tolist() == sum(wanted, [])
        assert (np.diff(keys) > 0).all() if len(keys) > 1 else True


def test_order_and_priors_are_checked(spark):
    frame = spark.createDataFrame([(1, "a b", "x", 1)], SCHEMA)
    for wrong in ({"order": 0}, {"priors": ()}, {"priors": (5.0, 0.0)}):
        with pytest.raises(ValueError):
            ngrams.score(frame, **wrong)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "A b a B"), (3, "A b a B"), (None, "a b c"), (5, "x " * 20000), (6, " \t"), (7, "É é É")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    compare(ngrams.score(frame).collect(), brute(rows)[0])
    assert ngrams.score(frame.limit(0)).count() == 0
    alone = ngrams.score(frame.filter("doc_id is null")).first()
    assert (alone.held_out, alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score) == (True, 4, 0, 0, 0.0)


@pytest.mark.parametrize("n,top", [(0, 10), (1, 2**64 - 1), (5, 7), (300, 400), (300, 2**64 - 1), (2000, 10**6)])
def test_elias_fano_against_a_list(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    code = ngrams.EliasFano.build(values)
    if n:
        assert (code.at(np.arange(n)) == values).all()
    assert (code.all() == values).all()
    wanted = np.concatenate([rng.integers(0, top, 300, dtype=np.uint64, endpoint=True), values[:50], [np.uint64(0), np.uint64(top)]])
    first = rng.integers(0, n + 1, len(wanted))
    last = rng.integers(first, n + 1)
    expected = [next((k for k in range(a, b) if values[k] >= x), b) for x, a, b in zip(wanted.tolist(), first, last)]
    assert code.successor(wanted, first, last).tolist() == expected
    exact = [k if k < b and values[k] == x else -1 for x, k, b in zip(wanted.tolist(), expected, last.tolist())]
    assert code.find(wanted, first, last).tolist() == exact


def test_trie_finds_what_was_put_in():
    rng = np.random.default_rng(8)
    words = np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64))
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, len(words), (900, 2))})
    rng.shuffle(pairs)
    # three words: two pairs that overlap, each known by its place in the list of pairs
    triples = [(k, m) for k, (_, b) in enumerate(pairs) for m, (c, _) in enumerate(pairs) if b == c and rng.random() < 0.3]
    levels = [tuple(np.array(x) for x in zip(*level)) for level in (pairs, triples)]
    scores = [-rng.random(len(x)) for x in (words, pairs, triples)]
    trie = ngrams.Trie(words, levels, scores, [-rng.random(len(words)), -rng.random(len(pairs))])
    assert trie.find_words(words).tolist() == list(range(len(words)))
    assert (trie.find_words(words + np.uint64(1)) == -1).all()
    a, b = np.divmod(np.arange(len(words) ** 2), len(words))
    edges = trie.edges(2)
    place = {p: k for k, p in enumerate(sorted(pairs))}
    assert trie.find(2, a, b, edges).tolist() == [place.get(p, -1) for p in zip(a.tolist(), b.tolist())]
    # all triples whose two pairs are there, known or not
    both = [(x, y, z) for x, y in place for y_, z in place if y == y_]
    first = np.array([place[x, y] for x, y, _ in both])
    second = np.array([place[y, z] for _, y, z in both])
    known = {(*pairs[k], pairs[m][1]): s for (k, m), s in zip(triples, scores[2])}
    found = trie.find(3, first, second - edges[np.array([y for _, y, _ in both])], trie.edges(3))
    assert [g in known for g in both] == (found >= 0).tolist()
    told = ngrams.dequantise(trie.scores[2][found[found >= 0]])
    assert np.allclose(told, [known[g] for g in both if g in known], atol=ngrams.FLOOR / ngrams.STEPS)


def test_a_row_repeated_often_is_counted_once_for_all(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "COPIES", 5)
    seen = spark.sparkContext.accumulator(0)
    ask = ngrams._ask
    monkeypatch.setattr(ngrams, "_ask", lambda *a: lambda t, work=ask(*a): (seen.add(len(t)), work(t))[1])
    rows = [(1, "a b a c")] * 40 + [(None, "a b x")] * 30 + [(k, f"a w{k} b") for k in range(2, 30)] + [(3, "q r")] * 3
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)
    compare(ngrams.score(frame).collect(), brute(rows)[0])
    assert 0 < seen.value < 60  # of 101
