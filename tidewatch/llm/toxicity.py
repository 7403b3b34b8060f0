"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

A text is the set of its words and of their beginnings (4 characters), hashed to 32 bits, so
that inflected forms share a feature. One weight vector w is shared by all thresholds:
P(grade >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ..., and the expected severity is the sum
of these probabilities over k. A text is toxic if P(grade >= 1) is at least ``LIMIT``.

The model is fitted in one task on a bounded sample of labelled documents (``SAMPLE`` of them,
those with the least hash of their id). The model keeps features of at least ``LEAST`` sampled
documents that tell toxic ones from others, so its size is bounded by the sample's; it is
broadcast and every document is scored where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, each, let_go, streamed

#: Labelled documents that the model is fitted on.
SAMPLE = 20_000
#: A feature is kept if at least LEAST sampled documents have it and its shares in toxic and
#: other documents are at least APART standard errors apart.
LEAST, APART = 5, 4.0
BEGINNING = 4
#: Probability from which a text counts as toxic.
LIMIT = 0.5
#: Gradient steps, their size and the pull of weights towards zero (for each document).
STEPS, RATE, RIDGE = 300, 0.1, 1e-5
#: Words a task remembers.
WORDS_CACHE = 200_000
#: Lower-cases A-Z and turns ASCII other than letters and digits into spaces.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class _Codes(dict):
    """The feature numbers of words, as bytes; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORDS_CACHE:
            self.clear()
        start = word.decode("utf-8", "replace")[:BEGINNING].encode()
        self[word] = codes = np.array([crc32(word), crc32(b"-" + start)], np.uint32).tobytes()
        return codes


def features(text: bytes, codes: _Codes) -> np.ndarray:
    """Distinct feature numbers of a text, ascending."""
    words = set(text.translate(_WORDS).split())
    return np.unique(np.frombuffer(b"".join(map(codes.__getitem__, words)), np.uint32))


class Model:
    """Weights of the kept features (ascending) and ascending thresholds."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, at: np.ndarray):
        self.kept, self.weights, self.at = kept, weights, at

    def score(self, text: bytes, codes: _Codes) -> float:
        found = features(text, codes)
        if not len(self.kept) or not len(found):
            return 0.0
        place = np.minimum(np.searchsorted(self.kept, found), len(self.kept) - 1)
        return float(self.weights[place[self.kept[place] == found]].sum())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def severity_grades(toxic: np.ndarray, rows: np.ndarray, codes: np.ndarray, width: int) -> np.ndarray:
    """Grades 0, 1, 2 where labels only say yes or no.

    A feature tells if it is ten times as frequent in toxic documents as in others. Toxic
    documents with more telling features than half of the toxic ones are graded severe, 2.
    """
    bad = toxic > 0
    if not bad.any():
        return np.zeros(len(toxic), np.int64)
    inside = np.bincount(codes[bad[rows]], minlength=width)
    outside = np.bincount(codes[~bad[rows]], minlength=width)
    telling = (inside >= LEAST) & (inside / bad.sum() > 10 * outside / max(1, (~bad).sum()))
    count = np.bincount(rows, weights=telling[codes], minlength=len(toxic))
    return bad.astype(np.int64) + (bad & (count > np.median(count[bad])))


def fit(grades: np.ndarray, rows: np.ndarray, codes: np.ndarray, width: int, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps (Adam) on the ordinal likelihood.

    ``rows`` and ``codes`` are the documents' features as pairs; codes run from 0 to width - 1.
    """
    n = max(1, len(grades))
    share = np.array([np.mean(grades >= k) if len(grades) else 0.0 for k in range(1, levels)])
    share = np.clip(share, 1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    gaps = np.maximum(np.diff(start), 0.05)
    x = np.concatenate([np.zeros(width), start[:1], np.log(gaps)])  # weights, first threshold, log gaps
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        w, wide = x[:width], np.exp(x[width + 1:])
        at = x[width] + np.concatenate(([0], np.cumsum(wide)))
        score = np.bincount(rows, weights=w[codes], minlength=len(grades))
        edge = np.concatenate(([-np.inf], at, [np.inf]))
        a, b = sigmoid(score - edge[grades]), sigmoid(score - edge[grades + 1])
        p = np.maximum(a - b, 1e-12)
        slope = a + b - 1  # of the loss by the score
        into = np.bincount(grades, weights=a * (1 - a) / p, minlength=levels)[1:]
        past = np.bincount(grades, weights=b * (1 - b) / p, minlength=levels)[:-1]
        by_at = into - past
        grad = np.concatenate([
            np.bincount(codes, weights=slope[rows], minlength=width) / n + RIDGE * w,
            [by_at.sum() / n], np.cumsum(by_at[::-1])[::-1][1:] * wide / n])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        x = x - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return x[:width], x[width] + np.concatenate(([0], np.cumsum(np.exp(x[width + 1:]))))


def ordered(found: Sequence[np.ndarray]) -> np.ndarray:
    """All features of some texts, ascending, each as often as texts have it."""
    flat = np.concatenate(found) if len(found) else np.zeros(0, np.uint32)
    flat.sort()
    return flat


def shared_by(flat: np.ndarray, least: int) -> np.ndarray:
    """The distinct values that ``flat``, ascending, holds at least ``least`` times."""
    heads = flat[:max(0, len(flat) - least + 1)]
    often = heads == flat[least - 1:]
    often[1:] &= heads[1:] != heads[:-1]
    return heads[often]


def times(flat: np.ndarray, names: np.ndarray) -> np.ndarray:
    """How often ``flat``, ascending, holds each name."""
    return np.searchsorted(flat, names, "right") - np.searchsorted(flat, names)


def pairs(found: Sequence[np.ndarray], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in ``names``) of the texts' features that are among ``names``, one text at a time."""
    places = []
    for x in found:
        at = np.minimum(np.searchsorted(names, x), max(0, len(names) - 1))
        places.append(at[names[at] == x] if len(names) else at[:0])
    rows = np.repeat(np.arange(len(found)), [len(x) for x in places])
    return rows, np.concatenate(places) if places else np.zeros(0, np.int64)


def fit_texts(label: np.ndarray, found: Sequence[np.ndarray], levels: int, binary: bool) -> Model:
    """A model of texts given as their features (distinct, ascending).

    Most features are not kept, so they are only counted; numbered pairs are made of the kept.
    """
    bad = label > 0
    flat = ordered(found)
    names = shared_by(flat, LEAST)
    count = times(flat, names)
    inside = times(ordered([x for x, b in zip(found, bad) if b]), names)
    del flat
    outside = (count - inside) / max(1, (~bad).sum())
    inside = inside / max(1, bad.sum())
    share = count / max(1, len(label))
    error = np.sqrt(share * (1 - share) * (1 / max(1, bad.sum()) + 1 / max(1, (~bad).sum())))
    kept = names[(np.abs(inside - outside) >= APART * error) & (error > 0)]
    rows, codes = pairs(found, kept)
    grades = severity_grades(label, rows, codes, len(kept)) if binary else np.clip(label, 0, levels - 1)
    return Model(kept, *fit(grades, rows, codes, len(kept), levels))


def train(docs: DataFrame, labels: DataFrame, grade: Column | None = None, levels: int = 3,
          sample: int = SAMPLE) -> Model:
    """A model from ``labels`` (doc_id, toxic) of some rows of ``docs``.

    ``grade`` names a column of labels with grades 0 .. levels - 1. Without it the labels
    only say toxic or not, and toxic documents are graded by ``severity_grades``. Rows without
    a label or doc_id are not used. Of rows that share a doc_id the one with the least features
    (in order of their numbers) is used, once for each label of that id.
    """
    label = (F.col("toxic") if grade is None else grade).cast("int").alias("label")
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label).filter("label is not null and doc_id is not null")
    # at most ``sample`` rows: small enough to send to every task
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = documents(docs).join(F.broadcast(chosen), "doc_id")
    binary = grade is None

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            found = [features(t, known).tobytes() for t in each(batch["text"])]
            yield pa.record_batch([batch["doc_id"], batch["label"], pa.array(found, pa.binary())], names=["doc_id", "label", "codes"])

    def learn(t: pa.Table) -> pa.Table:
        let_go()
        order = pc.sort_indices(t, [("doc_id", "ascending"), ("label", "ascending")]).to_pylist()
        # the features stay where Arrow holds them
        found = [np.frombuffer(t["codes"][i].as_buffer(), np.uint32) for i in order]
        model = fit_texts(np.array([t["label"][i].as_py() for i in order], np.int64), found, levels, binary)
        parts = (model.kept, model.weights, model.at)
        return pa.table([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["kept", "weights", "at"])

    found = rows.mapInArrow(streamed(codes), "doc_id long, label int, codes binary")
    # one row for each label, however many rows share its doc_id: the group below is no larger than the sample
    found = found.groupBy("doc_id", "label").agg(F.min("codes").alias("codes"))
    row = found.groupBy(F.lit(1).alias("one")).applyInArrow(learn, "kept binary, weights binary, at binary").first()
    if row is None:
        return Model(np.zeros(0, np.uint32), np.zeros(0), 9.0 + np.arange(levels - 1))
    return Model(*(np.frombuffer(bytes(x), kind) for x, kind in zip(row, (np.uint32, np.float64, np.float64))))


def grade(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """(doc_id, p_toxic, severity, grade, toxic) for every row of ``docs`` (doc_id, text).

    p_toxic is P(grade >= 1), severity the expected grade, grade the likeliest one, and toxic
    whether p_toxic reaches ``limit``. Null and empty texts have no features. Rows without
    doc_id and repeated rows are graded like any other; no rows: no rows; extra columns are
    ignored. Without labelled documents no text is toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, codes = shared.value.score, _Codes()
        for batch in batches:
            scores = np.array([score(t, codes) for t in each(batch["text"])], np.float64)
            over = sigmoid(scores[:, None] - shared.value.at[None, :])  # P(grade >= k)
            edge = [np.ones((len(scores), 1)), over, np.zeros((len(scores), 1))]
            exact = -np.diff(np.concatenate(edge, axis=1), axis=1)
            yield pa.record_batch(
                [batch["doc_id"], pa.array(over[:, 0]), pa.array(over.sum(axis=1)),
                 pa.array(exact.argmax(axis=1).astype(np.int64)), pa.array(over[:, 0] >= limit)],
                names=["doc_id", "p_toxic", "severity", "grade", "toxic"])

    return documents(docs).mapInArrow(streamed(work), "doc_id long, p_toxic double, severity double, grade long, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, codes = shared.value, _Codes()
        for batch in batches:
            scores = (model.score((t or "").encode(), codes) for t in each(batch["text"].cast(pa.string())))
            yield batch.filter(pa.array([bool(sigmoid(s - model.at[0]) < limit) for s in scores], pa.bool_()))

    return docs.mapInArrow(streamed(work), docs.schema)
