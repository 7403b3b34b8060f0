"""Benchmark decontamination with a generalised suffix automaton.

The test items' words become one suffix automaton. A document's words are streamed through
it, which gives at every word the longest run of words ending there that some item contains.
Where that run reaches the window length, its words are hit. Items shorter than a window are
one window of their own, found at the automaton's states along the suffix links.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, one automaton each: a task holds
one automaton, however long the benchmark is, and every document meets every block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, each, held, stored, streamed, text_bytes, with_carried

#: Words of test items in one automaton; bounds what is broadcast and what a task holds.
BLOCK_WORDS = 100_000
#: Lower-cases A-Z and turns every byte of [\x00-\x2F\x3A-\x60\x7B-\x7F] into a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Automaton:
    """Generalised suffix automaton over the words of items, given as (item, words)."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window, self.code = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set] = {}
        for item, words in items:
            last = 0
            for k, word in enumerate(words):
                last = self._extend(last, self.code.setdefault(word, len(self.code)))
                if k + 1 >= window:
                    ends.setdefault(last, set()).add(item)
        short: dict[int, list[tuple[int, object]]] = {}
        for item, words in items:
            if 0 < len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][self.code[word]]
                short.setdefault(state, []).append((len(words), item))
        self.short = short
        self.shortest = min([window, *(size for found in short.values() for size, _ in found)])
        # Items that hold a state's runs also hold the shorter runs up its suffix links.
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        for state in reversed(by_length):
            up = self.link[state]
            if state in ends and up > 0 and self.length[up] >= window:
                ends.setdefault(up, set()).update(ends[state])
        # For every state, up its links: the state of its last ``window`` words, and the next with short items.
        at_window, self.near_short = [0] * len(self.link), [0] * len(self.link)
        for state in by_length:
            up = self.link[state]
            if self.length[state] >= window:
                at_window[state] = state if self.length[up] < window else at_window[up]
            self.near_short[state] = state if state in short else self.near_short[up]
        self.found = [ends.get(s, set()) if s else set() for s in at_window]

    def _extend(self, last: int, c: int) -> int:
        step = self.next[last].get(c)
        if step is not None:
            return step if self.length[step] == self.length[last] + 1 else self._clone(last, c, step)
        state = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        while last != -1 and c not in self.next[last]:
            self.next[last][c] = state
            last = self.link[last]
        if last != -1:
            step = self.next[last][c]
            self.link[state] = step if self.length[step] == self.length[last] + 1 else self._clone(last, c, step)
        return state

    def _clone(self, at: int, c: int, state: int) -> int:
        copy = len(self.link)
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(self.length[at] + 1)
        while at != -1 and self.next[at].get(c) == state:
            self.next[at][c] = copy
            at = self.link[at]
        self.link[state] = copy
        return copy

    def match(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit stretches [start, end) of words, in order and disjoint, and the items found."""
        codes = np.fromiter(map(self.code.get, words, repeat(-1)), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        spans, items = [], set()
        for a, b in edge.reshape(-1, 2).tolist():
            if b - a < self.shortest:  # too few known words in a row to hold a window
                continue
            state = run = 0
            for at, c in enumerate(codes[a:b].tolist(), a + 1):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    run = self.length[state]
                step = self.next[state].get(c)
                state, run = (0, 0) if step is None else (step, run + 1)
                size = 0
                if run >= self.window:
                    items |= self.found[state]
                    size = self.window
                up = self.near_short[state]
                while up:
                    for length, item in self.short[up]:
                        if length <= run:
                            items.add(item)
                            size = max(size, length)
                    up = self.near_short[self.link[up]]
                if size:
                    start = at - size
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, at))
        return spans, items


def blocks(benchmark: DataFrame, most: int, window: int) -> Iterator[list[tuple[object, bytes]]]:
    """Items as (item_id, text) in blocks of at most ``most`` words, one at a time.

    A longer item is cut into stretches that share ``window`` - 1 words, so no window is lost.
    Rows come to the driver one by one; it holds one block.
    """
    most = max(most, 2 * window)
    block, size = [], 0
    items = benchmark.select("item_id", text_bytes().alias("text")).orderBy("item_id", "text")
    for row in items.toLocalIterator():
        words = words_of(bytes(row["text"]))
        for at in range(0, max(1, len(words) - window + 1), most - window + 1):
            part = words[at: at + most]
            if block and size + len(part) > most:
                yield block
                block, size = [], 0
            if part:
                block.append((row["item_id"], b" ".join(part)))
                size += len(part)
    if block:
        yield block


def _join(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


MATCHED = "doc_id long, text binary, n_words long, spans array<struct<a:long,b:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def match_spans(docs: DataFrame, benchmark: DataFrame, window: int = 13, block_words: int = BLOCK_WORDS,
                carry: Sequence[str] = ()) -> DataFrame:
    """For every row of ``docs`` (doc_id, text) the word stretches that a test item contains.

    Returns doc_id, text (bytes), n_words, spans (half-open word stretches, disjoint and in
    order) and items (the found item_ids as texts, sorted; an item without id is "null");
    columns named in ``carry`` come back in the struct ``carried``.
    """
    rows, work, schema, key = _last_block(docs, benchmark, window, block_words, carry)
    return rows.mapInArrow(streamed(work, key), schema)


def _last_block(docs, benchmark, window, block_words, carry):
    """Rows matched with all blocks but the last; function, schema and automaton's key of that one."""
    rows = documents(docs, carry)
    schema = with_carried(MATCHED, rows)
    carried = ["carried"] if carry else []
    rows = rows.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"), *carried)
    last: list = []
    for block in blocks(benchmark, block_words, window):  # one block's automaton at a time
        if last:
            rows = stored(rows.mapInArrow(streamed(*_matcher(docs, last, window, carried)), schema), "matched")
        last = block
    work, key = _matcher(docs, last, window, carried)
    return rows, work, schema, key


def _matcher(docs: DataFrame, block: list[tuple[object, bytes]], window: int, carried: list[str]):
    """A batch function that adds a block's matches to those found before; its automaton's key."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    key = hashlib.sha256(repr((window, block)).encode()).hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = held(key, lambda: Automaton([(item, words_of(text)) for item, text in shared.value], window))
        for batch in batches:
            counts, spans, items = [], [], []
            before = zip(batch["spans"].to_pylist(), batch["items"].to_pylist())
            for text, (old, seen) in zip(each(batch["text"]), before):
                words = words_of(text)
                found, names = machine.match(words)
                counts.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in _join(found + [(s["a"], s["b"]) for s in old])])
                items.append(sorted(set(seen) | {"null" if i is None else str(i) for i in names}))
            yield pa.record_batch(
                [batch["doc_id"], batch["text"], pa.array(counts, pa.int64()), pa.array(spans, _SPANS),
                 pa.array(items, pa.list_(pa.string())), *(batch[c] for c in carried)],
                names=["doc_id", "text", "n_words", "spans", "items", *carried])

    return work, key


def report(matched: DataFrame, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for rows of ``match_spans``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    rows = matched.select("doc_id", "n_words", hit.alias("n_hit"), "items")
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """What of every document the test items contain: one row for each row of ``docs``.

    A document is contaminated if it has a hit word and at least one in ``share`` of its words
    is hit. Null or empty texts have no words; null, empty and repeated items are allowed, as
    are repeated rows, rows without doc_id and empty tables. Extra columns are ignored.
    """
    return report(match_spans(docs, benchmark, window), share)


def cut_text(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the stretches and what stands between them."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORDS))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at: places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, text[at:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                  carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, n_cut for every row of ``docs``: hit stretches of contaminated texts are cut out.

    Texts that are not contaminated stay as they are; null texts become empty. Every row is judged
    by its own text: repeated rows, and rows that share a doc_id or have none, all come back. No
    rows: no rows; an empty benchmark contaminates nothing. Extra columns are ignored; those named
    in ``carry`` come back in the struct ``carried``.
    """
    carried = ["carried"] if carry else []
    rows, match, schema, key = _last_block(docs, benchmark, window, BLOCK_WORDS, carry)

    def work(batches):
        for batch in match(batches):  # in one worker with the last block's automaton
            texts, cut = [], []
            for text, count, spans in zip(
                    each(batch["text"]), batch["n_words"].to_pylist(), batch["spans"].to_pylist()):
                spans = [(s["a"], s["b"]) for s in spans]
                hit = sum(b - a for a, b in spans)
                guilty = hit > 0 and share * hit >= count
                texts.append((cut_text(text, spans) if guilty else text).decode("utf-8", "replace"))
                cut.append(hit if guilty else 0)
            yield pa.record_batch(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(cut, pa.int64()), *(batch[c] for c in carried)],
                names=["doc_id", "text", "n_cut", *carried])

    return rows.mapInArrow(streamed(work, key), with_carried("doc_id long, text string, n_cut long", rows))
