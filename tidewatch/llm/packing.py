"""Packing documents into training sequences by best-fit decreasing.

A document is its tokens and an end token. Documents longer than a sequence are first cut into
full windows, which need no partner. What is left of every document goes to the open window
with the least room that still takes it, longest pieces first; a segment tree over the rooms
finds that window. Windows that stay open are topped up by cutting the pieces of the emptiest
ones, so that one window of a part is short.

Documents are dealt into parts of about ``PART_DOCS`` documents, whatever their number; a task
streams through its parts and holds the unfinished pieces of one part at a time.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, held, streamed

SIZE = 2048
END = 1
#: Documents packed together.
PART_DOCS = 1024
#: Text tokenised at once, and bytes of remembered words, in a worker.
BATCH_BYTES, WORDS_BYTES = 4 << 20, 160 << 20
#: ASCII punctuation that a tokenizer may split from letters before it; no apostrophe, no <.
PUNCTUATION = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
TAIL = re.compile(rb"(.*[A-Za-z])([" + re.escape(PUNCTUATION).encode() + rb"]+)", re.DOTALL)
#: Words whose ids tell whether letters can go to the model directly.
PROBES = ["a", "word", "qzxjv" * 5, "é", "ñandú", "straße", "œuvre", "日本語", "жизнь", *map(chr, range(97, 123))]
PIECES = "part long, doc_id long, start long, doc_tokens long, ids binary"
PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class _Words(dict):
    """Ids of words, made when first asked for; words not asked for again are in ``old`` half."""

    def __init__(self, encode: Callable[[bytes], bytes], old: dict[bytes, bytes]):
        self.encode, self.old, self.held = encode, old, 0

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        self.held += len(word) + len(ids) + 130
        return ids


def _byte_letters() -> list[str]:
    """The letter a byte-level model writes for each byte: itself if it shows, else 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    If the tokenizer drops white space, so that a text's ids are those of its words, words are
    remembered (up to a bound) and looked up; otherwise texts are encoded whole. If it also
    takes ASCII case as one and splits punctuation from letters, "Word," is looked up as "word"
    and ",", and if its model works on bytes, words of small letters go to the model directly,
    without normalising and splitting. Probes at the start tell whether it does.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        one, two, both = self._ids(["a", "b", "a \n b"])
        self.by_word = one + two == both
        self.folds = self.by_word and self._ids(["AbC"]) == self._ids(["abc"])
        self.splits = self.by_word and all(
            self._ids([f"ab{c * n}"])[0] == b"".join(self._ids(["ab", c * n])) for c in PUNCTUATION for n in (1, 2, 3))
        self.direct = self.folds and self._ids(PROBES) == [self._of_letters(p.encode()) for p in PROBES]
        self.words = _Words(self._word, {})

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _of_letters(self, word: bytes) -> bytes:
        spelled = word.decode() if word.isascii() else "".join([self.letters[b] for b in word])
        return np.array([x.id for x in self.model.tokenize(spelled)], "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        core, tail = word, b""
        if b"<" not in word:  # may hold a special token
            if self.splits and (found := TAIL.fullmatch(word)):
                core, tail = found.groups()
            if self.folds and core.isascii():
                core = core.lower()
        if core != word:
            return self.words[core] + (self.words[tail] if tail else b"")
        text = word.decode("utf-8", "replace")
        if self.direct and text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
            return self._of_letters(word)
        return self._ids([text])[0]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._ids([t.decode("utf-8", "replace") for t in texts])
        if self.words.held > WORDS_BYTES // 2:
            self.words = _Words(self._word, dict(self.words))
        return [b"".join(map(self.words.__getitem__, t.split())) for t in texts]


def portions(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most BATCH_BYTES (or one text): the place of the first, and how many."""
    first = size = 0
    for k, length in enumerate(lengths):
        if size and size + length > BATCH_BYTES:
            yield first, k - first
            first, size = k, 0
        size += length
    if first < len(lengths):
        yield first, len(lengths) - first


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Every document's tokens and end token, cut into full windows and a rest."""
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(("encoder", path), lambda: Encoder(path)).encode
        for batch in batches:
            parts, names = batch["part"].to_pylist(), batch["doc_id"].to_pylist()
            for first, n in portions(pc.binary_length(batch["text"]).to_pylist()):
                rows = []
                for k, ids in enumerate(encode(batch["text"].slice(first, n).to_pylist()), first):
                    ids += last
                    rows += [(parts[k], names[k], at // 4, len(ids) // 4, ids[at: at + 4 * size])
                             for at in range(0, len(ids), 4 * size)]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 4 + (pa.binary(),))],
                    names=["part", "doc_id", "start", "doc_tokens", "ids"])

    count = max(1, -(-docs.count() // PART_DOCS))
    rows = documents(docs)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).alias("part")
    return rows.select(part, "doc_id", "text").mapInArrow(streamed(work, ("encoder", path)), PIECES)


class OpenWindows:
    """Windows by room: a segment tree over rooms finds the least room that is enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _change(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window that has ``need`` room."""
        at = self.leaves + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.windows[room].pop()


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Windows as lists of places in ``lengths``; longest first, ties by place."""
    windows: list[list[int]] = []
    opened = OpenWindows(size)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = opened.take(lengths[k])
        room, window = found or (size, len(windows))
        if found is None:
            windows.append([])
        windows[window].append(k)
        if room > lengths[k]:
            opened.put(room - lengths[k], window)
    return windows


def top_up(windows: list[list[tuple]], size: int) -> list[list[tuple]]:
    """Fill open windows from the emptiest ones; pieces are (row, first, last) of tokens."""
    used = [sum(b - a for _, a, b in w) for w in windows]
    order = sorted((k for k in range(len(windows)) if used[k] < size), key=lambda k: (-used[k], k))
    windows = [list(w) for w in windows]
    i, j = 0, len(order) - 1
    while i < j:
        to, source = order[i], order[j]
        row, a, b = windows[source].pop()
        n = min(b - a, size - used[to])
        windows[to].append((row, a, a + n))
        if n < b - a:
            windows[source].append((row, a + n, b))
        used[to] += n
        used[source] -= n
        i += used[to] == size
        j -= not windows[source]
    return [w for w in windows if w]


def _pack(size: int, fill: bool):
    def flush(part: int, rest: list[tuple], number: int) -> list[tuple]:
        """Rows of PACKED for the rests of a part; sequences are numbered from ``number``."""
        lengths = [len(r[3]) // 4 for r in rest]
        windows = [[(k, 0, lengths[k]) for k in w] for w in best_fit_decreasing(lengths, size)]
        rows = []
        for window in top_up(windows, size) if fill else windows:
            offset = 0
            for k, a, b in window:
                doc_id, start, doc_tokens, ids = rest[k]
                rows.append((doc_id, start + a, b - a, doc_tokens, (part << 32) + number, offset, ids[4 * a: 4 * b]))
                offset += b - a
            number += 1
        return rows

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(),) * 6 + (pa.binary(),)
        columns = zip(*rows) if rows else [()] * 7
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rest, number = None, [], 0
        for batch in batches:
            rows = []
            for at, doc_id, start, doc_tokens, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if at != part:
                    if rest:
                        rows += flush(part, rest, number)
                    part, rest, number = at, [], 0
                if len(ids) == 4 * size:
                    rows.append((doc_id, start, size, doc_tokens, (part << 32) + number, 0, ids))
                    number += 1
                else:
                    rest.append((doc_id, start, doc_tokens, ids))
                    if len(rest) >= 16 * PART_DOCS:  # only where one row is repeated that often
                        found = flush(part, rest, number)
                        rows, rest, number = rows + found, [], 1 + max(r[4] for r in found) - (part << 32)
            yield batch_of(rows)
        if rest:
            yield batch_of(flush(part, rest, number))

    return work


def pack(docs: DataFrame, path: str, size: int = SIZE, end: int = END, fill: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` tokens.

    Returns doc_id, start (tokens of the document before the piece), length, doc_tokens (with
    the end token), sequence_id, offset (in the sequence, without gaps) and ids (the piece's
    tokens, little-endian unsigned 32-bit). Every token lies in exactly one piece. ``fill``
    lets open windows be topped up by cutting. Null and empty texts are an end token; rows
    without doc_id and repeated rows are packed like any other; no rows: no rows; extra
    columns are ignored.
    """
    rows = pieces(docs, path, size, end)
    rows = rows.repartition("part").sortWithinPartitions("part", "doc_id", "doc_tokens", "start", "ids")
    return rows.mapInArrow(streamed(_pack(size, fill)), PACKED)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids, segments (length and doc_id of each piece, in order)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p")
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts)
    ids = F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    segments = F.transform("p", lambda x: F.struct(x["length"].alias("length"), x["doc_id"].alias("doc_id")))
    return rows.select("sequence_id", "length", ids.alias("ids"), segments.alias("segments"))
