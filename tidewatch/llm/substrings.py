"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of a document. Words are removed if some window over
them starts earlier elsewhere: in a document with a smaller id, or earlier in its own.

1. Phrases: of the ``phrase``-word phrases in a window, the one with the least hash stands for
   it. Equal windows have equal phrases, so a repeated passage always shows as a repeated
   phrase, although only about one phrase in seven is looked at. Shards of phrase keys confirm
   which phrases recur anywhere (cells.py).
2. Automata: a chunk's confirmed phrases are compiled into an Aho-Corasick automaton, one
   shard of automata for each chunk, and the chunk's documents are streamed through it, word
   by word, to locate every occurrence. Only windows whose phrase is confirmed can repeat.
3. First places: shards of window keys tell a chunk which of its windows an earlier chunk
   holds; chunks are ranges of doc_ids in order. Together with the windows that repeat inside
   the chunk this settles every word.

Chunks that many rows share, such as those of one repeated doc_id or of no doc_id, are split
into runs of their rows in order, each a chunk of its own.

Window keys have 96 bits, so distinct windows are not taken for equal ones. Texts are shuffled
to their chunks; from there only packed keys and one bit for each key travel.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import with_positions

from . import cells
from .common import documents, stored, with_carried

WINDOW, PHRASE = 20, 8
#: Letters that spell words for the automaton, at each place of a word.
LETTERS = 64
#: 2 ** 10 neighbouring doc_ids are one chunk.
CHUNK_BITS = 10
#: Chunk of the rows without doc_id: behind all others.
LAST = 1 << 60
#: Bytes of a chunk that is split, and of the parts it is split into; a row counts ROW more.
HEAVY, PART, ROW = 8 << 20, 4 << 20, 64
#: Partitions that heavy chunks are sorted into, at most, and bits for the numbers of a partition's parts.
MOST_PARTITIONS, PIECE_BITS = 20_000, 24
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

class Chunk:
    """The documents of a chunk as one run of words, in order of doc_id and text."""

    def __init__(self, rows: pa.Table, window: int, phrase: int):
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.window, self.phrase = window, phrase
        self.number = rows["chunk"][0].as_py() if len(rows) else None
        self.doc_ids, self.texts = rows["doc_id"].to_pylist(), rows["text"].to_pylist()
        self.carried = [rows["carried"]] if "carried" in rows.column_names else []
        self.split = [t.split() for t in self.texts]
        self.words = [w for words in self.split for w in words]
        counts = np.array([len(w) for w in self.split], np.int64)
        self.ends = np.cumsum(counts)
        self.hashes = cells.WordHashes().of(self.words)
        # starts of windows that lie in one document
        room = np.repeat(self.ends, counts) - np.arange(len(self.words))
        self.starts = np.flatnonzero(room >= window)

    @cached_property
    def standing(self) -> np.ndarray:
        """For every window the place of the phrase that stands for it."""
        if not len(self.starts):
            return self.starts
        width = self.window - self.phrase + 1
        offset = np.lib.stride_tricks.sliding_window_view(self.grams, width).argmin(axis=1)
        return self.starts + offset[self.starts]

    @cached_property
    def grams(self) -> np.ndarray:
        return cells.gram_hashes(self.hashes, self.phrase)

    @cached_property
    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of the phrases that stand for windows, a place and the number of places of each."""
        places = np.unique(self.standing)
        keys, first, count = np.unique(self.grams[places], return_index=True, return_counts=True)
        return keys, places[first], count

    def candidates(self, recurs: np.ndarray) -> np.ndarray:
        """Starts of windows whose phrase the automaton finds; ``recurs`` flags the phrases."""
        first = self.phrases[1][recurs].tolist()
        spelled, width = _spell({w for place in first for w in self.words[place: place + self.phrase]})
        unknown = "\0" * width
        automaton = ahocorasick.Automaton()
        for place in first:
            automaton.add_word("".join([spelled[w] for w in self.words[place: place + self.phrase]]), True)
        hit = np.zeros(len(self.words), bool)
        if len(first):
            automaton.make_automaton()
            at = 0
            for words in self.split:
                text = "".join(map(spelled.get, words, repeat(unknown)))
                ends = [end for end, _ in automaton.iter(text)]
                hit[(np.array(ends, np.int64) + 1) // width + (at - self.phrase)] = True
                at += len(words)
        return self.starts[hit[self.standing]]

    def window_keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96-bit keys of windows: 64 bits and 32 more."""
        size = max(0, len(self.words) - self.window + 1)
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        high = cells.gram_hashes(self.hashes, self.window)
        low = cells.gram_hashes(cells.mix(self.hashes + np.uint64(0x632BE59BD9B4E019)), self.window, 0xD1342543DE82EF95)
        assert len(high) == size
        return high[starts], (low[starts] >> np.uint64(32)).astype(np.uint32)

    def removed(self, starts: np.ndarray) -> np.ndarray:
        """Words covered by the windows at ``starts``."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.window, -1)
        return np.cumsum(edge[:-1]) > 0


def _spell(words: set[bytes]) -> tuple[dict[bytes, str], int]:
    """Words as strings of one width over small alphabets, one for each place in the string.

    The automaton searches a node's edges one by one, so few letters make it fast; letters
    of different places differ, so that no match begins inside a word.
    """
    width = 1
    while LETTERS ** width < len(words):
        width += 1
    alphabets = [[chr(1 + LETTERS * place + k) for k in range(LETTERS)] for place in range(width)]
    spelled = {}
    for number, word in enumerate(words):
        letters = []
        for alphabet in alphabets:
            number, letter = divmod(number, LETTERS)
            letters.append(alphabet[letter])
        spelled[word] = "".join(letters)
    return spelled, width


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, flags of the first of equal keys in that order, and number of each in it."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    return order, new, np.cumsum(new) - 1


def _pair(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(4, "little") + a + b


def _place(chunk: Chunk) -> bytes:
    """The first doc_id of a chunk, none last: chunks of one place are in order of their numbers."""
    first = chunk.doc_ids[0]
    return struct.pack("<?q", first is None, first or 0)


def _unpair(data: bytes) -> tuple[bytes, bytes]:
    n = 4 + int.from_bytes(data[:4], "little")
    return data[4:n], data[n:]


def _answer_phrases(chunks: list[int], payloads: list[bytes]) -> list[bytes]:
    """A bit for each key: does another chunk have it?"""
    keys = [cells.unpack_keys(p) for p in payloads]
    flat = np.concatenate(keys)
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    flags = np.split(count[place] > 1, np.cumsum([len(k) for k in keys])[:-1])
    return [np.packbits(f).tobytes() for f in flags]


def _answer_windows(chunks: list[int], payloads: list[bytes]) -> list[bytes]:
    """A bit for each key: does an earlier chunk have it? Masks go back as they came."""
    asking = [k for k, p in enumerate(payloads) if p[:1] == b"k"]
    asking.sort(key=lambda k: struct.unpack("<?q", payloads[k][1:10]))
    keys = []
    for k in asking:
        a, b = _unpair(payloads[k][10:])
        keys.append((cells.unpack_keys(a), cells.unpack_planes(b, np.uint32)))
    if not keys:
        return payloads
    high, low = (np.concatenate(x) for x in zip(*keys))
    order, new, _ = _distinct(high, low)  # stable: equal keys stay in order of their chunks
    earlier = np.empty(len(order), bool)
    earlier[order] = ~new
    out = list(payloads)
    for k, flags in zip(asking, np.split(earlier, np.cumsum([len(k[0]) for k in keys])[:-1])):
        out[k] = b"k" + np.packbits(flags).tobytes()
    return out


def _flags(parts: list[tuple[int, np.ndarray]], answers: dict[int, bytes], total: int) -> np.ndarray:
    """Answers in the order of a chunk's keys."""
    out = np.zeros(total, bool)
    for shard, places in parts:
        out[places] = np.unpackbits(np.frombuffer(answers[shard], np.uint8), count=len(places)).astype(bool)
    return out


def chunk_bits(rows: int, size: int) -> int:
    """Bits of a doc_id that a chunk spans: fewer where texts are long, so that few chunks are heavy."""
    bits = CHUNK_BITS
    while bits > 4 and (size // max(rows, 1) + ROW) << bits > HEAVY // 2:
        bits -= 1
    return bits


def _pieces(part: int):
    """Sorted rows of heavy chunks, their numbers raised by one at every ``part`` bytes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            ends = total + np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False) + ROW, dtype=np.int64)
            total = int(ends[-1]) if len(ends) else total
            number = pa.array(batch["chunk"].to_numpy() + ends // part, pa.int64())
            yield batch.set_column(batch.schema.get_field_index("chunk"), "chunk", number)

    return work


def chunked(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with the number of their ``chunk``, and the number of shards.

    Rows of heavy chunks are sorted into parts by doc_id and text, rows without doc_id by
    nothing but their place in the input, which also parts repeated rows. They are stored,
    because every later step must find them in the same part. Heavy chunks are a table, numbered
    in Spark; only their count and bytes come to the driver.
    """
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    shards = cells.shards_for(facts["b"])
    bits = chunk_bits(facts["n"], facts["b"] or 0)
    rows = rows.select(F.coalesce(F.shiftright("doc_id", bits), F.lit(LAST)).alias("chunk"), "*")
    sizes = rows.groupBy(F.col("chunk").alias("hot")).agg(F.sum(F.octet_length("text") + ROW).alias("size"))
    hot = with_positions(sizes.where(F.col("size") > HEAVY), ["hot"], "hot_at")
    size = hot.agg(F.sum("size")).first()[0]
    if not size:
        return rows, shards
    same = F.col("chunk") == F.col("hot")
    order = ["chunk", "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("text")), "salt"]
    spread = (rows.join(hot, same).withColumn("salt", F.monotonically_increasing_id())
              .repartitionByRange(min(-(-size // PART), MOST_PARTITIONS), *order).sortWithinPartitions(*order))
    # a partition may hold the end of one heavy chunk and the start of the next: numbers tell them apart
    number = F.lit(LAST + 1) + F.shiftleft(F.spark_partition_id() + F.col("hot_at"), PIECE_BITS)
    spread = spread.withColumn("chunk", number).select(*rows.columns)
    parts = stored(spread.mapInArrow(_pieces(PART), spread.schema), "parts")
    return rows.join(hot, same, "left_anti").unionByName(parts), shards


def dedup(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for every row of ``docs`` (doc_id, text).

    ``text`` is the text without the removed words and the white space after them; a text
    that loses nothing stays as it is. Words are runs of bytes other than ASCII white space.
    Null texts have no words and become empty. Rows of one doc_id are taken in order of their
    texts, so of repeated rows the first stays. Rows without doc_id come after all others and
    may repeat words of any. No rows: no rows; extra columns are ignored. doc_ids are expected
    to be fairly dense: 1,024 neighbouring ids are one chunk (fewer where texts are long), or more if they are heavy. Columns named in ``carry`` come
    back in the struct ``carried``.
    """
    if not 0 < phrase <= window:
        raise ValueError("a phrase must fit in a window")
    rows = documents(docs, carry)
    schema = with_carried("doc_id long, n_words long, n_removed long, text string", rows)
    rows, shards = chunked(rows)

    def ask_phrases(t: pa.Table) -> list[tuple[int, int, bytes]]:
        chunk = Chunk(t, window, phrase)
        keys, _, _ = chunk.phrases
        return [(s, chunk.number, cells.pack_keys(keys[at])) for s, at in cells.deal(keys, shards)]

    def candidates(chunk: Chunk, answers: dict[int, bytes]) -> np.ndarray:
        keys, _, count = chunk.phrases
        return chunk.candidates(_flags(list(cells.deal(keys, shards)), answers, len(keys)) | (count > 1))

    def ask_windows(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(t):
            return cells.table([], ("shard", "chunk"))
        chunk = Chunk(t, window, phrase)
        starts = candidates(chunk, dict(zip(replies["shard"].to_pylist(), replies["payload"].to_pylist())))
        high, low = chunk.window_keys(starts)
        order, new, _ = _distinct(high, low)
        high, low = high[order[new]], low[order[new]]
        found = [(s, chunk.number, b"k" + _place(chunk) + _pair(cells.pack_keys(high[at]), cells.pack_planes(low[at])))
                 for s, at in cells.deal(high, shards)]
        # the chunk will need its candidates again: they ride along
        mask = np.zeros(len(chunk.words), bool)
        mask[starts] = True
        ride = b"m" + cells.pack_planes(np.packbits(mask))
        return cells.table([*found, (chunk.number % shards, chunk.number, ride)], ("shard", "chunk"))

    def finish(t: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "text", "carried"]
        chunk, answers, mask = Chunk(t, window, phrase), {}, np.zeros(0, np.int64)
        for shard, payload in zip(replies["shard"].to_pylist(), replies["payload"].to_pylist()):
            if payload[:1] == b"k":
                answers[shard] = payload[1:]
            else:
                bits = cells.unpack_planes(payload[1:], np.uint8)
                mask = np.flatnonzero(np.unpackbits(bits, count=len(chunk.words)))
        high, low = chunk.window_keys(mask)
        order, new, number = _distinct(high, low)
        earlier = _flags(list(cells.deal(high[order[new]], shards)), answers, int(new.sum()))
        again = np.empty(len(mask), bool)
        again[order] = ~new | earlier[number]
        gone = chunk.removed(mask[again])
        n_removed, texts, at = [], [], 0
        for text, words in zip(chunk.texts, chunk.split):
            lost = gone[at: at + len(words)]
            at += len(words)
            n_removed.append(int(lost.sum()))
            texts.append((_cut(text, lost) if n_removed[-1] else text).decode("utf-8", "replace"))
        n_words = [len(w) for w in chunk.split]
        columns = [pa.array(c, k) for c, k in zip(
            (chunk.doc_ids, n_words, n_removed, texts), (pa.int64(),) * 3 + (pa.string(),))]
        return pa.table(columns + chunk.carried, names=names[:4 + len(chunk.carried)])

    by_chunk = rows.groupBy("chunk")
    replies = cells.answer(cells.request(rows, ask_phrases), _answer_phrases)
    asked = by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(ask_windows, cells.CELL)
    settled = cells.answer(asked, _answer_windows)
    return by_chunk.cogroup(settled.groupBy("chunk")).applyInArrow(finish, schema)


def _cut(text: bytes, lost: np.ndarray) -> bytes:
    """The text without the flagged words and the white space after them."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], lost, [False])).astype(np.int8))).tolist()
    places = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in zip(edges[::2], edges[1::2]):
        out.append(text[at: places[a][0]])
        at = places[b][0] if b < len(places) else len(text)
    return b"".join([*out, text[at:]])


def kept_words(text: str = "text"):
    """A text's words joined by one space."""
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
