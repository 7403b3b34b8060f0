"""Language-model scores from an Elias-Fano n-gram trie.

The model is an n-gram model (order three unless told otherwise) over the words of all training
documents. Each order is smoothed by the one below it, which counts as a prior of a fixed number
of observations: a word after a context has probability

    (c(context word) + prior * p(word after the context less its first word)) / (c(context) + prior)

and the lowest order is the add-one unigram probability. After an unseen context this is the
shorter context's probability; at the start of a text contexts are as long as the text so far.

Counting: documents are dealt into chunks. A chunk sends its distinct n-grams of every order as
sorted hash keys with their counts in training documents to shards, which add up the counts of
all chunks and answer each chunk with the totals of its keys (cells.py). So the counts cover the
whole corpus, grow with it, and no task or driver holds them all.

Scoring: from its totals a chunk builds the part of the trie that its documents can ask for.
Level one holds word keys; level n holds the words after each context of n - 1 words. Levels are
chained by place: monotone pointers lead from a context's place to its successors. A successor is
numbered relative to the shorter context (its place among the words that follow the context less
its first word), which keeps numbers small. Pointers and successors are Elias-Fano coded, probabilities and
back-off weights quantised to 16 bits, and all levels lie in one memory-mapped file. An n-gram is
looked up by successor search among its context's range only.

Word keys are 64-bit hashes: among ten million words the chance that any two share one is 3 in
a million. Keys of longer n-grams have 18 bits more than it takes to count the corpus's bytes, so
fewer than one in a million shares its key with another (up to 64 TB of text; beyond that 64 bits
are all there are); such n-grams would pool their counts.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import cells
from .common import documents

#: Documents of one chunk.
CHUNK_DOCS = 1024
#: Bytes of text in a chunk, on average, at most: long documents make more chunks.
CHUNK_BYTES = 8 << 20
#: Rows that are one row repeated more often than this, or than a 100,000th of all, are counted first.
COPIES = 256
#: Words of the longest n-gram.
ORDER = 3
#: Observations that the order below counts as: for pairs, and for each longer order.
PRIORS = (1000.0, 3.0)
#: Key of the end of a text, which no word's hash is taken for.
END = np.uint64(0x9AE16A3B2F90404F)
#: Searches made at once.
BLOCK = 1 << 14
#: Quantised log10 probabilities lie between -FLOOR and 0.
FLOOR, STEPS = 24.0, 65535


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / n) bits a value.

    Values are split into low bits, packed, and high parts, which are set bits in a unary
    bit vector; ``ones`` counts the set bits before each of its words.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(63, max(0, (top // max(n, 1)).bit_length() - 1))
        wide = np.uint64(low_bits)
        low = cls._pack(values & ((np.uint64(1) << wide) - np.uint64(1)), low_bits)
        high = (values >> wide).astype(np.int64)
        bits = np.zeros(-(-(n + (int(high[-1]) if n else 0) + 2) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(n, low_bits, low, words, cls._ones(words))

    @staticmethod
    def _ones(words: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        """Values of ``width`` bits, one after another, and a spare word."""
        out = np.zeros(-(-len(values) * width // 64) + 2, np.uint64)
        if width and len(values):
            at = np.arange(len(values), dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(out, word, values << shift)
            spill = np.where(shift > 0, values >> ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
            np.bitwise_or.at(out, word + 1, spill)
        return out

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        value = self.low[word] >> shift
        spill = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (value | spill) & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))

    def _select(self, rank: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the set (or unset) bit with that rank."""
        before = 64 * np.arange(len(self.ones)) - self.ones if zeros else self.ones
        word = np.searchsorted(before, rank, "right") - 1
        left = rank - before[word]
        value = ~self.high[word] if zeros else np.array(self.high[word])
        place = 64 * word
        for width in (32, 16, 8, 4, 2, 1):  # halve the word that holds the bit
            half = value & np.uint64((1 << width) - 1)
            count = np.bitwise_count(half).astype(np.int64)
            above = left >= count
            left = np.where(above, left - count, left)
            place = np.where(above, place + width, place)
            value = np.where(above, value >> np.uint64(width), half)
        return place

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values by place."""
        i = np.asarray(i, np.int64)
        high = (self._select(i, False) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self.low_at(i)

    def all(self) -> np.ndarray:
        """All values, in order."""
        places = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[:self.n]
        i = np.arange(self.n)
        return (places - i).astype(np.uint64) << np.uint64(self.low_bits) | self.low_at(i)

    def _next_zero(self, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the unset bit with that rank, given the one before it."""
        free = ~self.high[place >> 6] & ~((np.uint64(2) << (place & 63).astype(np.uint64)) - np.uint64(1))
        lowest = free & (~free + np.uint64(1))
        out = (place & ~63) + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
        far = np.flatnonzero(free == 0)  # not in the same word
        out[far] = self._select(rank[far], True)
        return out

    def _search(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least place in [first, last) with at least that value, or last; end of those with its high part; its low part."""
        high = value >> np.uint64(self.low_bits)
        top = np.uint64(64 * len(self.high) - self.n - 1)
        over = high > top
        high = np.minimum(high, top).astype(np.int64)
        # values with a smaller high part come before the zero that ends them
        before = self._select(np.maximum(high - 1, 0), True)
        begin = np.where(high > 0, before - (high - 1), 0)
        end = np.where(high > 0, self._next_zero(before, high), before) - high
        low, up = np.clip(begin, first, last), np.clip(end, first, last)
        low[over] = last[over]
        up[over] = last[over]
        stop = up.copy()
        wanted = value & ((np.uint64(1) << np.uint64(self.low_bits)) - np.uint64(1))
        open_ = np.flatnonzero(low < up)
        while len(open_):
            mid = (low[open_] + up[open_]) >> 1
            less = self.low_at(mid) < wanted[open_]
            low[open_[less]] = mid[less] + 1
            up[open_[~less]] = mid[~less]
            open_ = open_[low[open_] < up[open_]]
        return low, np.where(over, low, stop), wanted

    def successor(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least place in [first, last) with at least that value, or last."""
        return self._search(value, first, last)[0] if self.n else last

    def find(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least place in [first, last) of exactly that value, or -1: its successor, if that has its bits."""
        if not self.n:
            return np.full(len(value), -1)
        out = np.full(len(value), -1)
        order = np.argsort(value)
        for begin in range(0, len(order), BLOCK):  # neighbours together, in pieces that stay in the cache
            some = order[begin: begin + BLOCK]
            place, end, wanted = self._search(value[some], first[some], last[some])
            found = (place < end) & (self.low_at(np.minimum(place, self.n - 1)) == wanted)
            out[some[found]] = place[found]
        return out


def quantise(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * (STEPS / FLOOR)), 0, STEPS).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (-FLOOR / STEPS)


class Trie:
    """Levels of n-grams in one memory-mapped file.

    ``words`` are sorted distinct keys. ``levels`` describe the n-grams of two words, three words
    and so on: (place of the context, place of the n-gram less its first word), both in the level
    below, in any order but distinct. ``scores`` are the log10 probabilities of each level's
    entries in the order given, ``backoffs`` their log10 weights as contexts (not of the last).
    """

    def __init__(self, words: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]],
                 scores: list[np.ndarray], backoffs: list[np.ndarray]):
        self.n = [len(words)]
        self.bases: list[np.uint64] = []
        parts = [EliasFano.build(words)]
        sorted_to = np.arange(len(words))  # where the level below put its entries
        contexts, edges = None, None       # contexts of that level by place, and where successors begin
        codes = [quantise(scores[0])]
        weights = [quantise(backoffs[0])] if backoffs else []
        for k, (context, tail) in enumerate(levels):
            context, tail = sorted_to[context], sorted_to[tail]
            follower = tail if edges is None else tail - edges[contexts[tail]]
            base = int(follower.max(initial=0)) + 1
            value = context * base + follower
            order = np.argsort(value)
            edges = np.concatenate(([0], np.cumsum(np.bincount(context, minlength=self.n[-1]))))
            parts += [EliasFano.build(edges.astype(np.uint64)), EliasFano.build(value[order].astype(np.uint64))]
            self.bases.append(np.uint64(base))
            self.n.append(len(context))
            contexts = context[order]
            sorted_to = np.empty(len(order), np.int64)
            sorted_to[order] = np.arange(len(order))
            codes.append(quantise(scores[k + 1][order]))
            if k + 1 < len(backoffs):
                weights.append(quantise(backoffs[k + 1][order]))
        arrays = self._mapped([a for p in parts for a in (p.low, p.high, p.ones)] + codes + weights)
        coded = [EliasFano(p.n, p.low_bits, *arrays[3 * k: 3 * k + 3]) for k, p in enumerate(parts)]
        self.words, self.pointers, self.followers = coded[0], coded[1::2], coded[2::2]
        rest = arrays[3 * len(parts):]
        self.scores, self.backoffs = rest[:len(codes)], rest[len(codes):]

    @staticmethod
    def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
        """Arrays as views of a memory-mapped file, which goes when the views go."""
        with tempfile.TemporaryFile() as file:
            places = []
            for a in arrays:
                file.write(b"\0" * (-file.tell() % 8))
                places.append(file.tell())
                file.write(a.tobytes())
            file.write(b"\0" * 8)
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        return [whole[p: p + a.nbytes].view(a.dtype) for p, a in zip(places, arrays)]

    def find_words(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys in level one; -1 for words that are not there."""
        return self.words.find(keys, np.zeros(len(keys), np.int64), np.full(len(keys), self.words.n))

    def edges(self, level: int) -> np.ndarray:
        """Where the successors of each entry begin in ``level`` (2 and up), and the end of the last."""
        return self.pointers[level - 2].all().astype(np.int64)

    def find(self, level: int, context: np.ndarray, follower: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Places in ``level`` of successors numbered relative to the shorter context; -1 if not there."""
        wanted = follower.astype(np.uint64) + context.astype(np.uint64) * self.bases[level - 2]
        # a number beyond the largest one would stand for another context's, outside the range
        return self.followers[level - 2].find(wanted, edges[context], edges[context + 1])


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and the place of every value among them."""
    code, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    return found[order], rank[code]


def _tokens(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of the words and END, ascending; the place of every token's; tokens of every text.

    Arrow lower-cases and splits in one pass each and numbers the words, so a word is hashed once.
    """
    lower = pc.ascii_lower(pc.cast(texts, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True)))
    parts = pc.ascii_split_whitespace(lower)
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    coded = pc.list_flatten(parts).dictionary_encode().combine_chunks()
    if isinstance(coded, pa.ChunkedArray):  # no words at all, or none in one piece
        coded = pa.concat_arrays(coded.chunks)
    number = coded.indices.to_numpy()
    words = pc.cast(coded.dictionary, pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    real = np.fromiter(map(len, words), np.int64, len(words)) > 0  # empty before leading white space
    keep = real[number]
    if not keep.all():
        text, number = text[keep], number[keep]
    counts = np.bincount(text, minlength=len(texts)) + 1
    numbers = np.full(len(number) + len(texts), len(words), np.int32)  # END where no word goes
    numbers[np.arange(len(number)) + text] = number
    keys, rank = np.unique(np.append(np.where(real, hashes, END), END), return_inverse=True)
    return keys, rank.astype(np.int32)[numbers], counts


class Level:
    """A chunk's distinct n-grams of one length.

    ``keys`` ascend; ``ends`` are the tokens at which an n-gram ends and ``at`` (by end) the place
    of that n-gram among the keys; ``context`` and ``tail`` are the places, one level below, of an
    n-gram without its last and without its first word.
    """

    def __init__(self, keys: np.ndarray, at: np.ndarray, ends: np.ndarray, below: Level | None):
        self.keys, self.at, self.ends = keys, at, ends
        if len(ends) and below is not None:
            place = np.empty(len(keys), np.int64)
            place[at] = ends  # any of an n-gram's places
            self.context, self.tail = below.by_token[place - 1], below.by_token[place]
        else:
            self.context = self.tail = np.zeros(0, np.int64)

    def spread(self, tokens: int) -> None:
        """Places by token, for the level above."""
        self.by_token = np.zeros(tokens, np.int32)
        self.by_token[self.ends] = self.at


class Chunk:
    """A chunk's tokens, word keys and an END for every document, and their n-grams up to ``order``."""

    def __init__(self, rows: pa.Table, order: int, key_bits: int):
        self.number = rows["chunk"][0].as_py()
        self.doc_ids = rows["doc_id"].to_pylist()
        self.held_out = np.array(rows["held_out"].to_pylist(), bool)
        self.copies = rows["copies"].to_numpy().astype(np.int64)
        keys, words_at, self.counts = _tokens(rows["text"])
        self.tokens = keys[words_at]
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.starts = np.cumsum(self.counts) - self.counts
        place = np.arange(len(self.tokens)) - self.starts[self.doc]
        self.levels = [Level(keys, words_at, np.arange(len(self.tokens)), None)]
        hashes = self.tokens
        for n in range(2, order + 1):
            self.levels[-1].spread(len(self.tokens))
            hashes = np.concatenate((hashes[:1], cells.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.tokens[1:])))
            ends = np.flatnonzero(place >= n - 1)
            self.levels.append(Level(*_distinct(hashes[ends] >> np.uint64(64 - key_bits)), ends, self.levels[-1]))

    def trained(self) -> list[np.ndarray]:
        """Counts of every level's n-grams in training documents."""
        times = np.where(self.held_out, 0, self.copies)[self.doc]
        return [_sums(level.at, times[level.ends], len(level.keys)) for level in self.levels]


def _sums(at: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """The sum of ``times`` at each place; exact, also where whole numbers have over 53 bits."""
    if not len(times) or times.max() <= 1:
        return np.bincount(at[times > 0], minlength=size)
    total = np.zeros(size, np.int64)
    np.add.at(total, at, times)
    return total


def _ask(shards: int, order: int, key_bits: int):
    """Cells of words (shards 0 ..), of pairs (shards behind those), and so on."""
    def work(rows: pa.Table) -> list[tuple[int, int, bytes]]:
        chunk = Chunk(rows, order, key_bits)
        out = []
        for level, (grams, counts) in enumerate(zip(chunk.levels, chunk.trained())):
            rest = grams.keys // np.uint64(shards)  # the remainder is the shard's number
            for shard, at in cells.deal(grams.keys, shards):
                a, b = cells.pack_keys(rest[at]), cells.pack_counts(counts[at])
                out.append((level * shards + shard, chunk.number, len(a).to_bytes(4, "little") + a + b))
        return out

    return work


def _counts(payloads: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys of every payload, the place of each among the distinct keys, and those keys' counts."""
    keys, counts = [], []
    for p in payloads:
        n = 4 + int.from_bytes(p[:4], "little")
        keys.append(cells.unpack_keys(p[4:n]))
        counts.append(cells.unpack_counts(p[n:]))
    place, found = pd.factorize(np.concatenate(keys))
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return keys, place, total


def _totals(chunks: list[int], payloads: list[bytes]) -> list[bytes]:
    """The sums of all chunks' counts for every chunk's keys."""
    keys, place, total = _counts(payloads)
    replies = np.split(total[place], np.cumsum([len(k) for k in keys])[:-1])
    return [cells.pack_counts(r) for r in replies]


def _facts(shards: int):
    """Trained words and tokens of a shard of words; nothing of a shard of longer n-grams."""
    def work(t: pa.Table) -> pa.Table:
        types = tokens = 0
        if t["shard"][0].as_py() < shards:
            _, _, total = _counts(t["payload"].to_pylist())
            types, tokens = int((total > 0).sum()), int(total.sum())
        return pa.table([pa.array([types], pa.int64()), pa.array([tokens], pa.int64())], names=["types", "tokens"])

    return work


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double, copies long")


def _log_model(chunk: Chunk, counts: list[np.ndarray], size: int, priors: list[float]) -> np.ndarray:
    """log10 probability of every token, read from the trie of the n-grams that training texts hold."""
    for k, level in enumerate(chunk.levels[1:], 1):  # a count whose context has none is another n-gram's
        counts[k] = counts[k] * ((counts[k - 1][level.context] > 0) & (counts[k - 1][level.tail] > 0))
    seen = [np.flatnonzero(c) for c in counts]
    renumbered = [np.cumsum(c > 0) - 1 for c in counts]
    p = [(counts[0] + 1.0) / size]
    for level, c, below, prior in zip(chunk.levels[1:], counts[1:], counts, priors):
        p.append((c + prior * p[-1][level.tail]) / (below[level.context] + prior))
    entries = [(renumbered[k][level.context[seen[k + 1]]], renumbered[k][level.tail[seen[k + 1]]])
               for k, level in enumerate(chunk.levels[1:])]
    backoffs = [np.log10(prior / (c[s] + prior)) for c, s, prior in zip(counts, seen, priors)]
    trie = Trie(chunk.levels[0].keys[seen[0]], entries, [np.log10(x[s]) for x, s in zip(p, seen)], backoffs)

    at = trie.find_words(chunk.levels[0].keys)
    log10 = np.where(at >= 0, _codes(trie.scores[0], at), -np.log10(size))
    token = log10[chunk.levels[0].at]
    edges = begin = None  # begin: where the successors of an n-gram's context start, by n-gram
    for n, level in enumerate(chunk.levels[1:], 2):
        context, tail = at[level.context], at[level.tail]
        follower = tail if begin is None else tail - begin[level.tail]
        edges = trie.edges(n)
        asked = np.flatnonzero((context >= 0) & (tail >= 0))
        place = np.full(len(context), -1)
        place[asked] = trie.find(n, context[asked], follower[asked], edges)
        begin = edges[np.maximum(context, 0)]
        shorter = log10[level.tail] + np.where(context >= 0, _codes(trie.backoffs[n - 2], context), 0.0)
        log10, at = np.where(place >= 0, _codes(trie.scores[n - 1], place), shorter), place
        token[level.ends] = log10[level.at]
    return token


def _codes(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values at places; anything where there is no place."""
    return dequantise(codes[np.maximum(at, 0)]) if len(codes) else np.zeros(len(at))


def _score(shards: int, order: int, key_bits: int, priors: list[float]):
    def place(level: int, keys: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for shard, at in cells.deal(keys, shards):
            out[at] = cells.unpack_counts(answers[level * shards + shard])
        return out

    def work(rows: pa.Table, replies: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in SCORES.split(", ")]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
        if not len(rows):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        chunk = Chunk(rows, order, key_bits)
        types, tokens = replies["types"][0].as_py(), replies["tokens"][0].as_py()
        answers = dict(zip(replies["shard"].to_pylist(), replies["payload"].to_pylist()))
        counts = [place(k, level.keys, answers) for k, level in enumerate(chunk.levels)]
        size = tokens + types + 1
        words = chunk.levels[0].at
        add = lambda values: np.add.reduceat(values, chunk.starts)
        columns = [chunk.doc_ids, chunk.held_out, chunk.counts, add((counts[0] > 0)[words].astype(np.int64)),
                   np.full(len(chunk.counts), tokens), add(np.log10((counts[0] + 1.0) / size)[words]),
                   add(_log_model(chunk, counts, size, priors)), chunk.copies]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return work


def score(docs: DataFrame, order: int = ORDER, priors: Sequence[float] = PRIORS) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text) under the model of the training rows.

    Learns from rows whose crc32(doc_id as text) mod 7 is not 2; the others, and rows without
    doc_id, are held out. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-one unigram) and score, log10 of the text's probability under n-grams of up to ``order``
    words. ``priors`` are the priors of two words, three words and so on; the last one is also
    that of all longer n-grams. Null texts are empty: one token, the end. Repeated rows count and
    are scored each (rows repeated very often once for all); without training rows all tokens
    are unknown; no rows: no rows; extra columns are ignored.
    """
    if order < 1 or not priors or min(priors) <= 0:
        raise ValueError("order is a positive number, priors are positive numbers")
    priors = [float(priors[min(k, len(priors) - 1)]) for k in range(order - 1)]
    rows = documents(docs)
    n, size, shards = cells.shard_count(rows)
    chunks = max(1, -(-n // CHUNK_DOCS), -(-size // CHUNK_BYTES))
    key_bits = min(64, 18 + size.bit_length())
    key = F.xxhash64("doc_id", "text")
    often = rows.groupBy(key.alias("often")).count().filter(F.col("count") > max(COPIES, n // 100_000))
    often = [r["often"] for r in often.select("often").collect()]
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if often:
        few = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in often], "often long"))
        counted = rows.join(few, key == F.col("often"), "left_semi").groupBy("doc_id", "text").agg(F.sum("copies").alias("copies"))
        rows = rows.join(few, key == F.col("often"), "left_anti").unionByName(counted)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True))
    rows = rows.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk"), "doc_id", held.alias("held_out"), "text", "copies")
    asked = cells.request(rows, _ask(shards, order, key_bits))
    # one row; the shards' cells are shuffled once for both uses
    facts = asked.groupBy("shard").applyInArrow(_facts(shards), "types long, tokens long").agg(
        F.sum("types").alias("types"), F.sum("tokens").alias("tokens"))
    replies = cells.answer(asked, _totals).crossJoin(F.broadcast(facts))
    scores = rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_score(shards, order, key_bits, priors), SCORES)
    if often:
        scores = scores.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("_")
    return scores.drop("copies")
