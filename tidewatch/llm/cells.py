"""Chunks of documents that ask shards of keys, and what the shards answer.

Documents are dealt into chunks that fit in a task's memory. A chunk finds its distinct keys
(64-bit hashes of phrases, windows or n-grams), sorts them and deals them out to shards by the
key's remainder. A shard sees the keys of all chunks and answers each chunk in the order of
its keys, so an answer needs no key. A key that every document holds is one entry for each
chunk: no task collects a hot key's occurrences.

Packed keys and answers travel as one binary cell for each chunk and shard, which Spark
partitions, shuffles and sorts like any other row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = "shard long, chunk long, payload binary"
ANSWER = "chunk long, shard long, payload binary"


class WordHashes(dict):
    """XXH64 of the words of a chunk, each made once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring word hashes."""
    size = max(0, len(words) - n + 1)
    value = np.zeros(size, np.uint64)
    for k in range(n):
        value = value * np.uint64(factor) + words[k: k + size]
    return mix(value)


def pack_planes(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, so that high bytes that are zero cost nothing."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_planes(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    planes = planes.reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys as packed differences."""
    return pack_planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(data, np.uint64), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Whole numbers from zero on in the narrowest kind that holds them all."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return kind.char.encode() + pack_planes(counts.astype(kind))


def unpack_counts(data: bytes) -> np.ndarray:
    return unpack_planes(data[1:], np.dtype(data[:1].decode())).astype(np.int64)


def deal(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places) of sorted distinct keys; a shard's places ascend."""
    shard = (keys % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)
    order = np.argsort(shard, kind="stable")  # a radix sort for 16 bits
    found, first = np.unique(shard[order], return_index=True)
    for number, a, b in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        yield number, order[a:b]


def table(rows: list[tuple], names: tuple[str, str]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows) if rows else [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=[*names, "payload"])


def request(chunks: DataFrame, work: Callable[[pa.Table], list[tuple[int, int, bytes]]]) -> DataFrame:
    """Cells (shard, chunk, payload) of every chunk of ``chunks``."""
    return chunks.groupBy("chunk").applyInArrow(lambda t: table(work(t), ("shard", "chunk")), CELL)


def answer(cells: DataFrame, work: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """Answers (chunk, shard, payload); ``work`` gets a shard's chunks, ascending, and payloads."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("chunk")
        chunks, shard = t["chunk"].to_pylist(), t["shard"][0].as_py()
        return table([(c, shard, p) for c, p in zip(chunks, work(chunks, t["payload"].to_pylist()))], ("chunk", "shard"))

    return cells.groupBy("shard").applyInArrow(run, ANSWER)


def shards_for(size: int | None, bytes_each: int = 16 << 20) -> int:
    """Shards so that each sees the keys of about ``bytes_each`` bytes of text."""
    return max(1, -(-(size or 0) // bytes_each))


def shard_count(docs: DataFrame) -> tuple[int, int, int]:
    """(rows, bytes, shards) of a table of texts."""
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    return facts["n"], facts["b"] or 0, shards_for(facts["b"])
