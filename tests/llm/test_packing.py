from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewatch.llm import packing
from tidewatch.llm.queries import op2_packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part string, ids int"


def true_ids(texts, path=PATH):
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [x.ids + [1] for x in found]


def check(rows, wanted, size):
    """Pieces cover every document once and lie in sequences without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(wanted)
    for doc_id, found in by_doc.items():
        ids, at = wanted[doc_id], 0
        for r in sorted(found, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            piece = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece)
            at += r.length
        assert at == len(ids)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    tokens = sum(map(len, wanted.values()))
    return len(by_sequence) * size / tokens - 1


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip((r.doc_id for r in docs), true_ids([r.text for r in docs])))
    assert check(op2_packing(spark, "/root/testdata/sf0.01").collect(), wanted, 2048) < 0.01


@pytest.mark.parametrize("fill", [True, False])
def test_odd_rows(spark, fill):
    texts = {1: None, 2: "", 3: " \t\n", 4: "word " * 9000, 5: "a\x1cb \xa0 <|endoftext|>x Éé́ ΑΣ Σ", None: "no id", 7: "日本語 x"}
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in texts.items()], SCHEMA)
    found = packing.pack(frame, PATH, 64, fill=fill).selectExpr("*", "crc32(ids) ids_crc32").collect()
    check(found, dict(zip(texts, true_ids(texts.values()))), 64)
    assert packing.pack(frame.limit(0), PATH).count() == 0
    twice = packing.pack(frame.union(frame), PATH, 64, fill=fill)
    assert twice.agg({"length": "sum"}).first()[0] == 2 * sum(map(len, true_ids(texts.values())))


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.Encoder(path).by_word and packing.Encoder(PATH).by_word
    frame = spark.createDataFrame([(1, "Two  words\n here", "x", 1)], SCHEMA)
    found = packing.pack(frame, path).selectExpr("*", "crc32(ids) ids_crc32").collect()
    check(found, {1: true_ids(["Two  words\n here"], path)[0]}, 2048)


def test_words_by_parts_equal_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_BYTES", 20_000)  # forgets all the time
    parts = ("aAbBzZ é É ñ ß İ I ̇ ̱ H h K 's 'T 're , . ! ( ) - _ | < > <|endoftext|> <|EndOfText|> * $ 1 2 日 😀 Σ σ ς "
             "\t \n \x1c \xa0 ́ ing tion THE жизнь Ǆ ﬁ ا").split(" ") + [" "] * 4
    draw, encoder = random.Random(5), packing.Encoder(PATH)
    texts = ["".join(draw.choices(parts, k=draw.randrange(0, 14))) for _ in range(4000)]
    assert [encoder.encode([t.encode()])[0] for t in texts] == encoder._ids(texts)
    assert encoder.folds and encoder.splits and encoder.direct


def test_best_fit_decreasing_against_a_plain_search():
    draw = random.Random(1)
    for _ in range(50):
        lengths = [draw.randrange(1, 33) for _ in range(draw.randrange(0, 60))]
        windows, rooms = [], []
        for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fit = [r for r in rooms if r >= lengths[k]]
            if fit:
                w = rooms.index(min(fit))
            else:
                w = len(rooms)
                rooms.append(32)
            rooms[w] -= lengths[k]
        found = packing.best_fit_decreasing(lengths, 32)
        assert sorted(k for w in found for k in w) == list(range(len(lengths)))
        assert sorted(32 - sum(lengths[k] for k in w) for w in found) == sorted(rooms)
        topped = packing.top_up([[(k, 0, lengths[k]) for k in w] for w in found], 32)
        assert sum(sum(b - a for _, a, b in w) < 32 for w in topped) <= 1


def test_sequences_join_pieces(spark):
    frame = spark.createDataFrame([(k, f"text number {k}", "x", 1) for k in range(9)], SCHEMA)
    packed = packing.pack(frame, PATH, 16)
    rows = packing.sequences(packed).collect()
    assert sum(r.length for r in rows) == packed.agg({"length": "sum"}).first()[0]
    assert all(len(r.ids) == 4 * r.length == 4 * sum(s.length for s in r.segments) for r in rows)


def test_a_part_of_one_repeated_row_is_packed_in_portions():
    import pyarrow as pa

    rows = 16 * packing.PART_DOCS + 5
    ids = np.array([7, 1], "<u4").tobytes()
    columns = [[3] * rows, [5] * rows, [0] * rows, [2] * rows, [ids] * rows]
    kinds = (pa.int64(),) * 4 + (pa.binary(),)
    batch = pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "doc_id", "start", "doc_tokens", "ids"])
    out = pa.Table.from_batches(packing._pack(16, True)(iter([batch.slice(0, 9000), batch.slice(9000)]))).to_pylist()
    assert sum(r["length"] for r in out) == 2 * rows
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for found in by_sequence.values():
        ends = [(r["offset"], r["offset"] + r["length"]) for r in sorted(found, key=lambda r: r["offset"])]
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] <= 16
    assert sum(sum(r["length"] for r in f) < 16 for f in by_sequence.values()) <= 2
