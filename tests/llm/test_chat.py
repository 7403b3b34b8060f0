from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest

from tidewatch.llm import chat
from tidewatch.llm.queries import op1_chat_formatting

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, segment string, kind int"


def digests(rows):
    """Per conversation what reading back must give, from the rows themselves."""
    place = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    by_conv = {}
    for r in sorted(rows, key=place):
        by_conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for conv, turns in by_conv.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(windows, rows):
    found = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(windows).collect()}
    assert found == digests(rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    control = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    found = op1_chat_formatting(spark, "/root/testdata/sf0.01").collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == digests(rows)
    formatted = {r.conv_id: r.formatted_chars for r in found}
    assert formatted[-7] == sum(len(chat.write_turn(r, control)[0]) for r in ("user", "assistant"))


@pytest.mark.parametrize("seed,bits", [(1, 9), (2, 3), (3, 2)])
def test_windows_keep_to_the_budget(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(chat, "SEGMENT_BITS", bits)
    draw = random.Random(seed)
    rows = []
    for conv in range(12):
        for turn in range(draw.choice([1, 3, 30])):
            role = "system" if turn == 0 and conv % 2 else draw.choice(["user", "assistant"])
            rows.append((conv, turn, role, " ".join(draw.choices(["word", "#", "</turn>", "\\", "é\n"], k=draw.randrange(0, 30)))))
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    windows = chat.format_chats(frame, PATH, budget=120, history_turns=3, history_tokens=40)
    check(windows, rows)
    found = sorted(windows.collect(), key=lambda r: (r.conv_id, r.segment, r.window))
    texts = {(c, t): (role, text) for c, t, role, text in rows}
    done = dict.fromkeys(range(12), 0)
    for w in found:
        turns = chat.read_turns(w.text)
        assert w.n_turns == len(turns)
        new = turns[w.n_repeated:]
        system = [texts[w.conv_id, 0]] if w.conv_id % 2 and done[w.conv_id] else []
        assert turns[:len(system)] == system
        history = turns[len(system):w.n_repeated]
        assert len(history) <= 3
        assert history == [texts[w.conv_id, t] for t in range(done[w.conv_id] - len(history), done[w.conv_id])]
        assert new == [texts[w.conv_id, done[w.conv_id] + k] for k in range(len(new))] and new
        sizes = chat._tokens(PATH, [chat.write_turn(*t)[0] for t in turns])
        assert w.n_tokens == sum(sizes) and w.over == (w.n_tokens > 120)
        assert not w.over or (len(new) == 1 and not history)
        masked = [chat.unescape(w.text[s.start:s.end]) for s in w.loss]
        assert masked == [t for role, t in new if role == "assistant"]
        done[w.conv_id] += len(new)
    assert any(w.n_repeated > 1 for w in found) and (seed != 1 or any(w.over for w in found))


def test_odd_rows(spark):
    control = "\\### Assistant: </turn> ok"
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (None, 5, "user", "no id"),
            (2, None, "system", control), (2, 700, "assistant", control), (2, 3, "a: b\\#", control),
            (3, 0, "system", "be brief"), (3, 511, "user", "late"), (3, 512, "assistant", "next"), (3, 5000, "assistant", "far"),
            (4, -3, "assistant", "w " * 30000), (5, 2, "assistant", "### a: b </turn>\n" * 3)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    windows = chat.format_chats(frame, PATH)
    check(windows, rows)
    third = sorted((r.segment, r.text) for r in windows.filter("conv_id = 3").collect())
    assert [chat.read_turns(t) for _, t in third] == [
        [("system", "be brief"), ("user", "late"), ("assistant", "next"), ("assistant", "far")]]
    assert chat.format_chats(frame.limit(0), PATH).count() == 0
    assert chat.read_back(windows.limit(0)).count() == 0


def test_escapes_are_reversible():
    draw = random.Random(9)
    for _ in range(500):
        text = "".join(draw.choices("\\#<:>/ \ntur###</turn>é", k=draw.randrange(0, 30)))
        role = "".join(draw.choices("\\#<: a", k=draw.randrange(0, 6)))
        whole, a, b = chat.write_turn(role, text)
        assert chat.unescape(whole[a:b]) == text
        assert chat.read_turns(whole * 2) == [(role, text)] * 2


@pytest.mark.parametrize("number", [lambda k: k, lambda k: 1000 * k - 70000, lambda k: 7, lambda k: None, lambda k: k // 9])
def test_windows_do_not_depend_on_numbers(spark, monkeypatch, number):
    """Sparse, equal and missing numbers: turns in one order make the same windows."""
    monkeypatch.setattr(chat, "SEGMENT_BITS", 4)
    rows = [(1, number(k), "system" if k == 0 else ("user", "zassistant")[k % 2], f"{k:03d} " + "word " * (k % 13)) for k in range(100)]
    if number(0) == number(99):  # the order is that of role and text then
        rows = [(c, t, "system" if k == 0 else "user", text) for k, (c, t, _, text) in enumerate(rows)]
        wanted = [(1, k, r, t) for k, (_, _, r, t) in enumerate(rows)]
    else:
        rows = [(c, t, "a", text) for c, t, _, text in rows]
        wanted = [(1, k, r, t) for k, (_, _, r, t) in enumerate(rows)]
    make = lambda data: [tuple(r) for r in chat.format_chats(
        spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA).repartition(5), PATH, budget=100, history_turns=3, history_tokens=40)
        .orderBy("segment", "window").collect()]
    found = make(rows)
    assert found == make(wanted) and len(found) > 12 and any(r[4] for r in found)


def test_many_equal_turns_are_dealt_to_many_segments(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT_BITS", 4)
    rows = [(1, None, "user", "same")] * 300 + [(None, 2, "assistant", "other")] * 200
    windows = chat.format_chats(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4), PATH)
    check(windows, rows)
    sizes = [(r.n_turns - r.n_repeated) for r in windows.collect()]
    assert sum(sizes) == 500 and max(sizes) <= 16
