"""Chat formatting into windows of a token budget.

A turn is written as  ``### role: text </turn>`` and a line break. Backslashes, ``#`` and ``<``
inside texts and roles (and ``:`` in roles) get a backslash before them, so no text can look
like a mark, and taking the backslashes away gives the text back.

A conversation that is longer than the budget becomes several windows. Prefix sums of the
turns' tokens choose how many whole turns fit. Every window after the first repeats the
leading system turn and as many of the last turns as the history limits allow; repeated turns
are outside the loss mask, so every assistant text is a target exactly once. A turn that does
not fit by itself has a window of its own, which is over the budget and says so.

A conversation is dealt into segments of 512 turns, which are formatted side by side: a
conversation with a third of all turns is no single task's, and how turns are numbered, sparsely,
repeatedly or not at all, changes nothing but their order. All turns are dealt to ranges of that
order and numbered there; a turn's place in its conversation is its number in the range and what
earlier ranges hold. A segment gets the system turn and the history it repeats as copies.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import held, stored

BUDGET = 1024
#: Repeated turns before the new ones, at most so many and of so many tokens together.
HISTORY_TURNS, HISTORY_TOKENS = 4, 256
#: 2 ** 9 neighbouring turns are one segment.
SEGMENT_BITS = 9
#: Bits of monotonically_increasing_id that number the rows of a partition.
PLACE_BITS = 33
SYSTEM, TARGET = "system", "assistant"

_TEXT, _ROLE = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]")
_TURN = re.compile(r"### ((?:\\.|[^\\:#<])*): ((?:\\.|[^\\#<])*) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

WINDOWS = ("conv_id long, segment long, window long, n_turns long, n_repeated long, n_tokens long, over boolean, "
           "text string, loss array<struct<start:long,end:long>>")


def escape(text: str) -> str:
    return _TEXT.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and where its escaped text stands in it."""
    head = "### " + _ROLE.sub(r"\\\g<0>", role) + ": "
    body = escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def spans(sizes: list[int], first: int, system: int, inner: int, budget: int, turns: int, tokens: int) -> list[tuple[int, int, int]]:
    """Windows over turns ``first`` .. as (history from, new from, new to).

    ``sizes`` are the turns' tokens, ``system`` those of the system turn that windows repeat,
    but for the first window if that turn is the first of these (``inner`` is 1, else 0).
    Turns before ``first`` can only be history.
    """
    sums = [0, *accumulate(sizes)]
    out, at = [], first
    while at < len(sizes):
        lead = system if at >= inner else 0
        history = min(at, max(at - turns, inner, bisect_left(sums, sums[at] - tokens)))
        end = bisect_right(sums, sums[history] + budget - lead) - 1
        if end <= at:  # history gives way before a turn does
            history = at
            end = max(at + 1, bisect_right(sums, sums[at] + budget - lead) - 1)
        out.append((history, at, end))
        at = end
    return out


def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _tokens(path: str, texts: list[str]) -> list[int]:
    tokenizer = held(("tokenizer", path), lambda: _tokenizer(path))
    return [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _format_segment(conv_id, segment, rows: list[tuple], path: str, budget: int, turns: int, tokens: int) -> list[tuple]:
    """Windows of a segment; rows are (kind, role, text), kind 0 a system copy, 1 history, 2 new."""
    system = [r for r in rows if r[0] == 0][:1]
    own = [r for r in rows if r[0] > 0]
    first = sum(r[0] == 1 for r in own)
    if first == len(own):
        return []
    written = [write_turn(role, text) for _, role, text in [*system, *own]]
    sizes = _tokens(path, [w[0] for w in written])
    if not system and not first and own[0][1] == SYSTEM:
        head, lead = written[0], sizes[0]  # new in the first window, repeated by the others
        inner = 1
    else:
        head, lead = (written[0], sizes[0]) if system else (None, 0)
        written, sizes = written[len(system):], sizes[len(system):]
        inner = 0
    out = []
    for number, (history, at, end) in enumerate(spans(sizes, first, lead, inner, budget, turns, tokens)):
        repeat_head = head is not None and at >= inner
        shown = ([head] if repeat_head else []) + written[history:end]
        text = "".join(w[0] for w in shown)
        before = len(shown) - (end - at)
        place, loss = sum(len(w[0]) for w in shown[:before]), []
        for k in range(at, end):
            whole, a, b = written[k]
            if own[k][1] == TARGET:
                loss.append({"start": place + a, "end": place + b})
            place += len(whole)
        size = sum(sizes[history:end]) + (lead if repeat_head else 0)
        out.append((conv_id, segment, number, end - at + before, before, size, size > budget, text, loss))
    return out


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` with ``position``, their place from 0 in their conversation, and (conv_id, n) of all.

    The dealt turns are stored, because ranges are chosen from a sample. Repeated rows are told
    apart by where they came from, so many of them do not meet in one range.
    """
    order = ["conv_id", "turn", "role", "text", "_from"]
    dealt = turns.withColumn("_from", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.drop("_from").withColumn("place", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("place", PLACE_BITS)
    # a row for each range that a conversation has turns in
    parts = dealt.groupBy("conv_id", part.alias("part")).agg(F.min("place").alias("low"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "low", F.coalesce(before, F.lit(0)).alias("before"))
    rows = dealt.withColumn("part", part)
    rows = rows.join(starts, rows["conv_id"].eqNullSafe(starts["_conv"]) & (F.col("part") == F.col("_part")))
    position = F.col("place") - F.col("low") + F.col("before")
    return (rows.select("conv_id", position.alias("position"), "role", "text"),
            parts.groupBy("conv_id").agg(F.sum("n").alias("n")))


def format_chats(conversations: DataFrame, path: str, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                 history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """Windows of all ``conversations`` (conv_id, turn, role, text), in columns of WINDOWS.

    ``path`` is the tokenizer whose tokens count. ``n_repeated`` turns at the beginning of a
    window are repeated, the rest is new; ``loss`` are the code points of the new assistant
    texts, escaped as they stand. Windows of a conversation are in order of segment and window.
    Null roles and texts are empty. Turns without a number come first; turns with one number
    are in order of role and text; repeated rows are repeated turns; rows without conv_id are
    one conversation. No rows: no rows; extra columns are ignored.
    """
    if not 0 < history_turns < 1 << SEGMENT_BITS:
        raise ValueError("history_turns must be less than a segment")
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role"), text("text"))
    turns, totals = placed(turns)
    turns = turns.withColumn("segment", F.shiftright("position", SEGMENT_BITS))
    columns = ["conv_id", "segment", "kind", "position", "role", "text"]
    new = turns.withColumn("kind", F.lit(2)).select(*columns)
    # the last turns of a segment are history for the next
    late = F.col("position").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1)) >= (1 << SEGMENT_BITS) - history_turns
    history = turns.filter(late).withColumn("kind", F.lit(1)).withColumn("segment", F.col("segment") + 1).select(*columns)
    # the leading turn, for the segments after its own
    lead = turns.filter((F.col("position") == 0) & (F.col("role") == SYSTEM)).drop("segment")
    more = totals.select(F.col("conv_id").alias("k"), F.shiftright(F.col("n") - 1, SEGMENT_BITS).alias("last")).filter("last > 0")
    system = lead.join(more, lead["conv_id"].eqNullSafe(more["k"])).select(
        "conv_id", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("segment"), F.lit(0).alias("kind"), "position", "role", "text")

    names = [f.split()[0] for f in WINDOWS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, nothing = None, [], True
        for batch in batches:
            out = []
            for conv_id, segment, kind, _, role, body in zip(*(c.to_pylist() for c in batch.columns)):
                if nothing or (conv_id, segment) != held:
                    if rows:
                        out += _format_segment(*held, rows, path, budget, history_turns, history_tokens)
                    held, rows, nothing = (conv_id, segment), [], False
                rows.append((kind, role, body))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(names), kinds)], names=names)
        if rows:
            out = _format_segment(*held, rows, path, budget, history_turns, history_tokens)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(names), kinds)], names=names)

    dealt = new.unionByName(history).unionByName(system).repartition("conv_id", "segment")
    return dealt.sortWithinPartitions("conv_id", "segment", "kind", "position").mapInArrow(work, WINDOWS)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_windows long")


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of what the windows hold, one row for each conversation (columns of DIGESTS).

    Windows are parsed in order, one at a time; repeated turns are passed over.
    """
    names = [f.split()[0] for f in DIGESTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    class Reader:
        def __init__(self, conv_id):
            self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
            self.n_turns = self.loss_chars = self.chars = self.windows = 0

        def take(self, text: str, repeated: int, loss: list[dict]) -> None:
            for role, body in read_turns(text)[repeated:]:
                self.turns.update(f"{role}\n{body}\n".encode())
                self.n_turns += 1
            for span in loss:
                body = unescape(text[span["start"]: span["end"]])
                self.loss.update(body.encode())
                self.loss_chars += len(body)
            self.chars += len(text)
            self.windows += 1

        def row(self) -> tuple:
            return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                    self.chars, self.windows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            out = []
            for conv_id, text, repeated, loss in zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "n_repeated", "loss"))):
                if reader is None or conv_id != reader.conv_id:
                    out += [reader.row()] if reader else []
                    reader = Reader(conv_id)
                reader.take(text, repeated, loss)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(names), kinds)], names=names)
        if reader:
            yield pa.record_batch([pa.array([v], k) for v, k in zip(reader.row(), kinds)], names=names)

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.mapInArrow(work, DIGESTS)
