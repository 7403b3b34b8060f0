"""Seeded samples that are exact in size, repeatable, and independent of partitioning.

A row's place in the draw is ``md5(seed|row_id)``; the sample of size *k* is the *k*
smallest. Instead of sorting, the *k*-th smallest hash is located with a few counting
passes over hash prefixes, each of which returns at most 4,096 counters per sample, until
one row is left under the prefix. The sample is then simply ``hash <= threshold``: a
row-local filter that needs no sort, no join and no list of row ids, whether it takes fifty
rows or half of the table.

Row ids must be unique (the landing step stamps them). Should the boundary of a sample fall
among rows of one id, no hash tells them apart, and the draw says so.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ranking import with_positions

PREFIX_DIGITS = 3  # 4,096 counters a pass and sample
HASH_DIGITS = 32


def draw_hash(seed: int | str, row_id: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_id).cast("string")))


@dataclass(frozen=True)
class Draw:
    """One sample to take: ``size`` of the ``population`` rows that are ``eligible``."""

    name: str
    seed: int
    size: int
    population: int
    eligible: Column | None = None


#: What a counting pass looks at: rows of one hash order, of one kind, under one prefix.
Place = tuple[int, int, str]


def _place(draw: Draw, prefix: str) -> Place:
    return draw.seed, id(draw.eligible), prefix


def _orders(frame: DataFrame, draws: Sequence[Draw], row_id: str) -> tuple[DataFrame, dict[tuple[int, int], str]]:
    """``frame`` with one hash column for each order and kind of rows, null for other rows.

    Hashes and conditions are evaluated once a row, however many draws share them.
    """
    columns, names = [], {}
    for draw in draws:
        order = _place(draw, "")[:2]
        if order not in names:
            names[order] = f"_h{len(names)}"
            value = draw_hash(draw.seed, row_id)
            value = value if draw.eligible is None else F.when(draw.eligible, value)
            columns.append(value.alias(names[order]))
    return frame.select(*columns), names


def _matching(places: dict[Place, Draw], names: dict[tuple[int, int], str], depth: int) -> Column:
    """A struct (place, digits) for each place; null where the row is not under its prefix of ``depth`` digits."""
    items = []
    for number, (*order, prefix) in enumerate(places):
        value = F.col(names[tuple(order)])
        digits = F.substring(value, depth + 1, PREFIX_DIGITS)
        items.append(F.when(value.startswith(prefix), F.struct(F.lit(number).alias("place"), digits.alias("digits"))))
    return F.explode(F.array(*items))


def draw_thresholds(frame: DataFrame, draws: Sequence[Draw], row_id: str) -> dict[str, str]:
    """The largest hash that still belongs to each sample, for all samples at once.

    Only ids and the columns of the eligibility conditions are read. The number of passes
    grows with the logarithm of the row count: about two for a million rows, four for a
    trillion. Ids that repeat across a boundary raise ``ValueError``.
    """
    thresholds: dict[str, str] = {}
    prefixes, rank, width = {}, {}, {}
    for draw in draws:
        if draw.size <= 0:
            thresholds[draw.name] = ""
        elif draw.size >= draw.population:
            thresholds[draw.name] = "g"  # above every hexadecimal digit: takes all
        else:
            prefixes[draw.name], rank[draw.name], width[draw.name] = "", draw.size, draw.population

    while True:
        # a prefix whose rows all belong to the sample needs no further digits
        wide = [d for d in draws if d.name in prefixes and rank[d.name] < width[d.name]]
        if not wide:
            break
        if any(len(prefixes[d.name]) >= HASH_DIGITS for d in wide):
            raise ValueError(f"repeated values of {row_id} at the boundary of a sample")
        depths = {len(prefixes[d.name]) for d in wide}
        depth = min(depths)
        wide = [d for d in wide if len(prefixes[d.name]) == depth]
        # draws that look at the same rows share their counters
        places = {_place(d, prefixes[d.name]): d for d in wide}
        numbers = {place: number for number, place in enumerate(places)}
        counted: list[list] = [[] for _ in places]
        hashed, names = _orders(frame, wide, row_id)
        for row in (
            hashed.select(_matching(places, names, depth).alias("m")).where("m is not null")
            .groupBy("m.place", "m.digits")
            .count()
            .collect()
        ):
            counted[row["place"]].append(row)
        counted = [sorted(rows) for rows in counted]
        for draw in wide:
            for row in counted[numbers[_place(draw, prefixes[draw.name])]]:
                if rank[draw.name] <= row["count"]:
                    prefixes[draw.name] += row["digits"]
                    width[draw.name] = row["count"]
                    break
                rank[draw.name] -= row["count"]

    thresholds.update({name: prefix + "g" for name, prefix in prefixes.items()})
    return thresholds


def in_sample(draw: Draw, threshold: str, row_id: str) -> Column:
    """Does the row belong to the sample?"""
    if threshold == "":
        return F.lit(False)
    eligible = draw.eligible if draw.eligible is not None else F.lit(True)
    if threshold == "g":
        return eligible
    return eligible & (draw_hash(draw.seed, row_id) <= F.lit(threshold))


def seeded_sample(
    frame: DataFrame, size: int, seed: int, row_id: str, eligible: Column | None = None
) -> DataFrame:
    """Exactly ``min(size, population)`` rows, the same ones at every run."""
    population = (frame if eligible is None else frame.where(eligible)).count()
    draw = Draw("sample", seed, size, population, eligible)
    threshold = draw_thresholds(frame, [draw], row_id)["sample"]
    return frame.where(in_sample(draw, threshold, row_id))


#: Above so many picks a row, whole rounds that take every row once come first.
MOST_PICKS = 16


def repeat_sizes(draws: int, population: int) -> list[int]:
    """How many rows are picked at least once, at least twice, and so on; the sum is ``draws``.

    Independent picks leave each row with a Poisson number of picks. The sizes are the numbers
    of rows expected at or above each level, rounded so that nothing is lost on the way.
    """
    if draws <= 0 or population <= 0:
        return []
    rounds = max(0, draws // population - MOST_PICKS // 2) if draws > MOST_PICKS * population else 0
    draws -= rounds * population
    rate = draws / population
    sums, below, level = [draws], 0.0, 1  # picks from each level on
    while sums[-1] > 0:
        share = math.exp(-rate + (level - 1) * math.log(rate) - math.lgamma(level))
        reached, below = 1 - below, below + share  # shares of rows with level - 1 picks or more, and with fewer than level
        sums.append(math.floor(population * (rate * reached - level * (1 - below)) + 0.5))
        level += 1
    return [population] * rounds + [a - b for a, b in zip(sums, sums[1:])]


def repeated_draws(name: str, seed: int, draws: int, population: int, eligible: Column | None = None) -> list[Draw]:
    """A draw with replacement as samples by one hash order, one for each number of picks.

    A row is picked as often as it is in these samples. Each is an ordinary sample: its
    threshold is counted together with all others, and what a row gets is decided by the row
    alone, without a sort, a join or a list of positions.
    """
    return [Draw(f"{name}#{level}", seed, size, population, eligible)
            for level, size in enumerate(repeat_sizes(draws, population))]


def picked(frame: DataFrame, levels: Sequence[Draw], thresholds: dict[str, str], row_id: str, low: int = 0) -> DataFrame:
    """``frame`` once for each pick, with its number ``pick``.

    Numbers are unique and grow with the row id, counted from ``low``; they are not consecutive.
    """
    if not levels:
        return frame.limit(0).withColumn("pick", F.lit(0).cast("long"))
    eligible = levels[0].eligible if levels[0].eligible is not None else F.lit(True)
    hashed = frame.where(eligible).withColumn("_hash", draw_hash(levels[0].seed, row_id))
    highest = max(thresholds[d.name] for d in levels)
    hits = F.array(*(F.when(F.col("_hash") <= thresholds[d.name], F.lit(i)) for i, d in enumerate(levels)))
    rows = hashed.where(F.col("_hash") <= highest).withColumn("_level", F.explode(F.array_compact(hits)))
    number = (F.col(row_id) - F.lit(low)) * len(levels) + F.col("_level")
    return rows.withColumn("pick", number.cast("long")).drop("_hash", "_level")


def independent_picks(frame: DataFrame, draws: int, population: int, seed: int, row_id: str) -> DataFrame:
    """``draws`` picks, each decided on its own, numbered ``pick`` from 0.

    Pick *i* takes the row at position ``hash(seed, i) mod population`` of the hash order, so how
    often a row is picked is left to chance. Rows get their positions in parallel (see
    ``ranking.with_positions``) and are joined by them once. Rows of one id are told apart by
    their other columns; rows without an id come last.
    """
    if draws <= 0 or population <= 0:
        return frame.limit(0).withColumn("pick", F.lit(0).cast("long"))
    value = draw_hash(seed, row_id)
    others = [f.name for f in frame.schema.fields if f.name != row_id and "map<" not in f.dataType.simpleString()]
    placed = with_positions(
        frame.withColumn("_unknown", value.isNull()).withColumn("_draw", value),
        ["_unknown", "_draw", row_id, *others], "_at")
    text = F.md5(F.concat(F.lit(f"{seed}|draw|"), F.col("id").cast("string")))
    number = F.conv(F.substring(text, 1, 15), 16, 10).cast("long")
    picks = frame.sparkSession.range(draws).select(
        F.col("id").alias("pick"), F.pmod(number, F.lit(population).cast("long")).alias("_at"))
    return placed.join(picks, "_at").select(*frame.columns, "pick")


def sample_with_replacement(
    frame: DataFrame, draws: int, population: int, seed: int, row_id: str, independent: bool = False
) -> DataFrame:
    """``draws`` picks from the rows of ``frame`` (``population`` of them), with a pick number.

    With ``independent`` every pick is drawn on its own. Otherwise the numbers of rows picked once,
    twice and so on are those expected (see ``repeated_draws``): which rows they are depends on seed
    and row id only, and after the counting passes the picks are one scan.
    """
    if independent:
        return independent_picks(frame, draws, population, seed, row_id)
    levels = repeated_draws("sample", seed, draws, population)
    return picked(frame, levels, draw_thresholds(frame, levels, row_id), row_id)
