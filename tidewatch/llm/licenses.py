"""License scans: winnowed template fingerprints find candidates, banded alignment confirms them.

Templates are license notices and the whole texts of short licenses. Their winnowed word-gram
fingerprints form an inverted index from fingerprint to (template, place). A document's grams are looked up in the index;
every hit names a template and a diagonal (place in the document less place in the template).
Hits of one template on neighbouring diagonals are one candidate, which is aligned with the
template word by word inside a band around its diagonals. A match reports the share of the
template's words that are covered and where they stand in the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import documents, each, held, streamed

#: Identifiers of well-known licenses and the notices by which texts name them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License",
    ],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License",
    ],
    "LGPL-2.0": [
        "under the terms of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License",
    ],
    "ISC": [
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "0BSD": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        'hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES',
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "This work is dedicated to the public domain under CC0 1.0 Universal",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"',
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright "
        "holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "
        'AND CONTRIBUTORS "AS IS"',
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ],
}

#: Words that make another license of a notice they are put into.
QUALIFIERS = ("affero", "lesser", "library", "noncommercial", "nc", "sharealike", "sa", "noderivatives", "noderivs", "nd")
#: Words that tell nothing of a license: pairs of them are no fingerprint of a short notice.
PLAIN = ("a", "is", "of", "the", "this", "to", "under", "work", "licensed", "released", "into")

#: Words of a gram; of every WINNOW neighbouring grams the one with the least hash is kept.
GRAM, WINNOW = 3, 2
#: Diagonals of one candidate lie at most BAND apart, and the alignment strays no further.
BAND = 3
#: Least share of a template's words that a match covers.
COVERAGE = 0.8
#: A match leaves a run of GRAM + WINNOW - 1 words only in templates of at least LONG words; shorter ones
#: have all their grams in the index, those of up to PAIRS words as pairs.
LONG, PAIRS = 16, 6
#: Words are runs of letters and digits; A-Z are lower-cased.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(rb"[^ ]+")


def winnow(words: list[bytes], gram: int, window: int) -> dict[int, int]:
    """Place and hash of the kept grams; a text of fewer words than a gram has one, of all."""
    size = max(1, len(words) - gram + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k: k + gram])) for k in range(size)]
    kept = {}
    for at in range(max(1, size - window + 1)):
        place = min(range(at, min(at + window, size)), key=lambda k: (hashes[k], -k))
        kept[place] = hashes[place]
    return kept


class Index:
    """Inverted index of the templates' fingerprints, and the templates' words as codes."""

    def __init__(self, templates: dict[str, list[str]], gram: int = GRAM, window: int = WINNOW):
        self.gram, self.code = gram, {}
        self.names: list[tuple[str, int]] = []
        self.words: list[list[int]] = []
        self.grams: dict[tuple, list[tuple[int, int]]] = {}
        self.shortest = gram
        for name in sorted(templates):
            for number, text in enumerate(templates[name]):
                words = text.encode().translate(_WORDS).split()
                if not words:
                    continue
                codes = [self.code.setdefault(w, len(self.code)) for w in words]
                for place, size in self._fingerprints(words, window):
                    key = tuple(codes[place: place + size])
                    self.grams.setdefault(key, []).append((len(self.words), place))
                self.names.append((name, number))
                self.words.append(codes)
        self.sizes = sorted({len(key) for key in self.grams}, reverse=True)
        self.shortest = min(self.sizes, default=gram)
        self.qualifiers = {self.code.setdefault(w.encode(), len(self.code)) for w in QUALIFIERS}

    def _fingerprints(self, words: list[bytes], window: int) -> list[tuple[int, int]]:
        """Place and size of a template's grams in the index."""
        if PAIRS < len(words):
            every = range(len(words) - self.gram + 1)
            return [(place, self.gram) for place in (winnow(words, self.gram, window) if len(words) >= LONG else every)]
        telling = [w.decode() not in PLAIN for w in words]
        pairs = [k for k in range(len(words) - 1) if telling[k] or telling[k + 1]]
        return [(k, 2) for k in pairs] or [(0, len(words))]

    def candidates(self, codes: np.ndarray) -> dict[int, list[int]]:
        """Diagonals on which a template's fingerprints are hit, by template."""
        edge = np.flatnonzero(np.diff(np.concatenate(([False], codes >= 0, [False])).astype(np.int8)))
        found: dict[int, list[int]] = {}
        for a, b in edge.reshape(-1, 2).tolist():
            if b - a < self.shortest:  # too few known words in a row for a gram
                continue
            run = codes[a:b].tolist()
            for size in self.sizes:
                for at in range(len(run) - size + 1):
                    for template, place in self.grams.get(tuple(run[at: at + size]), ()):
                        found.setdefault(template, []).append(a + at - place)
        return found


def align(document: np.ndarray, template: list[int], low: int, high: int) -> tuple[int, int, int]:
    """Best alignment of a template with the document on the diagonals low .. high.

    Returns how many template words stand in it in order, and the first and last document
    word of them (last exclusive). Among equal counts the shortest stretch wins, then the
    earliest.
    """
    n, m = len(document), len(template)
    # best[d]: (words, -length, start, end) of a chain that ends at or before this diagonal
    none = (0, 0, 0, 0)
    before = [none] * (high - low + 1)
    best = none
    for j in range(m):
        now = [none] * (high - low + 1)
        for d in range(low, high + 1):
            at = d + j
            k = d - low
            chain = before[k]  # document and template both advance
            if 0 <= at < n and document[at] == template[j]:
                words, _, start, _ = chain
                start = start if words else at
                chain = (words + 1, start - at - 1, start, at + 1)
            now[k] = max(chain, now[k - 1] if k else none, before[k + 1] if d < high else none,
                         key=lambda c: (c[0], c[1], -c[2]))
        before = now
    for chain in before:
        best = max(best, chain, key=lambda c: (c[0], c[1], -c[2]))
    return best[0], best[2], best[3]


class Scanner:
    def __init__(self, templates: dict[str, list[str]], coverage: float = COVERAGE, band: int = BAND):
        self.index, self.coverage, self.band = Index(templates), coverage, band

    def scan(self, text: bytes) -> list[tuple[str, int, float, int, int, int, int]]:
        """(license, notice, coverage, first word, last word, first byte, last byte) of a text."""
        clean = text.translate(_WORDS)
        words = clean.split()
        codes = np.fromiter(map(self.index.code.get, words, repeat(-1)), np.int64, len(words))
        found = []
        for template, diagonals in sorted(self.index.candidates(codes).items()):
            wanted = self.index.words[template]
            diagonals = sorted(set(diagonals))
            groups = [[diagonals[0], diagonals[0]]]
            for d in diagonals[1:]:
                if d - groups[-1][1] <= self.band:
                    groups[-1][1] = d
                else:
                    groups.append([d, d])
            for low, high in groups:
                count, a, b = align(codes, wanted, low - self.band, high + self.band)
                share = count / len(wanted)
                # a word that makes it another license must be the template's own
                if share >= self.coverage and self.index.qualifiers.intersection(codes[a:b].tolist()) <= set(wanted):
                    found.append((count, *self.index.names[template], share, a, b))
        if not found:
            return []
        places = [m.span() for m in _WORD.finditer(clean)]
        return [(*row, places[row[3]][0], places[row[4] - 1][1]) for row in strongest(found)]


def strongest(found: list[tuple]) -> list[tuple]:
    """Of overlapping matches (words covered, license, notice, coverage, first, last) the one with most words.

    Ties go to the greater coverage, the shorter stretch, the name and the place.
    """
    kept: list[tuple] = []
    for row in sorted(found, key=lambda r: (-r[0], -r[3], r[5] - r[4], r[1], r[2], r[4])):
        if all(row[5] <= other[4] or row[4] >= other[5] for other in kept):
            kept.append(row)
    return [row[1:] for row in sorted(kept, key=lambda r: (r[4], r[1]))]


MATCHES = ("doc_id long, license string, notice long, coverage double, first_word long, last_word long, "
           "first_byte long, last_byte long, matched string")


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row for every license notice found in ``docs`` (doc_id, text).

    Returns doc_id, license, notice (which of the license's notices), coverage (share of its
    words found in order), first_word and last_word (exclusive) in the document, the same in
    bytes of the UTF-8 text, and the matched text. Notices that overlap count once, as the one
    that covers most words; a stretch with a word of QUALIFIERS that the notice lacks is no
    match. Null and empty texts have none; rows without doc_id and repeated
    rows are scanned like any other; no rows or templates: no rows; extra columns are ignored.
    """
    templates = TEMPLATES if templates is None else templates
    key = repr((sorted(templates.items()), coverage))
    names = [f.split()[0] for f in MATCHES.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 4, pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = held(key, lambda: Scanner(templates, coverage))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), each(batch["text"])):
                for row in scanner.scan(text):
                    rows.append((doc_id, *row, text[row[5]:row[6]].decode("utf-8", "replace")))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return documents(docs).mapInArrow(streamed(work, key), MATCHES)
