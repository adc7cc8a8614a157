"""License scans: winnowed template fingerprints in an inverted index, then banded alignment.

Words of a text are matched to the words of the templates; the winnowed k-grams of the text are
looked up in an inverted index of the templates' k-grams; hits on near diagonals make a candidate;
a banded alignment of the template with that place gives the matched words and the span.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import prepared, slices, text_or_empty

GRAM = 3  # words
WINDOW = 2  # a run of GRAM + WINDOW - 1 = 4 template words is always found
BAND = 8  # words inserted or left out that an alignment can bridge
COVERAGE = 0.75
VERSION = re.compile(rb"v?[0-9]+(\.[0-9]+)*")
SHORT = 14  # words of a notice that is little more than the license's name
EDGE = b".,;:!?()[]{}<>\"'`*#/-_="

#: Short standard notices of public licenses.
TEMPLATES = {
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", "Licensed under the BSD License."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.",
                        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0.",
                        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and "
                "related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}


def plain(word: bytes) -> bytes:
    return word.strip(EDGE)


@dataclass
class Index:
    """Inverted index from winnowed k-grams to places in templates."""

    names: list[str] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    ids: dict[bytes, int] = field(default_factory=dict)
    places: dict[int, list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))
    needs: list[set[int]] = field(default_factory=list)  # words that a match must have, and must not
    bars: list[set[int]] = field(default_factory=list)

    @classmethod
    def build(cls, templates: dict[str, list[str]]) -> Index:
        index = cls()
        for name, texts in templates.items():
            for text in texts:
                words = [w for w in map(plain, text.encode().lower().split()) if w]
                row = np.array([index.ids.setdefault(w, len(index.ids) + 1) for w in words], np.int64)
                for at, code in zip(*index.winnow(row)):
                    index.places[int(code)].append((len(index.words), int(at)))
                index.names.append(name)
                index.words.append(row)
        index.decide()
        return index

    def decide(self) -> None:
        """The words that tell a template from the others, which an alignment must not forgive.

        Where most words of a template stand in one of another license, a match must have those that the
        other lacks and none of those that only the other has. A short template must have all words that no
        other license uses, and keeps off the words that its license's other short ones do. Versions always
        decide."""
        word = {i: w for w, i in self.ids.items()}
        sets, used = [set(w.tolist()) for w in self.words], defaultdict(set)
        for name, words in zip(self.names, sets):
            for w in words:
                used[w].add(name)
        for name, mine in zip(self.names, sets):
            needs, bars = {w for w in mine if VERSION.fullmatch(word[w]) or (used[w] == {name} and len(mine) <= SHORT)}, set()
            for other, theirs in zip(self.names, sets):
                common = len(mine & theirs)
                if other != name and common >= COVERAGE * len(mine) and 2 * common >= len(theirs):
                    needs |= mine - theirs
                    bars |= theirs - mine
            self.needs.append(needs)
            self.bars.append(bars)
        kept_off = defaultdict(set)
        for name, mine, bars in zip(self.names, sets, self.bars):
            if len(mine) <= SHORT:
                kept_off[name] |= bars
        self.bars = [bars | (kept_off[name] - mine) if len(mine) <= SHORT else bars
                     for name, mine, bars in zip(self.names, sets, self.bars)]

    def decided(self, t: int, words: np.ndarray) -> bool:
        """Whether the words of a match's span are this license's, not a near one's."""
        held = set(words.tolist())
        return self.needs[t] <= held and not self.bars[t] & held

    @staticmethod
    def winnow(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, codes) of the kept k-grams. Grams with a word of no template (number 0) cannot
        hit and count as largest of all; a row with fewer grams than a window keeps its least."""
        n = len(row) - GRAM + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = np.lib.stride_tricks.sliding_window_view(row, GRAM)
        live = (grams > 0).all(1)
        code = grams[:, 0] * 1_000_003 + grams[:, 1] * 4099 + grams[:, 2]
        order = ((code * 0x5DEECE66D + 11) >> 7) & 0xFFFFFFFF  # a mix, so that frequent words do not decide
        order = np.where(live, order, 1 << 40)
        width = min(WINDOW, n)
        windows = np.lib.stride_tricks.sliding_window_view(order, width)
        right = width - 1 - np.argmin(windows[:, ::-1], axis=1)  # the rightmost of equals
        kept = np.unique(np.arange(len(windows)) + right)
        kept = kept[live[kept]]
        return kept, code[kept]

    def candidates(self, row: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal) of the places that share kept grams, one for each run of near hits in
        which the template does not start again."""
        hits = defaultdict(list)
        for at, code in zip(*self.winnow(row)):
            for t, place in self.places.get(int(code), ()):
                hits[t].append((int(at) - place, int(at)))
        out = []

        def cut(t: int, group: list[tuple[int, int]]) -> None:
            run: list[tuple[int, int]] = []
            for hit in sorted(group, key=lambda h: (h[1], h[0])):
                if run and hit[1] - hit[0] <= run[-1][1] - run[-1][0]:  # no further in the template
                    out.append((t, run[len(run) // 2][0]))
                    run = []
                run.append(hit)
            out.append((t, run[len(run) // 2][0]))

        for t, found in hits.items():
            found.sort()
            group = [found[0]]
            for hit in found[1:]:
                if hit[0] - group[0][0] > BAND:
                    cut(t, group)
                    group = []
                group.append(hit)
            cut(t, group)
        return list(dict.fromkeys(out))

    def align(self, row: np.ndarray, t: int, diagonal: int, start: int = 0, stop: int | None = None) -> tuple[int, int, int]:
        """(matched words, first and last matched place) of the best alignment of the template with
        the row (its places from start to stop) near the diagonal: most words in common, in order,
        within the band; of equals the tightest span, then the nearest to the diagonal."""
        stop = len(row) if stop is None else stop
        word = self.words[t]
        low, width = diagonal - BAND, 2 * BAND + 1
        best = np.zeros(width, np.int64)  # at row place = template place + low + j
        begin, until = np.full(width, -1), np.full(width, -1)
        for i, w in enumerate(word):
            at = i + low + np.arange(width)
            inside = (at >= start) & (at < stop)
            same = inside & (row[np.clip(at, 0, len(row) - 1)] == w)
            new, nb, nu = best.copy(), begin.copy(), until.copy()  # a match or a word replaced: the same diagonal
            new[same] += 1
            nb[same & (begin < 0)] = at[same & (begin < 0)]
            nu[same] = at[same]
            up = np.append(best[1:], -1)  # a template word left out: one diagonal lower than before
            for j in range(width):
                if up[j] > new[j] or (j + 1 < width and up[j] == new[j] and begin[j + 1] > nb[j]):
                    new[j], nb[j], nu[j] = up[j], begin[j + 1], until[j + 1]
                if j and (new[j - 1] > new[j] or (new[j - 1] == new[j] and nb[j - 1] > nb[j])):  # a row word between: the next diagonal
                    new[j], nb[j], nu[j] = new[j - 1], nb[j - 1], nu[j - 1]
            best, begin, until = new, nb, nu
        j = min(range(width), key=lambda j: (-best[j], until[j] - begin[j], abs(j - BAND)))
        return int(best[j]), int(begin[j]), int(until[j])

    def matches(self, row: np.ndarray, t: int, diagonal: int, coverage: float) -> Iterator[tuple[int, int, int]]:
        """The alignments that reach the coverage: the best one, and those left and right of it."""
        size, todo = len(self.words[t]), [(0, len(row))]
        while todo:
            start, stop = todo.pop()
            room = min(stop, diagonal + BAND + size) - max(start, diagonal - BAND)
            if room < GRAM or room < coverage * size:
                continue
            matched, first, last = self.align(row, t, diagonal, start, stop)
            if matched >= GRAM and matched / size >= coverage:
                if self.decided(t, row[first:last + 1]):
                    yield matched, first, last
                todo += [(start, first), (last + 1, stop)]

    def scan(self, text: str, coverage: float) -> list[tuple[str, float, int, int, int]]:
        """(template, matched coverage, matched words, start, end) with character offsets; of matches
        that overlap, the one with the most matched words, then the greatest coverage, then the
        tightest span."""
        raw = text.encode().lower().split()
        get = self.ids.get
        row = np.fromiter((get(w) or get(plain(w), 0) for w in raw), np.int64, len(raw))
        if np.count_nonzero(row) < GRAM:
            return []
        found = []
        for t, diagonal in self.candidates(row):
            for matched, first, last in self.matches(row, t, diagonal, coverage):
                found.append((-matched, -matched / len(self.words[t]), first, last, t))
        kept: list[tuple] = []
        taken = np.zeros(len(row), bool)
        # of equal matches the tightest, so that no span runs into the next place
        for hit in sorted(set(found), key=lambda k: (k[0], k[1], k[3] - k[2], k)):
            if not taken[hit[2]:hit[3] + 1].any():
                taken[hit[2]:hit[3] + 1] = True
                kept.append(hit)
        if not kept:
            return []
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        return [(self.names[t], -share, -matched, spans[first][0], spans[last][1])
                for matched, share, first, last, t in sorted(kept, key=lambda k: k[2])]


def scan(df: DataFrame, templates: dict[str, list[str]] | None = None, id_col: str = "doc_id",
         text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """Id and ``matches``: array<struct<license, coverage, words, start, end>> of each document, in
    order of place; empty where nothing matches. Offsets are characters of the whole text.

    Templates are a fixed, small set that every task indexes. A null or empty text has no match; an empty
    table gives an empty result, and repeated rows a row each. A text that repeats a notice has a match
    for each place. Templates that share a place compete: the one with the most matched words is
    reported. A notice that lacks or replaces a word that decides the license (a version, NC, ND, SA,
    Lesser) is no match of it.
    """
    prepared(df.sparkSession)
    chosen = TEMPLATES if templates is None else templates
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("whole"))
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("words", pa.int32()),
                               ("start", pa.int64()), ("end", pa.int64())]))
    made: dict[str, Index] = {}
    key = xxhash.xxh64_hexdigest(repr(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = made.setdefault(key, Index.build(chosen))
        for batch in slices(batches):
            found = [[dict(zip(("license", "coverage", "words", "start", "end"), m)) for m in index.scan(t, coverage)]
                     for t in batch.column("whole").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, kind)], ["id", "matches"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, matches array<struct<license: string, coverage: double, words: int, "
                                "start: bigint, end: bigint>>").withColumnRenamed("id", id_col)
