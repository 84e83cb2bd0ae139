"""License scans by patience alignment of texts with license templates.

Words that occur once in the text and once in the template are anchors. The longest increasing
subsequence of their places keeps the anchors that stand in the same order on both sides, and the gaps
between them are aligned the same way. Coverage is the share of the template's words that are aligned.

A text can hold a notice anywhere, and more than once, so the alignment runs on the stretches around
every place of the template's words, rarest in the text first, until no notice without the
words tried can cover more than the best one found, or enough.
"""

import bisect
import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import ALNUM, offsets, sliced, utf8

LEAST_COVERAGE = 0.8
#: How much longer than the template a stretch may be, for words put in between.
SLACK = 0.5

SCAN = (
    "doc_id long, n_words long, license string, coverage double, n_aligned long, start long, end long, "
    "n_licenses long"
)
FOUND = "license string, coverage double, n_aligned long, start long, end long"
#: Templates up to so many words differ from others in a word or two, which may be no other ones.
SHORT = 20

# Wordings of public licenses and of the notices that grant them.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1 notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD notice": "Released under the BSD License.",
    "ISC notice": "Released under the ISC License.",
    "MPL-2.0 notice": "Licensed under the Mozilla Public License, Version 2.0.",
    "CC-BY-4.0 short notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0 notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0 notice": "Licensed under CC BY-NC-ND 4.0.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
}


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    below = [-1] * len(values)
    for place, value in enumerate(values):
        pile = bisect.bisect_left(tops, value)
        if pile == len(tops):
            tops.append(value)
            piles.append(place)
        else:
            tops[pile] = value
            piles[pile] = place
        below[place] = piles[pile - 1] if pile else -1
    chain = []
    place = piles[-1] if piles else -1
    while place >= 0:
        chain.append(place)
        place = below[place]
    return chain[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Aligned ``(text, template)`` places in order."""
    pairs = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            pairs.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            pairs.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        here, there = Counter(text[a:a_end]), Counter(template[b:b_end])
        places = {w: i for i, w in enumerate(template[b:b_end], b) if there[w] == 1 and here[w] == 1}
        anchors = [(i, places[w]) for i, w in enumerate(text[a:a_end], a) if w in places]
        chain = [anchors[i] for i in longest_increasing([j for _, j in anchors])]
        if not chain:
            continue
        pairs += chain
        bounds = [(a - 1, b - 1), *chain, (a_end, b_end)]
        for (i, j), (i_end, j_end) in zip(bounds, bounds[1:], strict=False):
            todo.append((i + 1, i_end, j + 1, j_end))
    return sorted(pairs)


class Templates:
    """Templates as numbered words, to be found in texts numbered alike (0: in no template)."""

    def __init__(self, templates: dict[str, str]):
        self.numbers: dict[bytes, int] = {}
        self.names, self.words, self.counts = [], [], []
        for name, text in templates.items():
            words = text.encode().translate(ALNUM).split()
            coded = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            if coded:
                self.names.append(name)
                self.words.append(coded)
        self.digits = {number for word, number in self.numbers.items() if word.isdigit()}
        for coded in self.words:
            self.counts.append(np.bincount(coded, minlength=len(self.numbers) + 1))

    def scan(self, coded: np.ndarray, least: float) -> list[tuple[int, int, int, int]]:
        """``(template, aligned words, start, end)`` of the best stretch of each template found."""
        known = np.bincount(coded, minlength=len(self.numbers) + 1)
        known[0] = 0
        found = []
        for number, (words, counts) in enumerate(zip(self.words, self.counts, strict=True)):
            # No alignment has more words than both sides share, so this rules nothing out wrongly.
            if np.minimum(known, counts).sum() < least * len(words):
                continue
            best = self._best(coded, known, words, counts, least)
            if best[0] >= least * len(words):
                found.append((number, *best))
        return found

    def _tells(self, pairs: list[tuple[int, int]], words: list[int]) -> bool:
        """Whether no word of a short notice stands replaced by another and none of its numbers lacks."""
        replaced = any(i2 > i + 1 and j2 > j + 1 for (i, j), (i2, j2) in itertools.pairwise(pairs))
        aligned = {j for _, j in pairs}
        return not replaced and all(j in aligned for j, word in enumerate(words) if word in self.digits)

    def _best(
        self, coded: np.ndarray, known: np.ndarray, words: list[int], counts: np.ndarray, least: float
    ) -> tuple[int, int, int]:
        shared = np.minimum(known, counts)
        left = int(shared.sum())
        places = {}
        for place, word in enumerate(words):
            places.setdefault(word, []).append(place)
        slack = int(SLACK * len(words)) + 1
        short = len(words) <= SHORT
        best = (0, 0, 0)
        tried = set()
        for rare in sorted((w for w in places if known[w]), key=lambda w: (known[w] / shared[w], w)):
            # What is not found yet aligns none of the words tried.
            if left <= best[0] or left < least * len(words):
                break
            left -= int(shared[rare])
            for at in np.flatnonzero(coded == rare).tolist():
                for place in places[rare]:
                    start, end = max(0, at - place - slack), min(len(coded), at + len(words) - place + slack)
                    if (start, end) in tried:
                        continue
                    tried.add((start, end))
                    stretch = coded[start:end]
                    here = np.bincount(stretch, minlength=len(counts))
                    here[0] = 0
                    bound = np.minimum(here, counts).sum()
                    if bound + short <= best[0] or bound < least * len(words):
                        continue
                    pairs = align(stretch.tolist(), words)
                    if not pairs or (short and not self._tells(pairs, words)):
                        continue
                    found = (len(pairs), start + pairs[0][0], start + pairs[-1][0] + 1)
                    # Of equal ones the tightest counts, so that words in between are none of the notice's.
                    if (found[0], found[1] - found[2]) > (best[0], best[1] - best[2]):
                        best = found
        return best


def apart(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The templates found without those that stand in the place of one that says more, best first."""
    kept = []
    for one in sorted(found, key=lambda f: (-f[1], f[0])):
        if all(one[3] <= first or last <= one[2] for _, _, first, last in kept):
            kept.append(one)
    return kept


def _scan(templates: Templates, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = templates.numbers.get
        keys = [field.split()[0] for field in FOUND.split(", ")]
        for batch in sliced(batches):
            rows = []
            texts = [text.translate(ALNUM).split() for text in utf8(batch.column("text"))]
            starts = offsets([len(words) for words in texts])
            flat = np.fromiter((number(w, 0) for words in texts for w in words), np.int64, int(starts[-1]))
            for doc, start, end in zip(
                batch.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True
            ):
                found = templates.scan(flat[start:end], least) if end > start else []
                # The template with most words aligned says most; a notice is part of its license.
                each = [
                    (templates.names[n], aligned / len(templates.words[n]), aligned, first, last)
                    for n, aligned, first, last in apart(found)
                ]
                row = each[0] if each else (None, 0.0, 0, None, None)
                listed = [dict(zip(keys, one, strict=True)) for one in each]
                rows.append((doc, end - start, *row, len(each), listed))
            one = [pa.string(), pa.float64(), *[pa.int64()] * 3]
            names = [field.split()[0] for field in SCAN.split(", ")] + ["licenses"]
            types = [pa.int64(), pa.int64(), *one, pa.int64(), pa.list_(pa.struct(list(zip(keys, one, strict=True))))]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return run


def license_scan(
    documents: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE
) -> DataFrame:
    """Per document the license it covers best, how much of it, and where it stands.

    ``licenses`` has every license found, best first, with the place it covers best; what stands in the
    place of one that says more is left out. ``start`` and ``end`` are word places. A document that covers no template by ``least`` has a null
    license and coverage 0; so have null and empty texts. Of templates that align equally many words
    the first one counts. Repeated rows each get a result, null ids stay null, an empty table gives
    no rows, and further columns are ignored. Nothing is shuffled.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    known = Templates(TEMPLATES if templates is None else templates)
    each = ", ".join(field.replace(" ", ": ") for field in FOUND.split(", "))
    return texts.mapInArrow(_scan(known, least), f"{SCAN}, licenses array<struct<{each}>>")
