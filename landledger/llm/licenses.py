"""License texts in documents by patience alignment.

Words that stand once in the text and once in a template are anchors; the longest run of anchors in the same order on both sides is
kept, and the gaps between are aligned in the same way. The share of the template's words that find a partner is its coverage.
A match spans at most twice as many words as its template. Of such stretches, only those are aligned whose longest common subsequence
with the template is long enough, which no alignment could exceed; where patience finds less than that needs, the subsequence counts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from landledger.llm.common import as_bytes

# Notices of public licences, as they are published.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
MATCH = "struct<license: string, matched: int, coverage: double, first_word: int, last_word: int, start: int, end: int>"
SCHEMA = f"doc_id long, n_words long, matches array<{MATCH}>"


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for place, value in enumerate(values):
        at = bisect_left(tails, value)
        if at == len(tails):
            tails.append(value)
            ends.append(place)
        else:
            tails[at], ends[at] = value, place
        before[place] = ends[at - 1] if at else -1
    out, place = [], ends[-1] if ends else -1
    while place >= 0:
        out.append(place)
        place = before[place]
    return out[::-1]


def common_subsequence(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence, for gaps without unique words."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            table[i][j] = table[i + 1][j + 1] + 1 if a[i] == b[j] else max(table[i + 1][j], table[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned pairs of places, in order, of a text and a template."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and text[a] == template[b]:
            pairs.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and text[a_end - 1] == template[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            pairs.append((a_end, b_end))
        if a >= a_end or b >= b_end:
            continue
        in_text, in_template = Counter(text[a:a_end]), Counter(template[b:b_end])
        where = {template[j]: j for j in range(b, b_end) if in_template[template[j]] == 1}
        anchors = [(i, where[text[i]]) for i in range(a, a_end) if in_text[text[i]] == 1 and text[i] in where]
        if not anchors:
            if in_text.keys() & in_template.keys():
                pairs += [(a + i, b + j) for i, j in common_subsequence(text[a:a_end], template[b:b_end])]
            continue
        kept = [anchors[i] for i in increasing([j for _, j in anchors])]
        pairs += kept
        for (i, j), (i_next, j_next) in zip([(a - 1, b - 1), *kept], [*kept, (a_end, b_end)]):
            todo.append((i + 1, i_next, j + 1, j_next))
    return sorted(pairs)


def common(words: list[tuple[int, str]], masks: dict[str, int], size: int) -> tuple[int, int]:
    """(length, first place) of a longest common subsequence of a stretch and a template of ``size`` words; the shortest stretch up to
    the last of ``words``.

    ``masks`` has a bit for each place of a word in the template, the last place lowest. One step of whole-number arithmetic a word.
    """
    every = (1 << size) - 1
    row, best, first = every, 0, -1
    for place, word in reversed(words):
        both = row & masks[word]
        row = ((row + both) | (row - both)) & every
        if size - row.bit_count() > best:
            best, first = size - row.bit_count(), place
    return best, first


def stretches(hits: list[tuple[int, str]], wanted: Counter, span: int, least: int) -> Iterator[tuple[int, int]]:
    """(start, end) of all runs of ``hits`` within ``span`` words of the text, ends counted in, with ``least`` wanted words or more."""
    counts: Counter = Counter()
    full = left = 0
    for end, (place, word) in enumerate(hits):
        counts[word] += 1
        full += counts[word] <= wanted[word]
        while hits[left][0] <= place - span:
            full -= counts[hits[left][1]] <= wanted[hits[left][1]]
            counts[hits[left][1]] -= 1
            left += 1
        if full >= least:
            yield left, end


def trimmed(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Aligned pairs less those at the ends that stand far from the rest in the text, but not in the template."""
    def far(x: tuple[int, int], y: tuple[int, int]) -> bool:
        return y[0] - x[0] > 5 + 2 * (y[1] - x[1])

    while len(pairs) > 1 and far(pairs[0], pairs[1]):
        pairs = pairs[1:]
    while len(pairs) > 1 and far(pairs[-2], pairs[-1]):
        pairs = pairs[:-1]
    return pairs


class Scanner:
    """Templates prepared for scanning; ``least`` is the coverage that counts as found."""

    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        self.words = {name: [w.lower() for w in WORD.findall(text)] for name, text in templates.items()}
        self.words = {name: words for name, words in self.words.items() if words}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        self.masks = {
            name: {word: sum(1 << i for i, w in enumerate(reversed(words)) if w == word) for word in set(words)} for name, words in self.words.items()
        }
        self.vocabulary = frozenset(w for words in self.words.values() for w in words)

    def matches(self, name: str, words: list[str], hits: list[tuple[int, str]], needed: int) -> Iterator[tuple[list, int, int]]:
        """(aligned pairs, first and last word) of a template's matches, apart from each other.

        The stretch with the longest common subsequence less other words comes first. What overlaps a match is measured again on what
        the match leaves of it, and a stretch whose alignment fails takes nothing away from others.
        """
        template, masks = self.words[name], self.masks[name]
        queue: list[tuple[int, int, int, int, int]] = []

        def measure(start: int, end: int) -> None:
            length, first = common(hits[start:end + 1], masks, len(template))
            if length >= needed:
                heappush(queue, (hits[end][0] - first - 2 * length, first, hits[end][0], start, end))

        for start, end in stretches(hits, self.counts[name], 2 * len(template), needed):
            measure(start, end)
        taken: list[tuple[int, int]] = []
        while queue:
            _, low, high, start, end = heappop(queue)
            at = bisect_left(taken, (high + 1,))
            before = taken[at - 1][1] if at else -1
            if before >= high:
                continue
            if before >= low:
                start = max(start, bisect_left(hits, (before + 1,)))
                measure(start, end)
                continue
            pairs = trimmed(align(words[low:high + 1], template))
            if len(pairs) < needed:
                pairs = trimmed(common_subsequence(words[low:high + 1], template))
            if len(pairs) >= needed:
                first, last = low + pairs[0][0], low + pairs[-1][0]
                insort(taken, (first, last))
                yield pairs, first, last

    def scan(self, text: str) -> tuple[int, list[dict]]:
        """Number of words, and the matches in text order; of overlapping ones, the best covered, then longest, then first by name."""
        tokens = WORD.findall(text)
        words = [w.lower() for w in tokens]
        seen = self.vocabulary.intersection(words)
        found = []
        for name, template in self.words.items():
            wanted = self.counts[name]
            needed = -int(-self.least * len(template) // 1)
            if sum(n for w, n in wanted.items() if w in seen) < needed:
                continue
            hits = [(i, w) for i, w in enumerate(words) if w in wanted]
            found += [(-len(pairs) / len(template), -len(pairs), name, first, last) for pairs, first, last in self.matches(name, words, hits, needed)]
        chosen = []
        for match in sorted(found):
            if all(match[4] < other[3] or match[3] > other[4] for other in chosen):
                chosen.append(match)
        if not chosen:
            return len(words), []
        spans = [m.span() for m in WORD.finditer(text)]
        return len(words), [
            {"license": name, "matched": -matched, "coverage": -coverage, "first_word": first, "last_word": last, "start": spans[first][0], "end": spans[last][1]}
            for coverage, matched, name, first, last in sorted(chosen, key=lambda m: m[3])
        ]


def scan(
    documents: DataFrame, templates: dict[str, str] | None = None, least: float = 0.9, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_words, matches): one row per row of ``documents``, with no shuffle.

    A match has its license, the template's words found and their share, and the first and last word and character of the stretch.
    A template found twice in a text is two matches. Null and empty texts have no words and no matches; templates without words
    match nothing.
    """
    chosen = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, least)
        kind = pa.struct([
            ("license", pa.string()), ("matched", pa.int32()), ("coverage", pa.float64()), ("first_word", pa.int32()),
            ("last_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
        ])
        for batch in batches:
            done = [scanner.scan(text.decode()) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in done], pa.int64()), pa.array([m for _, m in done], pa.list_(kind))],
                names=["doc_id", "n_words", "matches"],
            )

    return documents.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"cast(`{text_column}` as string) as text").mapInArrow(run, SCHEMA)
