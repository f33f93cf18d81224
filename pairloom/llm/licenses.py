"""Licence texts found by patience alignment.

Where a document mentions a distinctive word of a template, a stretch around it is aligned with the template: words that
occur once in both are anchors, the longest increasing subsequence of their places is kept, and the gaps between
them are aligned in the same way; a gap without anchors gives what its ends have in common. The share of the template's words
that are aligned is its coverage. One narrow pass over batches of texts.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import add_rows, whole

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE."""
#: Name, text: the usual notices, and the sentences by which a text names its licence.
TEMPLATES = (
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD", _BSD),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", _GPL),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
_WORD = re.compile(r"\w+(?:[.-]\w+)*")
#: Words that name a licence, a version or a condition: a text and a template that differ in one of them are not of one licence.
_DECIDING = frozenset(
    """mit bsd isc x11 apache mozilla mpl gnu gpl lgpl agpl lesser library affero eclipse epl boost zlib unlicense cddl eupl artistic python
    postgresql openssl microsoft academic cc cc0 creative commons attribution noncommercial non-commercial sharealike share-alike
    noderivatives no-derivatives noderivs nc nd sa 2-clause 3-clause 4-clause""".split()
)
_DECIDING_FORM = re.compile(r"v?\d+(?:\.\d+)*|by(?:-(?:nc|nd|sa))*")


def is_deciding(word: str) -> bool:
    return word in _DECIDING or _DECIDING_FORM.fullmatch(word) is not None


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs in order of their first place the longest run with increasing second places (patience sorting)."""
    tops, tails, before = [], [], [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(tops, y)
        before[i] = tails[k - 1] if k else -1
        tops[k : k + 1], tails[k : k + 1] = [y], [i]
    out, i = [], tails[-1] if tails else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def patience_align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of words of a aligned with the same words of b, both increasing."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        x, y, u, v = todo.pop()
        while x < y and u < v and a[x] == b[u]:
            out.append((x, u))
            x, u = x + 1, u + 1
        while x < y and u < v and a[y - 1] == b[v - 1]:
            y, v = y - 1, v - 1
            out.append((y, v))
        if x == y or u == v:
            continue
        once: dict[str, int] = {}
        for i in range(x, y):
            once[a[i]] = -1 if a[i] in once else i
        there: dict[str, int] = {}
        for j in range(u, v):
            there[b[j]] = -1 if b[j] in there else j
        anchors = _increasing([(i, there[w]) for w, i in sorted(once.items(), key=lambda z: z[1]) if i >= 0 and there.get(w, -1) >= 0])
        for k, (i, j) in enumerate(anchors):
            todo.append((x, i, u, j))
            out.append((i, j))
            x, u = i + 1, j + 1
        if anchors:
            todo.append((x, y, u, v))
    return sorted(out)


class Scanner:
    """The templates' words, and of each its most distinctive one: in the fewest templates, the longest of these."""

    def __init__(self, templates):
        self.names = [n for n, _ in templates]
        self.words = [_words(t) for _, t in templates]
        spread: dict[str, int] = {}
        for ws in self.words:
            for w in set(ws):
                spread[w] = spread.get(w, 0) + 1
        # Several seeds a template, so that a changed word does not hide it.
        self.seeds: dict[str, list[int]] = {}
        for i, ws in enumerate(self.words):
            for w in sorted(set(ws), key=lambda w: (spread[w], -len(w), w))[:3]:
                self.seeds.setdefault(w, []).append(i)
        self.any = re.compile("|".join(sorted(map(re.escape, self.seeds), key=len, reverse=True)))

    @staticmethod
    def _agrees(words: list[str], own: list[str], pairs: list[tuple[int, int]], least: float) -> bool:
        """Is all that tells the licence aligned, and is little inserted between the aligned words?"""
        first, last = pairs[0][0], pairs[-1][0]
        if len(pairs) < least * (last + 1 - first):
            return False
        here, there = {i for i, _ in pairs}, {j for _, j in pairs}
        left = [w for i, w in enumerate(words[first : last + 1], first) if i not in here] + [w for j, w in enumerate(own) if j not in there]
        return not any(map(is_deciding, left))

    def find(self, text: str, least: float) -> list[tuple[str, float, int, int, int, int]]:
        """(name, coverage, first and last word, first and last character) of each place; where places overlap the one with
        the most aligned words, then the highest coverage, then the first template."""
        low = text.lower() if text.isascii() else "".join(c.lower() if c < "\x80" else c for c in text)
        if not self.any.search(low):
            return []
        spans = [(m.start(), m.end()) for m in _WORD.finditer(low)]
        words = [low[x:y] for x, y in spans]
        found, tried = [], set()
        for at, w in enumerate(words):
            for i in self.seeds.get(w, ()):
                own = self.words[i]
                for home in (k for k, z in enumerate(own) if z == w):
                    # Room for a third more words than the template has, on either side in proportion.
                    x, y = max(0, at - home - home // 3 - 2), min(len(words), at + (len(own) - home) * 4 // 3 + 2)
                    if (i, x, y) in tried:
                        continue
                    tried.add((i, x, y))
                    pairs = patience_align(words[x:y], own)
                    share = len(pairs) / len(own)
                    if share >= least and self._agrees(words[x:y], own, pairs, least):
                        found.append((-len(pairs), -share, i, x + pairs[0][0], x + pairs[-1][0]))
        out, taken = [], []
        for _, share, i, a, b in sorted(found):
            if all(b < c or a > d for c, d in taken):
                taken.append((a, b))
                out.append((self.names[i], -share, a, b, spans[a][0], spans[b][1]))
        return sorted(out, key=lambda r: r[2])


def find_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, least: float = 0.8) -> DataFrame:
    """One row per place of a licence in a row of docs: key, license, coverage, first_word, last_word, first_char, last_char.

    A place counts from a coverage of `least` on, if words that name a licence, a version or a condition are the same on both sides
    and as many of the place's words are aligned. Long texts are searched whole; an empty table gives an empty one. Null and empty texts have none; repeated rows and repeated mentions
    give a row each; places of one text do not overlap. The templates (names and texts) are a parameter of fixed size.
    """
    def run(texts):
        scanner = Scanner(templates)
        found = [(i, *r) for i, t in enumerate(texts) for r in scanner.find(t, least)]
        rows, *columns = zip(*found) if found else ([],) * 7
        return rows, columns

    added = "license string, coverage double, first_word int, last_word int, first_char int, last_char int"
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("_source"))
    return add_rows(rows, whole(F.col("_source")), run, added).drop("_source")
