"""License notices in texts by patience alignment with templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import freeing, slices

# Wordings of public license notices and texts, without names and years.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-text": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-3.0-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-text": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-text": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-text": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
}

# Words that tell a license from others of like wording. Those before the bar have to
# be matched, where the template first has them; those behind it may not stand in the notice.
TELLING = {
    "Apache-2.0": "apache 2 0 |",
    "CC-BY-4.0": "cc by 4 0 | nc sa nd",
    "CC-BY-NC-4.0": "cc by nc 4 0 | sa nd",
    "CC-BY-SA-4.0": "cc by sa 4 0 | nc nd",
    "CC-BY-ND-4.0": "cc by nd 4 0 | nc sa",
    "CC-BY-NC-SA-4.0": "cc by nc sa 4 0 | nd",
    "CC-BY-NC-ND-4.0": "cc by nc nd 4 0 | sa",
    "GPL-2.0": "general public 2 | lesser library affero",
    "GPL-3.0": "general public 3 | lesser library affero",
    "MIT": "mit |",
    "Apache-2.0-notice": "apache 2 0 |",
    "GPL-2.0-text": "general public 2 | lesser affero",
    "GPL-3.0-text": "general public 3 | lesser affero",
    "LGPL-2.1-text": "lesser 2 1 | affero",
    "LGPL-3.0-text": "lesser 3 | affero",
    "AGPL-3.0-text": "affero 3 | lesser",
    "MPL-2.0": "mozilla 2 0 |",
    "EPL-2.0": "eclipse 2 0 |",
    "BSL-1.0": "boost 1 0 |",
}

COVERAGE = 0.8
#: ASCII alone, so that Python and the JVM's pattern agree on what a word is.
TOKEN = re.compile(r"[A-Za-z0-9]+")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text)]


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of one longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places with equal words, rising in both.

    Equal ends are matched first; words that occur once in each of ``a`` and ``b`` are
    anchors, of which a longest increasing subsequence stays; the gaps between anchors are
    aligned in the same way until a gap has no anchor. The work list takes the place of
    recursion, so long texts do not exhaust the stack.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        at = {w: y for y, w in enumerate(b[j:n], j) if in_b[w] == 1 and in_a[w] == 1}
        anchors = [(x, at[w]) for x, w in enumerate(a[i:m], i) if w in at]
        if not anchors:
            continue
        chain = [anchors[k] for k in longest_increasing([y for _, y in anchors])]
        x0, y0 = i, j
        for x, y in [*chain, (m, n)]:
            todo.append((x0, x, y0, y))
            x0, y0 = x + 1, y + 1
        out += chain
    return sorted(out)


def needed_words(template: list[str], coverage: float) -> set[str]:
    """The longest words of ``template`` that no text can lack entirely at this coverage."""
    chosen, missing = set(), 0
    for w, n in sorted(Counter(template).items(), key=lambda x: (-len(x[0]), x[0])):
        chosen.add(w)
        missing += n
        if missing > (1 - coverage) * len(template) + 1e-9:
            break
    return chosen


class Template:
    """A template's words, those that no notice can lack entirely with their places, and those that tell it from others."""

    def __init__(self, words: list[str], coverage: float, telling: str = "|") -> None:
        self.words, self.least = words, coverage * len(words) - 1e-9
        self.slack = max(2, len(words) // 5)
        self.places: dict[str, list[int]] = {w: [] for w in needed_words(words, coverage)}
        for j, w in enumerate(words):
            if w in self.places:
                self.places[w].append(j)
        must, foreign = telling.split("|")
        self.must, self.foreign = {words.index(w) for w in must.split()}, set(foreign.split())

    def found(self, words: list[str], places: dict[str, list[int]]) -> set[tuple[int, int, int]]:
        """(matched words, first word, end word) of every alignment that covers enough and is told from others.

        A needed word says where the notice would begin if nothing was edited before it. From
        there windows of the template's size are aligned, with and without some words more to
        either side; a notice next to another like it is not unique in the wider one.
        """
        n, out, last = len(self.words), set(), None
        for s in sorted({i - j for w, own in self.places.items() for i in places.get(w, ()) for j in own}):
            if last is not None and s - last <= self.slack // 2:
                continue
            last = s
            for more in (0, self.slack + self.slack // 2):
                low, high = max(0, s - more), min(len(words), s + n + more)
                pairs = patience(words[low:high], self.words) if low < high else []
                if len(pairs) >= self.least and self.must <= {j for _, j in pairs}:
                    first, end = low + pairs[0][0], low + pairs[-1][0] + 1
                    if self.foreign.isdisjoint(words[first:end]):
                        out.add((len(pairs), first, end))
        return out


Notice = tuple[str, float, int, int, int]


def settled(found: list[Notice]) -> list[Notice]:
    """Of notices that overlap, that with more words: "CC BY-NC 4.0" is no "CC BY 4.0". Ties go to the
    greater coverage, the shorter stretch, the first name, the first place."""
    kept: list[Notice] = []
    firsts: list[int] = []
    for x in sorted(found, key=lambda x: (-x[2], -x[1], x[4] - x[3], x[0], x[3])):
        k = bisect_left(firsts, x[4])  # those that begin before it ends
        if k == 0 or kept[k - 1][4] <= x[3]:
            firsts.insert(k, x[3])
            kept.insert(k, x)
    return kept


def notices(text: str, templates: dict[str, Template]) -> list[Notice]:
    """(license, coverage, matched words, first word, end word) of all notices in ``text``, in order."""
    words = words_of(text)
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    return settled([(name, round(x[0] / len(t.words), 6), *x) for name, t in templates.items() for x in t.found(words, places)])


def by_license(found: list[Notice]) -> list[tuple]:
    """The best notice of each license, the first of equal ones, with how many there are."""
    best: dict[str, Notice] = {}
    for x in found:
        if x[0] not in best or x[2] > best[x[0]][2]:
            best[x[0]] = x
    count = Counter(x[0] for x in found)
    return [(*x, count[x[0]]) for x in sorted(best.values(), key=lambda x: x[3])]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Templates that a document's text covers to at least ``coverage``.

    docs: doc_id, text; other columns are ignored. All places of all templates are settled
    against each other where they overlap. Returns a row for each input row and license
    found: doc_id, license, coverage (matched share of the template's words), matched,
    first_word, end_word (of the text's words, runs of a-z and 0-9 after lower-casing) of its
    best notice, and notices, how many there are. Versions and kinds have to match (TELLING);
    a notice of a license that no template has gives no row rather than another's. Null, empty and other texts without a notice give no rows, nor does an
    empty table; repeated rows give repeated rows.
    """
    chosen = {k: Template(w, coverage, "|" if templates else TELLING.get(k, "|")) for k, w in ((k, words_of(t)) for k, t in (templates or TEMPLATES).items()) if w}
    # no text without any of these words reaches the coverage of any template
    any_word = "|".join(sorted({w for t in chosen.values() for w in t.places}))
    pattern = f"(?:^|[^A-Za-z0-9])(?:{any_word})(?:[^A-Za-z0-9]|$)"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in slices(whole["text"]):
                batch = whole.slice(low, high - low)
                batch = batch.filter(pc.match_substring_regex(batch["text"], pattern, ignore_case=True))
                rows = [(doc, *x) for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True) for x in by_license(notices(text, chosen))]
                if rows:
                    kinds = pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "license", "coverage", "matched", "first_word", "end_word", "notices"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").filter(F.col("text").isNotNull())
    return rows.mapInArrow(freeing(scanned), "doc_id long, license string, coverage double, matched int, first_word int, end_word int, notices int")
