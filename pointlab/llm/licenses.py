"""License scans by patience alignment.

Words of a text and of a license template are aligned around anchors: words that occur once in both,
of which the longest increasing subsequence is kept; the gaps between anchors are aligned in the same
way. A gap without such words takes its longest common subsequence. The coverage of a template is the
share of its words that are aligned.

A template is aligned only with texts that hold enough of its words, counted with repeats, which no
alignment can exceed. It is looked for in two ways. First in compact stretches, with at most a quarter
of foreign words; long ones are cut into windows that overlap by half, so each occurrence lies whole in
one. Of overlapping alignments the best is kept, the first if equal. Then in what lies between those, as
fragments: aligned words with at most ``NEAR`` foreign words between neighbours, ``FRAGMENT`` of them at
least, and any amount of other text from one fragment to the next. So inserted clauses of any length,
line numbers and markers hide no license, and stray words of prose make none. A template of which fewer
than two such fragments are needed is looked for in compact stretches only. One free stretch gives one
row for copies that are entangled in it, and a compact find does not take in fragments outside it.

Templates are a parameter, bounded by the user, and go to every task. Each text is scanned where it
lies; nothing is shuffled. Null and empty texts, and those without a license, give no row; a text with
several gives one row for each, also if licenses that share their wording cover the same words. Repeated
rows give repeated results. Extra columns are not read. A very long text takes up to about 200 bytes of memory
a word.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pointlab.llm.tokencount import BATCH_BYTES, even_batches

WORDS = re.compile(r"[a-z0-9]+")
COVERAGE = 0.8
COMPACT = 1.25  # words of a compact stretch for each word of the template
NEAR = 4  # foreign words between neighbours of a fragment
FRAGMENT = 8  # aligned words of a fragment

# Short notices, and the license texts as published.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written
permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation
would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display,
distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the
Software and this entire statement, including the above license grant, this restriction and the following disclaimer,
must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless
such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO
EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY,
WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
author or authors of this software dedicate any and all copyright interest in the software to the public domain. We
make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We
intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
}


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence of different values."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(ends[pile - 1] if pile else -1)
        tops[pile : pile + 1], ends[pile : pile + 1] = [v], [i]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Longest common subsequence. Two bits for each pair of places are kept, whatever the length of ``a``."""
    words, row = np.array(a), np.zeros(len(a) + 1, dtype=np.int32)
    skips_b, skips_a = [], []
    for w in b:
        new = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (words == w)))
        skips_b.append(np.packbits(new == row[1:]))
        skips_a.append(np.packbits(np.diff(new, prepend=0) == 0))
        row[1:] = new
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        byte, bit = i >> 3, 7 - (i & 7)
        if skips_b[j][byte] >> bit & 1:
            j -= 1
        elif skips_a[j][byte] >> bit & 1:
            i -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions of equal words, in order in both."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head = [(i, i) for i in range(start)]
    tail = [(len(a) - end + i, len(b) - end + i) for i in range(end)]
    a_gap, b_gap = a[start : len(a) - end], b[start : len(b) - end]
    if not a_gap or not b_gap:
        return head + tail
    in_a, in_b = Counter(a_gap), Counter(b_gap)
    place = {w: j for j, w in enumerate(b_gap) if in_b[w] == 1}
    both = [(i, place[w]) for i, w in enumerate(a_gap) if in_a[w] == 1 and w in place]
    anchors = [both[k] for k in increasing([j for _, j in both])]
    if not anchors:
        middle = _common(a_gap, b_gap)
    else:
        middle, i0, j0 = [], 0, 0
        for i, j in [*anchors, (len(a_gap), len(b_gap))]:
            middle += [(i0 + x, j0 + y) for x, y in align(a_gap[i0:i], b_gap[j0:j])]
            if i < len(a_gap):
                middle.append((i, j))
            i0, j0 = i + 1, j + 1
    return head + [(start + i, start + j) for i, j in middle] + tail


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float):
        words = {name: WORDS.findall(text.lower()) for name, text in templates.items()}
        self.ids = {w: i for i, w in enumerate(sorted({w for own in words.values() for w in own}))}
        self.templates = {name: [self.ids[w] for w in own] for name, own in words.items() if own}
        self.coverage = coverage
        # Times a word occurs in the template; the last place, of unknown words, stays zero.
        self.times = {name: np.bincount(own, minlength=len(self.ids) + 1) for name, own in self.templates.items()}

    def _enough(self, counts: np.ndarray, name: str) -> bool:
        """Whether enough words of the template occur, as often as there, for the coverage."""
        return np.minimum(counts, self.times[name]).sum() >= self.coverage * len(self.templates[name])

    def _counts(self, ids: np.ndarray) -> np.ndarray:
        return np.bincount(ids, minlength=len(self.ids) + 1)

    def _stretches(self, hits: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
        wide = int(np.ceil(length * COMPACT))
        least = int(np.ceil(length * self.coverage))
        total = np.concatenate(([0], np.cumsum(hits)))
        at = np.arange(max(1, len(hits) - wide + 1))
        rich = at[total[np.minimum(at + wide, len(hits))] - total[at] >= least]
        if not len(rich):
            return
        for run in np.split(rich, np.flatnonzero(np.diff(rich) > wide) + 1):
            start, end = int(run[0]), min(int(run[-1]) + wide, len(hits))
            for a in range(start, end, wide):
                yield a, min(a + 2 * wide, end)
                if a + 2 * wide >= end:
                    break

    def _compact(self, ids: np.ndarray, hits: np.ndarray, name: str) -> list[tuple[int, int, int]]:
        """Occurrences in compact stretches: first word, word after the last, words aligned."""
        own, got = self.templates[name], []
        least = self.coverage * len(own)
        open_ = list(self._stretches(hits, len(own)))
        while open_:
            a, b = open_.pop()
            pairs = align(ids[a:b].tolist(), own)
            if len(pairs) >= least:
                start, end = a + pairs[0][0], a + pairs[-1][0] + 1
                got.append((-len(pairs), start, end))
                # What is left on either side may hold another one.
                open_ += [(x, y) for x, y in ((a, start), (end, b)) if hits[x:y].sum() >= least]
        taken: list[tuple[int, int, int]] = []
        for n, start, end in sorted(got):
            if all(end <= s or start >= e for s, e, _ in taken):
                taken.append((start, end, -n))
        return taken

    def _spread(self, ids: np.ndarray, hits: np.ndarray, name: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
        """Occurrences in fragments, in the stretches that are not taken."""
        own = self.templates[name]
        least = self.coverage * len(own)
        bounds = sorted(taken)
        open_ = list(zip([0, *[e for _, e, _ in bounds]], [*[s for s, _, _ in bounds], len(ids)], strict=True))
        while open_:
            a, b = open_.pop()
            if not self._enough(self._counts(ids[a:b]), name):
                continue
            place = np.flatnonzero(hits[a:b]) + a
            at = place[np.array([i for i, _ in align(ids[place].tolist(), own)], dtype=np.int64)]
            parts = [p for p in np.split(at, np.flatnonzero(np.diff(at) > NEAR + 1) + 1) if len(p) >= FRAGMENT]
            n = sum(map(len, parts))
            if n >= least:
                start, end = int(parts[0][0]), int(parts[-1][-1]) + 1
                yield start, end, n
                open_ += [(a, start), (end, b)]

    def scan(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """license, first word, word after the last, words aligned, words of the template."""
        unknown = len(self.ids)
        ids = np.array([self.ids.get(w, unknown) for w in WORDS.findall(text.lower())], dtype=np.int64)
        counts, out = self._counts(ids), []
        for name, own in self.templates.items():
            if not self._enough(counts, name):
                continue
            hits = self.times[name][ids] > 0
            found = self._compact(ids, hits, name)
            if self.coverage * len(own) >= 2 * FRAGMENT:
                found += self._spread(ids, hits, name, found[:])
            out += [(name, start, end, n, len(own)) for start, end, n in found]
        return sorted(out, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, license, first_word, end_word, matched, template_words, coverage: a row for each license found."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in even_batches(batches, "text", BATCH_BYTES):
            rows, found = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for x in scanner.scan(text or ""):
                    rows.append(i)
                    found.append(x)
            names, starts, ends, matched, words = zip(*found, strict=True) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), *(pa.array(x, pa.int64()) for x in (starts, ends, matched, words)),
                 pa.array([m / w for m, w in zip(matched, words, strict=True)], pa.float64())],
                ["doc_id", "license", "first_word", "end_word", "matched", "template_words", "coverage"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {key}, license string, first_word long, end_word long, matched long, template_words long, coverage double"
    )
