"""License scan by patience alignment.

A text is aligned with each license template around the places of the template's rarest words: anchors are words that
occur once in both, the longest increasing run of anchors is kept, and the gaps between them are aligned in the same
way. The share of template words so matched is the coverage. Where that does not give one unbroken run, as where a
notice is repeated closely and its words are no anchors, the window is aligned by weight and the narrowest place is taken.
A phrase that tells a license from its neighbours must be held word for word and is the place looked for; for templates
without one, rare words are chosen so many that a text which covers LEAST must hold one of them, so no place is missed.

A match may not be stretched: its words, from the first to the last, are at most WIDEST times those matched.

Defined cases: null or empty text holds no license; very long texts are scanned whole; several licenses are all listed,
the one of most coverage (then of most words, then of first name) is the best, and of equal places of a license the
tightest, then the first; an empty table gives no rows; repeated rows are scanned row by row; a column of the output's
name stays, the output then gets underscores; other columns stay.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, fresh, slices
from .decontaminate import words

LEAST, WIDEST = 0.85, 1.25

GNU = (("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"), ("LGPL-2.0", "GNU Library General Public License", "2"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "GNU Lesser General Public License", "3"), ("AGPL-3.0", "GNU Affero General Public License", "3"))
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials",
    "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
WARRANTY = 'IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'
ZLIB = "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
UNLICENSE = "This is free and unencumbered software released into the public domain."
SPDX = ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "0BSD", "Zlib", "BSL-1.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0")

# Public license notices, title lines and permission texts, by SPDX name. What stands in braces tells a license from
# its neighbours: a text must hold it word for word, with no other word between.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", MIT),
    ("MIT", f"{MIT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE {WARRANTY}"),
    ("Apache-2.0", "Licensed under the {Apache License}, {Version 2.0}."),
    ("Apache-2.0", "{Apache License Version 2.0, January 2004}"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    *((name, f"This work is licensed under the {{{title}}}, {{version {version}}}.") for name, title, version in GNU),
    *((name, f"This program is free software: you can redistribute it and/or modify it under the terms of the {{{title}}} as published by the Free Software Foundation, either {{version {version} of the License}}, or (at your option) any later version.") for name, title, version in GNU),
    *((name, f"This program is free software; you can redistribute it and/or modify it under the terms of the {{{title}}} as published by the Free Software Foundation; {{version {version} of the License}}.") for name, title, version in GNU),
    *((name, f"{{{title} Version {version}, {date}}}") for (name, title, version), date in zip(GNU, ("June 1991", "29 June 2007", "June 1991", "February 1999", "29 June 2007", "19 November 2007"), strict=True)),
    ("MPL-2.0", "Licensed under the {Mozilla Public License}, {version 2.0}."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "{Mozilla Public License Version 2.0} 1. Definitions"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the {Eclipse Public License} {2.0}"),
    ("LicenseRef-BSD", BSD),
    ("BSD-2-Clause", f"{BSD} {CLAUSES[0]} {CLAUSES[1]} {{provided with the distribution. THIS SOFTWARE IS PROVIDED BY}}"),
    ("BSD-3-Clause", f"{BSD} {CLAUSES[0]} {CLAUSES[1]} {{provided with the distribution. Neither the name of}} {CLAUSES[2]}"),
    ("BSD-3-Clause", f"{BSD} 1. {CLAUSES[0]} 2. {CLAUSES[1]} {{provided with the distribution. 3. Neither the name of}} {CLAUSES[2]}"),
    ("ISC", "{Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that} the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "{Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that} the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "{Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED}"),
    ("Zlib", ZLIB),
    ("Zlib", f"This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. {ZLIB} 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSL-1.0", "{Boost Software License} {Version 1.0}"),
    ("Unlicense", UNLICENSE),
    ("Unlicense", f"{UNLICENSE} Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Artistic-2.0", "{The Artistic License 2.0}"),
    ("OFL-1.1", "{SIL Open Font License}, {Version 1.1}"),
    ("MPL-1.1", "{Mozilla Public License Version 1.1}"),
    ("EPL-1.0", "{Eclipse Public License} {v1.0}"),
    ("EUPL-1.2", "{European Union Public Licence} {v. 1.2}"),
    ("CDDL-1.0", "{Common Development and Distribution License} {Version 1.0}"),
    ("GFDL-1.3", "{GNU Free Documentation License}, {Version 1.3}"),
    ("WTFPL", "{Do What The Fuck You Want To Public License}"),
    ("AFL-3.0", "Licensed under the {Academic Free License version 3.0}"),
    ("MS-PL", "{Microsoft Public License} {MS PL}"),
    ("ODbL-1.0", "{Open Database License} {v1.0}"),
    ("PostgreSQL", "{Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted}, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies."),
    ("CC0-1.0", "{CC0 1.0} Universal"),
    ("CC0-1.0", "{Creative Commons Zero} {1.0} Universal"),
    *((f"CC-{kind}-{version}", f"Licensed under {{CC {kind} {version}}}.") for kind in CC for version in ("4.0", "3.0")),
    *((f"CC-{kind}-{version}", f"Licensed under a {{Creative Commons {name} {version}}}") for kind, name in CC.items() for version in ("4.0", "3.0")),
    *((name, f"{{SPDX-License-Identifier: {name}}}") for name in SPDX),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
)
FOUND = "struct<n_words:bigint,matches:array<struct<license:string,coverage:double,matched:bigint,first:bigint,last:bigint>>>"
MATCH = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs (sorted by their first place) whose second places increase."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(tops, j)
        back.append(ends[at - 1] if at else -1)
        tops[at:], ends[at:] = ([j, *tops[at + 1 :]], [k, *ends[at + 1 :]])
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of a and b, in order."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        in_a, in_b = Counter(a[i:m]), Counter(b[j:n])
        place = {b[k]: k for k in range(j, n) if in_b[b[k]] == 1}
        anchors = increasing([(k, place[a[k]]) for k in range(i, m) if in_a[a[k]] == 1 and a[k] in place])
        for (p, q), (r, s) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)], strict=True):
            if anchors and r > p + 1 and s > q + 1:
                gaps.append((p + 1, r, q + 1, s))
        out += anchors
    return sorted(out)


def compact(a: list, b: list, weights: list[int]) -> list[tuple[int, int]]:
    """Matched places of a and b, in order, of the most weight and, of those, over the fewest places of b."""
    table = [[(0, j) for j in range(len(b) + 1)]]
    for x, w in zip(a, weights, strict=True):
        above, row = table[-1], [(0, 0)]
        for j, y in enumerate(b):
            best = max(above[j + 1], row[j])
            if x == y:
                best = max(best, (above[j][0] + w, above[j][1] if above[j][0] else j))
            row.append(best if best[0] else (0, j + 1))
        table.append(row)
    i, j, out = len(a), max(range(len(b) + 1), key=lambda j: (table[-1][j][0], table[-1][j][1] - j)), []
    while i and j and table[i][j][0]:
        if table[i][j] == table[i - 1][j]:
            i -= 1
        elif table[i][j] == table[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


class Template:
    """A template's tokens (a phrase in braces is one token), their places and, as seeds, those of which a covering text must hold one."""

    def __init__(self, name: str, text: str):
        self.name, self.tokens, self.places, self.phrases = name, [], [], []
        for k, part in enumerate(re.split(r"[{}]", text)):
            found = words(part.encode())
            for token in [tuple(found)] if k % 2 else [(w,) for w in found]:
                self.places.append(sum(map(len, self.tokens)))
                self.tokens.append(token)
            self.phrases += [tuple(found)] if k % 2 else []
        self.n, self.counts = sum(map(len, self.tokens)), Counter(self.tokens)
        self.held = [b" %s " % b" ".join(p) for p in self.phrases]
        self.need = frozenset(w for p in self.phrases for w in p)
        self.words = frozenset(w for t in self.tokens for w in t)
        self.weights = [1000 * len(t) if t in self.phrases else 1 for t in self.tokens]
        self.seeds: set[tuple] = set()

    def folded(self, tokens: list[bytes], lo: int, hi: int) -> tuple[list[tuple], list[int]]:
        """The words of a window with the phrases made one token each, and their places."""
        out, at, i = [], [], lo
        while i < min(hi, len(tokens)):
            whole = next((p for p in self.phrases if tokens[i] == p[0] and tuple(tokens[i : i + len(p)]) == p), (tokens[i],))
            out.append(whole)
            at.append(i)
            i += len(whole)
        return out, at


class Templates:
    """The templates, each with its seeds: one phrase, or so many rare words that a covering text must hold one."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST):
        self.least, self.all = least, [Template(name, text) for name, text in templates]
        common = Counter(w for t in self.all for w in t.words)
        for t in self.all:
            held = 0
            for token in [max(t.phrases, key=len)] if t.phrases else sorted(set(t.tokens), key=lambda w: (common[w[0]], -len(w[0]), w)):
                t.seeds.add(token)
                held += t.counts[token]
                if held > (1 - least) * t.n:
                    break

    def scan(self, text: bytes | None) -> dict:
        tokens = words(text)
        have, best = set(tokens), {}
        joined = b" %s " % b" ".join(tokens)
        places: dict[bytes, list[int]] = {}
        for t in self.all:
            if not t.need <= have or not any(s[0] in have for s in t.seeds) or len(t.words & have) < (self.least - 0.5) * len(t.words) or not all(p in joined for p in t.held):
                continue
            if not places:
                for at, w in enumerate(tokens):
                    places.setdefault(w, []).append(at)
            starts = sorted((at, i) for s in t.seeds for at in places.get(s[0], ()) if len(s) == 1 or tuple(tokens[at : at + len(s)]) == s for i, x in zip(t.places, t.tokens, strict=True) if x == s)
            slack, windows = max(4, t.n // 2), []
            for at, i in starts:
                lo, hi = max(0, at - i - slack), at - i + t.n + slack
                if windows and windows[-1][0] <= lo <= windows[-1][0] + slack // 2:
                    windows[-1][1] = max(windows[-1][1], hi)
                else:
                    windows.append([lo, hi])
            for lo, hi in windows:
                seen, at = t.folded(tokens, lo, hi)
                if sum(len(x) * n for x, n in (t.counts & Counter(seen)).items()) < self.least * t.n or not all(p in seen for p in t.phrases):
                    continue
                for align in (patience, compact):
                    pairs = align(t.tokens, seen) if align is patience else compact(t.tokens, seen, t.weights)
                    matched = sum(len(t.tokens[i]) for i, _ in pairs)
                    if matched < self.least * t.n or Counter(t.tokens[i] for i, _ in pairs if t.tokens[i] in t.phrases) != Counter(t.phrases):
                        continue
                    first, last = at[pairs[0][1]], at[pairs[-1][1]] + len(seen[pairs[-1][1]])
                    if last - first > WIDEST * matched:
                        continue
                    found = (matched / t.n, matched, first - last, -first)
                    best[t.name] = max(best.get(t.name, found), found)
                    if last - first == matched:
                        break
        if any(name.startswith("BSD-") for name in best):
            best.pop("LicenseRef-BSD", None)
        matches = [{"license": k, "coverage": c, "matched": n, "first": -first, "last": -first - wide} for k, (c, n, wide, first) in best.items()]
        return {"n_words": len(tokens), "matches": sorted(matches, key=lambda x: (-x["coverage"], -x["matched"], x["license"]))}


def license_matches(docs: DataFrame, *, text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST, into: str = "licenses") -> DataFrame:
    """docs with a struct column into: n_words, and matches (license, coverage, matched words, first and end word), best first."""
    shared = docs.sparkSession.sparkContext.broadcast(Templates(templates, least))

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan = shared.value.scan
        for texts in parts:
            yield pa.array([scan(t) for held in slices(texts) for t in held], pa.struct([("n_words", pa.int64()), ("matches", pa.list_(MATCH))]))

    return docs.withColumn(fresh(docs, into), arrow(run, FOUND)(F.col(text_col).cast("binary")))
