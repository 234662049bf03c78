"""Licence scan by the Dice coefficient of word bigrams (operator 2).

Texts and templates are normalised alike: A-Z in lower case, words of letters, digits and non-ASCII characters.
A template is compared with every line, every paragraph (between double line feeds), the whole of a text and its
own runs of lines:

    dice = 2 * common bigrams / (bigrams of the segment + bigrams of the template), over distinct bigrams.

A template's run is two or more lines, each with at least half of its bigrams in the template, with no other line
of two words or more between them; the words of the run are all from the first line to the last. So a licence of
several paragraphs, wrapped and behind comment marks, is found inside a longer text.

A dice of at least t needs sizes within t/(2-t) and (2-t)/t of each other, so a segment is only compared with
templates in those bounds; and it needs t/2 of the segment's own bigrams to occur in some template, which a
numpy pass over the Arrow slice finds first.  Both prunings lose nothing.

The templates are a fixed, short list that travels with the code, so their index has a constant size.

Defined results: null, empty and one-word texts match nothing; repeated rows give repeated rows; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textnum import ALNUM_LOWER, Words, text_slices

THRESHOLD = 0.8

#: Licence notices and licence texts: fixed values from the licences' own public wording.
TEMPLATES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "unlicense-opening": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}


class TemplateIndex:
    """Bigram sets of the templates in order of size, and all their bigrams."""

    def __init__(self, templates: Mapping[str, str]):
        self.names, texts = list(templates), [t.encode() for t in templates.values()]
        words = Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), ALNUM_LOWER)
        h, at = words.windows(2)
        doc = np.searchsorted(words.first, at, side="right") - 1
        sets = [(np.unique(h[doc == i]), n) for i, n in enumerate(self.names)]
        self.sets = sorted(((s, n) for s, n in sets if len(s)), key=lambda x: (len(x[0]), x[1]))
        self.sizes = np.array([len(s) for s, _ in self.sets])
        self.all = np.unique(h)
        #: For each template, which of all bigrams it holds.
        self.holds = [np.isin(self.all, own, assume_unique=True) for own, _ in self.sets]

    def known(self, h: np.ndarray) -> np.ndarray:
        if not len(self.all):
            return np.zeros(len(h), bool)
        at = np.searchsorted(self.all, h)
        at[at == len(self.all)] = 0
        return self.all[at] == h

    def matches(self, bigrams: np.ndarray, threshold: float, only: int | None = None) -> list[tuple[float, str]]:
        """(dice, template) at or above the threshold, for templates within the size bounds, or for one of them."""
        n = len(bigrams)
        if only is not None:
            return self._over(bigrams, self.sets[only : only + 1], threshold)
        a, b = np.searchsorted(self.sizes, n * threshold / (2 - threshold) - 1e-9), np.searchsorted(self.sizes, n * (2 - threshold) / threshold + 1e-9, side="right")
        return self._over(bigrams, self.sets[a:b], threshold)

    @staticmethod
    def _over(bigrams: np.ndarray, sets: list[tuple[np.ndarray, str]], threshold: float) -> list[tuple[float, str]]:
        n, out = len(bigrams), []
        for s, name in sets:
            if not threshold * (n + len(s)) <= 2 * min(n, len(s)) + 1e-9:
                continue
            same = len(np.intersect1d(bigrams, s, assume_unique=True))
            if 2 * same >= threshold * (n + len(s)) - 1e-9:
                out.append((2 * same / (n + len(s)), name))
        return out


def _runs(index: TemplateIndex, doc: np.ndarray, line: np.ndarray, at: np.ndarray, h: np.ndarray, hit: np.ndarray):
    """(template, first and end bigram) of the templates' runs of two or more lines, in a slice's bigrams."""
    inside = line[at] == line[at + 1]
    where = line[at[inside]]
    # Lines with bigrams, in order; where each one's bigrams begin and end among all.
    lines, first, total = np.unique(where, return_index=True, return_counts=True)
    if len(lines) < 2:
        return
    begin = np.flatnonzero(inside)[first]
    of = doc[at[begin]]
    known = np.flatnonzero(inside & hit)
    row, which = np.searchsorted(lines, line[at[known]]), np.searchsorted(index.all, h[known])
    if not (2 * np.bincount(row, minlength=len(lines)) >= total).any():
        return
    for t, holds in enumerate(index.holds):
        own = 2 * np.bincount(row[holds[which]], minlength=len(lines)) >= total
        joined = own[1:] & own[:-1] & (of[1:] == of[:-1])
        edge = np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            yield t, int(begin[a]), int(begin[b] + total[b])


def _segments(words: Words) -> list[np.ndarray]:
    """For each way of cutting, the segment number of each word."""
    lines = np.flatnonzero(words.data == 10)
    breaks = lines[:-1][np.diff(lines) == 1] if len(lines) else lines
    doc = words.doc_of_words()
    number = lambda cuts: np.searchsorted(cuts, words.start) + doc  # noqa: E731  both grow, so a new document is a new segment
    return [number(lines), number(breaks), doc]


def licence_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_matches, licences, best_licence, best_dice) of every row: different spans that match some template,
    the templates matched in order of name, and the best match, of equal ones the first by name."""
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates))
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                words, known = Words(data, bounds, ALNUM_LOWER), index.value
                found: list[dict[str, float]] = [{} for _ in range(j - i)]
                count = np.zeros(j - i, np.int64)
                h, at = words.windows(2)
                hit = known.known(h)
                spans: set[tuple[int, int]] = set()  # compared with all templates
                matched: set[tuple[int, int]] = set()

                def take(first: int, end: int, got: list[tuple[float, str]]) -> None:
                    d = int(np.searchsorted(words.first, first, side="right")) - 1
                    if got and (first, end) not in matched:
                        matched.add((first, end))
                        count[d] += 1
                    for dice, name in got:
                        found[d][name] = max(dice, found[d].get(name, 0.0))

                cuts = _segments(words) if hit.any() else []
                for seg in cuts:
                    inside = seg[at] == seg[at + 1]
                    own, where, start = h[inside], seg[at[inside]], at[inside]
                    for s in np.unique(where[hit[inside]]).tolist():
                        part = slice(*np.searchsorted(where, [s, s + 1]).tolist())
                        bigrams = np.unique(own[part])
                        span = (int(start[part.start]), int(start[part.stop - 1]) + 1)
                        # Distinct bigrams decide; a segment with too few known ones cannot match.
                        if span in spans or 2 * int(known.known(bigrams).sum()) < threshold * len(bigrams) - 1e-9:
                            continue
                        spans.add(span)
                        take(*span, known.matches(bigrams, threshold))
                for t, lo, hi in _runs(known, words.doc_of_words(), cuts[0], at, h, hit) if cuts else ():
                    take(int(at[lo]), int(at[hi - 1]) + 1, known.matches(np.unique(h[lo:hi]), threshold, t))
                best = [min(((-v, k) for k, v in f.items()), default=(None, None)) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(count), pa.array([",".join(sorted(f)) for f in found], pa.string()), pa.array([b[1] for b in best], pa.string()), pa.array([None if b[0] is None else round(-b[0], 6) for b in best], pa.float64())],
                    names=[key, "n_matches", "licences", "best_licence", "best_dice"],
                )

    return docs.select(F.col(key), F.col(column)).mapInArrow(run, f"{key} {kind}, n_matches long, licences string, best_licence string, best_dice double")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_GRAMS = "unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
ORACLE_SQL = rf"""
WITH t(name, text) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES.items())}),
tw AS (SELECT name, {_WORDS.format("text")} AS w FROM t),
tb AS (SELECT DISTINCT name, {_GRAMS} AS g FROM tw),
tn AS (SELECT name, count(*) AS n FROM tb GROUP BY name),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, 0 AS k, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
      UNION ALL SELECT r, 1, unnest(string_split(text, chr(10) || chr(10))), generate_subscripts(string_split(text, chr(10) || chr(10)), 1) FROM d
      UNION ALL SELECT r, 2, text, 1 FROM d),
w AS (SELECT r, k, i, {_WORDS.format("s")} AS w FROM s),
p AS (SELECT *, coalesce(sum(len(w)) OVER (PARTITION BY r, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM w),
ln AS (SELECT r, i, a, len(w) AS n, row_number() OVER (PARTITION BY r ORDER BY i) AS q FROM p WHERE k = 0 AND len(w) > 1),
lg AS (SELECT r, i, len(w) - 1 AS n, {_GRAMS} AS g FROM p WHERE k = 0 AND len(w) > 1),
lt AS (SELECT r, i, name FROM lg JOIN tb USING (g) GROUP BY r, i, name, lg.n HAVING 2 * count(*) >= lg.n),
li AS (SELECT r, name, a, n, q - row_number() OVER (PARTITION BY r, name ORDER BY i) AS island FROM lt JOIN ln USING (r, i)),
run AS (SELECT r, name, min(a) AS a, max(a + n) AS b FROM li GROUP BY r, name, island HAVING count(*) > 1),
c AS (SELECT r, NULL AS one, a, w FROM p WHERE len(w) > 1 UNION ALL SELECT r, run.name, run.a, p.w[CAST(run.a AS BIGINT) + 1 : CAST(run.b AS BIGINT)] FROM run JOIN p USING (r) WHERE p.k = 2),
sw AS (SELECT r, one, a, w, row_number() OVER () AS q FROM c),
sb AS (SELECT DISTINCT r, q, one, a, len(w) AS z, {_GRAMS} AS g FROM sw),
sn AS (SELECT r, q, count(*) AS n FROM sb GROUP BY r, q),
m AS (SELECT sb.r, sb.q, a, z, name, count(*) AS c FROM sb JOIN tb USING (g) WHERE one IS NULL OR one = name GROUP BY ALL),
x AS (SELECT m.r, m.a, m.z, name, 2 * c / (sn.n + tn.n) AS dice FROM m JOIN sn ON sn.r = m.r AND sn.q = m.q JOIN tn USING (name) WHERE 2 * c >= {THRESHOLD} * (sn.n + tn.n) - 1e-9),
k AS (SELECT r, count(*) AS n_matches FROM (SELECT DISTINCT r, a, z FROM x) GROUP BY r),
y AS (SELECT r, name, max(dice) AS dice FROM x GROUP BY r, name),
z AS (SELECT r, string_agg(name, ',' ORDER BY name) AS licences, arg_min(name, (-dice, name)) AS best_licence, round(max(dice), 6) AS best_dice FROM y GROUP BY r)
SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences, best_licence, best_dice FROM d LEFT JOIN z USING (r) LEFT JOIN k USING (r)
"""
