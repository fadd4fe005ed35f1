"""License scans: normalised text against license templates by the Dice coefficient of their word bigrams.

Every line and every whole text is a unit. A unit is lower-cased, its signs become spaces, and its distinct word bigrams
are compared with those of each template: dice = 2 |both| / (|unit| + |template|). A license that is wrapped over lines or
stands inside a longer line is a unit of its own: a span of words, across line ends, from one bigram of a template to
another, of at most 1.5 times the template's places. Of overlapping spans the one with most bigrams in common stays; spans
inside a line or text that is reported with the same license or no less a value are left out. NULL and empty texts have no
units; a unit of one word has no bigram.

No unit of u bigrams reaches a threshold d with a template of t unless it has d t / (2 - d) of them; units with fewer hits of
the templates' bigrams are not opened. Templates are a fixed list of a few kilobytes that every worker has.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import numbered, read, ship, slices, text_bytes

THRESHOLD = 80
WHOLE = -1
SPAN = -2

# What full license texts share.
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. ")
_NO_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
             "software without specific prior written permission. ")
_BSD_WARRANTY = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
                 "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
                 "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                 "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
                 "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                 "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# The wording of common license notices and of short licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
                   "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                         "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
                         "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
                         "PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-2-Clause", _BSD + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD + _NO_NAMES + _BSD_WARRANTY),
    ("ISC", _ISC),
    ("MIT", _MIT),
)


def bigrams_of(text: str) -> list[str]:
    """Distinct bigrams of a template, normalised as units are."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def template_rows() -> list[tuple[int, str, int, str]]:
    """(template, license, size, bigram)."""
    return [(i, name, len(b), x) for i, (name, text) in enumerate(TEMPLATES) for b in [bigrams_of(text)] for x in b]


@cache
def compiled() -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the templates' words, sorted codes of all their bigrams, which template has which (the last column is
    none's), and per template its distinct bigrams and its bigram places."""
    split = [re.findall(r"[a-z0-9]+", text.lower()) for _, text in TEMPLATES]
    number = {w: i for i, w in enumerate(sorted({w for words in split for w in words}), 1)}
    codes = [np.unique([number[a] * (len(number) + 1) + number[b] for a, b in zip(w, w[1:])]) for w in split]
    listed = np.unique(np.concatenate(codes))
    member = np.zeros((len(codes), len(listed) + 1), bool)
    for i, c in enumerate(codes):
        member[i, np.searchsorted(listed, c)] = True
    return {w.encode(): i for w, i in number.items()}, listed, member, member.sum(1), np.array([len(w) - 1 for w in split])


_INSIDE = np.zeros(256, bool)
_INSIDE[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True


def scan(texts: list[bytes], threshold: int = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(row, unit, license, dice) of all units of lower-case texts that reach the threshold."""
    number, listed, member, sizes, places = compiled()
    raw = b"\n".join(texts)
    signs = np.frombuffer(raw, np.uint8)
    inside = _INSIDE[signs]
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    if len(starts) < 2:
        return []
    words = re.findall(rb"[a-z0-9]+", raw)
    first = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    breaks = np.flatnonzero(signs == 10)
    row = np.searchsorted(first, starts, "right") - 1
    line, first_line = np.searchsorted(breaks, starts), np.searchsorted(breaks, first)
    distinct, at = numbered(words)
    own = np.fromiter((number.get(w, 0) for w in distinct), np.int64, len(distinct))[at]
    same = row[1:] == row[:-1]
    code = np.where((own[:-1] > 0) & (own[1:] > 0), own[:-1] * (len(number) + 1) + own[1:], 0)
    term = np.minimum(np.searchsorted(listed, code), len(listed) - 1)
    hit = same & (listed[term] == code)
    term = np.where(hit, term, len(listed))
    pair = at[:-1] * len(distinct) + at[1:]
    fewest = -(-threshold * sizes // (200 - threshold))

    def reached(group: np.ndarray, valid: np.ndarray) -> dict[int, tuple[str, float]]:
        out: dict[int, tuple[str, float]] = {}
        groups, n = np.unique(group[:-1][valid & hit], return_counts=True)
        for g in groups[n >= fewest.min()].tolist():
            a, z = np.searchsorted(group, g, "left"), np.searchsorted(group, g, "right")
            both = member[:, np.unique(term[a:z - 1])].sum(1)
            if not (both >= fewest).any():
                continue
            u = len(np.unique(pair[a:z - 1]))
            # A unit too large or too small for a template cannot reach it, whatever they share.
            near = (threshold * u <= (200 - threshold) * sizes) & (threshold * sizes <= (200 - threshold) * u)
            good = np.flatnonzero(near & (200 * both >= threshold * (u + sizes))).tolist()
            if good:
                _, name, _, dice = min((-(d := float(2 * both[i] / (u + sizes[i]))), TEMPLATES[i][0], i, d) for i in good)
                out[g] = (name, dice)
        return out

    lines, whole = reached(line, same & (line[1:] == line[:-1])), reached(row, same)
    found = [(r, WHOLE, *x) for r, x in whole.items()]
    found += [(r, g - int(first_line[r]), *x) for g, x in lines.items() for r in [int(row[np.searchsorted(line, g)])]]
    earlier = None
    spans: dict[int, list[tuple[int, float, str, int, int, int]]] = {}
    hits = np.flatnonzero(hit)
    for i in range(len(TEMPLATES)):
        own_hits = hits[member[i, term[hits]]]
        k, most = int(fewest[i]), int(-(-3 * places[i] // 2))
        if len(own_hits) < k:
            continue
        ahead = own_hits[k - 1:]
        begin = own_hits[:len(ahead)]
        begin = begin[(ahead - begin < most) & (row[ahead] == row[begin])]
        if len(begin) and earlier is None:
            order = np.argsort(pair, kind="stable")
            earlier = np.full(len(pair), -1)
            earlier[order[1:]] = np.where(pair[order[1:]] == pair[order[:-1]], order[:-1], -1)
        for part in np.array_split(begin, -(-len(begin) // 1024)) if len(begin) else ():
            end = np.searchsorted(row, row[part], "right") - 1
            x = part[:, None] + np.arange(most)
            within = x < end[:, None]
            x = np.minimum(x, len(pair) - 1)
            new = within & (earlier[x] < part[:, None])
            is_hit = within & member[i, term[x]]
            u, both = new.cumsum(1), (new & is_hit).cumsum(1)
            dice = np.where(is_hit & (200 * both >= threshold * (u + sizes[i])), 2 * both / (u + sizes[i]), 0.0)
            best = dice.argmax(1)
            for r in np.flatnonzero(dice.max(1) > 0).tolist():
                s = int(part[r])
                spans.setdefault(int(row[s]), []).append((-int(both[r, best[r]]), -float(dice[r, best[r]]), TEMPLATES[i][0], i, s, s + int(best[r]) + 1))
    for r, own_spans in spans.items():
        origin, taken = int(np.searchsorted(row, r)), []
        for _, dice, name, _, a, z in sorted(own_spans):
            if any(a <= y and x <= z for x, y in taken):
                continue
            taken.append((a, z))
            around = [whole.get(r), lines.get(int(line[a])) if line[a] == line[z] else None]
            if not any(x and (x[0] == name or x[1] >= -dice) for x in around):
                found.append((r, SPAN - (a - origin), name, -dice))
    return found


def matches(docs: DataFrame, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, unit, license, dice) of the best template of every unit that reaches the threshold (percent).

    Units are lines from 0 on, the whole text as -1, and spans as -2 less the number of words before them. Ties go to the
    license first by name. Rows of equal id and text count as one; other rows, also those that share an id or have none, are
    documents of their own. Other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    lower = docs.filter(F.col(text).isNotNull()).select("doc_id", F.xxhash64(F.col(text)).alias("__print"), F.lower(text).alias("__text"))
    schema = T.StructType([lower.schema["doc_id"], lower.schema["__print"], T.StructField("unit", T.LongType()),
                           T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            data, ends = text_bytes(part, "__text")
            rows = scan([bytes(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], threshold)
            if rows:
                r, unit, name, dice = zip(*rows)
                own = [part.column(c).take(pa.array(r, pa.int64())) for c in ("doc_id", "__print")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(unit, pa.int64()),
                                                  pa.array(name, pa.string()), pa.array(dice, pa.float64())], names=schema.names)

    return lower.mapInArrow(run, schema).distinct().drop("__print")


def op3_licenses(spark, sf_dir):
    """License notices and texts in all documents."""
    return matches(read(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE_SQL = f"""
WITH templates(template, license, t, bigram) AS (VALUES {', '.join(f"({i}, {_quoted(a)}, {n}, {_quoted(b)})" for i, a, n, b in template_rows())}),
docs AS (SELECT row_number() OVER () AS d, doc_id, lower(text) AS text FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
lines AS (SELECT d, text AS line, CAST({WHOLE} AS BIGINT) AS unit FROM docs
          UNION ALL
          SELECT d, parts[i] AS line, CAST(i - 1 AS BIGINT) AS unit
          FROM (SELECT d, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT d, string_split(text, chr(10)) AS parts FROM docs))),
words AS (SELECT d, unit, regexp_extract_all(line, '[a-z0-9]+') AS w FROM lines),
pairs AS (SELECT DISTINCT d, unit, w[i] || ' ' || w[i + 1] AS bigram
          FROM (SELECT d, unit, w, unnest(range(1, len(w))) AS i FROM words)),
sizes AS (SELECT d, unit, count(*) AS u FROM pairs GROUP BY ALL),
both_ AS (SELECT p.d, p.unit, s.u, t.template, t.license, t.t, count(*) AS b
          FROM pairs p JOIN templates t USING (bigram) JOIN sizes s ON s.d = p.d AND s.unit = p.unit GROUP BY ALL),
good AS (SELECT d, unit, license, template, CAST(2 * b AS DOUBLE) / (u + t) AS dice FROM both_ WHERE 200 * b >= {THRESHOLD} * (u + t)),
best AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY d, unit ORDER BY dice DESC, license, template) = 1)
SELECT doc_id, unit, license, dice FROM best JOIN docs USING (d)"""
