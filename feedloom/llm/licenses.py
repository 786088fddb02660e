"""Licence texts found by the Dice coefficient over word bigrams, in Spark expressions only.

Every line of a text, every sentence of a paragraph that is no line, every block of lines without a blank line between, and the
text as a whole is compared. Templates are whole short licences, the notices that longer ones ask for, and usual lines. Text is
normalised: A-Z lowered, everything but a-z and 0-9 a space. With a and b distinct bigrams on the two sides and c in
common the coefficient is 2c / (a + b); for it to reach ``least``, a must lie between least / (2 - least) * b and
(2 - least) / least * b, so only templates of a fitting size are compared. Since a is at least c, c is at least
least / (2 - least) * b: a unit that matches holds one of a few words or bigrams of the templates, so texts and units without
any of these are left out before their bigrams are made. The comparison stays in its row: nothing is shuffled and nothing joined.

Null and empty texts, and units of fewer than two words, match nothing. Of equal scores the template with the smallest
name wins. Repeated rows are compared each on their own. No rows: no rows out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

LEAST = 0.8

# Texts, notices, leading paragraphs and lines of common licences.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:")
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:")
_BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.")
_ISC_REST = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_GNU = "{} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation{}"
TEMPLATES = {
    "agpl-3.0-notice": _GNU.format(
        "This program", ":", "Affero General Public License", ", either version 3 of the License, or (at your option) any later version."),
    "bsd-2-clause": f"{_BSD} {_BSD_CLAUSES} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD} {_BSD_CLAUSES} {_BSD_THIRD} {_BSD_DISCLAIMER}",
    "bsd-line": "Released under the BSD License.",
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0/"),
    "gpl-2.0-notice": _GNU.format(
        "This program", ";", "General Public License", "; either version 2 of the License, or (at your option) any later version."),
    "isc-text": f"{_ISC} {_ISC_REST}",
    "lgpl-2.1-notice": _GNU.format(
        "This library", ";", "Lesser General Public License", "; either version 2.1 of the License, or (at your option) any later version."),
    "lgpl-3.0-notice": _GNU.format(
        "This program", ":", "Lesser General Public License", ", either version 3 of the License, or (at your option) any later version."),
    "mit-text": f"{_MIT} {_MIT_REST}",
    "mit-warranty": _MIT_REST,
    "spdx-apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "spdx-bsd-3-clause": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-gpl-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-mpl-2.0": "SPDX-License-Identifier: MPL-2.0",
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software."),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "bsd-redistribution": _BSD,
    "bsd-disclaimer": _BSD_DISCLAIMER,
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "isc": _ISC,
    "mit-grant": _MIT,
    "mit-line": "Released under the MIT License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template, in order."""
    words = re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(_UPPER, _LOWER))).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def telling(known: Mapping[str, list[str]], least: float) -> list[str]:
    """Words and bigrams of which every unit that reaches ``least`` with a template holds at least one.

    So many bigrams of each template are one of these or have one of these words that the others are too few for a
    match. Long words, which are seldom found elsewhere, are taken first; then, instead of short words, bigrams.
    """
    chosen: set[str] = set()

    def covered(gram: str) -> bool:
        return gram in chosen or not chosen.isdisjoint(gram.split(" "))

    for grams in known.values():
        need = math.ceil(least / (2 - least) * len(grams) - 1e-9)
        words = {w for g in grams for w in g.split(" ") if len(w) >= 5}
        for more in [*sorted(words, key=lambda w: (-len(w), w)), *sorted(grams, key=lambda g: (-len(g), g))]:
            if sum(not covered(g) for g in grams) < need:
                break
            chosen.add(more)
    return sorted(chosen)


_BORDER = "\x01"  # stands where a sentence ends
_WORD = "a-zA-Z0-9"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once for each row: the lambda variable of an array of one element."""
    return F.transform(F.array(value), use)[0]


def _folded(marks: list[str]) -> str:
    """A pattern of any of the marks in which common beginnings stand once; a space is whatever is between two words."""
    after: dict[str, list[str]] = {}
    for m in marks:
        after.setdefault(m[:1], []).append(m[1:])
    ways = [(f"[^{_WORD}]++" if c == " " else c) + (_folded(rest) if c else "") for c, rest in after.items()]
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def _holds(text: Column, marks: list[str]) -> Column:
    """Whether a text, normalised or not, has one of the marks as whole words."""
    return F.concat(F.lit(" "), text).rlike(f"[^{_WORD}](?i:{_folded(marks)})(?![{_WORD}])")


def _marked(text: Column) -> Column:
    """The normalised text with line breaks, and a border behind every sentence."""
    ended = F.regexp_replace(F.replace(text, F.lit(_BORDER), F.lit(" ")), r"([.!?])(?=[ \t\n])", f"$1{_BORDER}")
    # only ASCII is left, of which nothing but A-Z is lowered
    low = F.lower(F.regexp_replace(ended, f"[^{_WORD}\n{_BORDER}]+", " "))
    return F.regexp_replace(low, f" *{_BORDER} *", _BORDER)


def _units(text: Column, marks: list[str]) -> Column:
    """(unit, unit_no, words with single spaces) of the lines, sentences, blocks and whole of a marked text that have a mark."""
    kind = lambda name, no, x: F.struct(F.lit(name).alias("unit"), no.cast("int").alias("unit_no"), x.alias("body"))
    flat = lambda x: F.trim(F.regexp_replace(x, f"[ \n{_BORDER}]+", " "))
    told = lambda units: F.filter(units, lambda u: _holds(u["body"], marks))

    def sentences(parts: Column, bodies: Column) -> Column:
        said = F.flatten(F.transform(F.filter(parts, lambda x: F.contains(x, F.lit(_BORDER))), lambda x: F.split(x, _BORDER, -1)))
        said = told(F.transform(said, lambda x, i: kind("sentence", i, flat(x))))
        new = lambda s: _bound(
            F.array_intersect(F.transform(s, lambda u: u["body"]), bodies), lambda lines: F.filter(s, lambda u: ~F.array_contains(lines, u["body"])))
        return _bound(said, new)

    def of(parts: Column, bodies: Column) -> Column:
        lines = told(F.transform(bodies, lambda x, i: kind("line", i, x)))
        blocks = F.filter(F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda b: F.contains(b["x"], F.lit("\n")))
        blocks = told(F.transform(blocks, lambda b: kind("block", b["i"], flat(b["x"]))))
        whole = F.when(F.size(parts) > 1, F.array(kind("text", F.lit(0), flat(text))))
        return F.concat(lines, sentences(parts, bodies), blocks, F.coalesce(whole, F.slice(F.array(kind("text", F.lit(0), F.lit(""))), 1, 0)))

    parts = F.split(text, rf"\n[ {_BORDER}]*\n[ \n{_BORDER}]*", -1)
    bodies = F.transform(F.split(text, "\n", -1), lambda x: F.trim(F.replace(x, F.lit(_BORDER), F.lit(" "))))
    return _bound(parts, lambda p: _bound(bodies, lambda b: of(p, b)))


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(key, unit, unit_no, template, score) of every unit that reaches ``least`` with a template: the best one."""
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    known = {n: bigrams(t) for n, t in sorted(templates.items())}
    known = {n: g for n, g in known.items() if g}
    every = sorted({g for grams in known.values() for g in grams})
    if not known:
        return docs.select(F.col(f"`{key}`").alias(key), F.lit("").alias("unit"), F.lit(0).alias("unit_no"), F.lit("").alias("template"),
                           F.lit(0.0).alias("score")).limit(0)
    fewest = min(len(g) for g in known.values())
    marks = telling(known, least)
    # c is at least half of least * (a + b), and a at least least / (2 - least) * b
    enough = least * fewest * (1 + least / (2 - least)) / 2
    low, high = least / (2 - least) - 1e-9, (2 - least) / least + 1e-9

    def pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))

    def best(common: Column, a: Column) -> Column:
        fits = [
            F.when(
                (a >= low * len(g)) & (a <= high * len(g)),
                F.struct((-2.0 * F.size(F.array_intersect(common, F.array(*[F.lit(x) for x in g]))) / (a + len(g))).alias("minus"),
                         F.lit(n).alias("template")),
            )
            for n, g in known.items()
        ]
        return F.array_min(F.filter(F.array(*fits), lambda m: m.isNotNull()))

    def scored(grams: Column) -> Column:
        distinct = lambda common: F.when(F.size(common) >= enough - 1e-9, F.size(F.array_distinct(grams)))
        return _bound(F.filter(grams, lambda g: g.isin(every)), lambda common: _bound(distinct(common), lambda a: best(common, a)))

    # all of it within one expression: a filter on a column of a later select would be pushed down and work that column out again
    match = lambda u: _bound(_bound(F.split(u["body"], " ", -1), pairs), scored)
    hits = F.transform(_bound(_marked(F.col("text")), lambda t: _units(t, marks)), lambda u: F.struct(u["unit"].alias("unit"), u["unit_no"].alias("unit_no"), match(u).alias("m")))
    hits = F.filter(hits, lambda h: -h["m"]["minus"] >= least)
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).filter(_holds(F.col("text"), marks))
    rows = rows.select("id", F.explode(hits).alias("h"))
    return rows.select(F.col("id").alias(key), "h.unit", "h.unit_no", F.col("h.m.template").alias("template"), (-F.col("h.m.minus")).alias("score"))


def scan_sql(templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> str:
    """The same in SQL, without any pruning."""
    rows = ", ".join(
        "('{}', [{}])".format(n, ", ".join(f"'{g}'" for g in bigrams(t))) for n, t in sorted(templates.items()) if bigrams(t))
    return rf"""
with templates(template, grams) as (values {rows}),
plain as (
    select row_number() over () as r, doc_id, regexp_replace(regexp_replace(regexp_replace(
        translate(text, '{_UPPER}' || chr(1), '{_LOWER} '), '([.!?])([ \t\n])', '\1' || chr(1) || '\2', 'g'),
        '[^a-z0-9\n\x01]+', ' ', 'g'), ' *\x01 *', chr(1), 'g') as t
    from documents where text is not null
), blocks as (
    select r, doc_id, t, regexp_split_to_array(t, '\n[ \x01]*\n[ \n\x01]*') as parts,
        list_transform(string_split(t, chr(10)), lambda x: trim(replace(x, chr(1), ' '))) as lines from plain
), said as (
    select r, doc_id, lines, list_transform(flatten(list_transform(list_filter(parts, lambda x: contains(x, chr(1))), lambda x: string_split(x, chr(1)))),
        lambda x: trim(regexp_replace(x, '[ \n]+', ' ', 'g'))) as said from blocks
), units as (
    select r, doc_id, 'line' as unit, unnest(range(len(lines))) as unit_no, unnest(lines) as body from blocks
    union all
    select r, doc_id, 'sentence', no, body from (select r, doc_id, lines, unnest(range(len(said))) as no, unnest(said) as body from said)
    where not list_contains(lines, body)
    union all
    select r, doc_id, 'block', no, body from (select r, doc_id, unnest(range(len(parts))) as no, unnest(parts) as body from blocks)
    where contains(body, chr(10))
    union all
    select r, doc_id, 'text', 0, t from blocks where len(parts) > 1
), words as (
    select r, doc_id, unit, unit_no, string_split(trim(regexp_replace(body, '[ \n\x01]+', ' ', 'g')), ' ') as w from units
), grams as (
    select r, doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g
    from words where len(w) > 1
), scored as (
    select r, doc_id, unit, unit_no, template, 2.0::double * len(list_intersect(g, grams)) / (len(g) + len(grams)) as score
    from grams, templates
)
select doc_id, unit, unit_no::integer as unit_no, template, score from scored where score >= {least}
qualify row_number() over (partition by r, unit, unit_no order by score desc, template) = 1"""
