"""Licence scan: cosine of headers and licence files to templates, and inheritance by directory.

Every line of a file is a possible notice, and so is every paragraph (lines with words, up to one without) and
every block (lines up to an empty one, as of a comment); a licence file is compared as a whole as well.
These units become sparse TF-IDF vectors over the words of the templates: frequencies are counted in the
unit, document frequencies over all lines of all files. Words outside the templates add to a unit's
length like the rarest word, so a long sentence that mentions a licence's words in passing stays far
from it. A file's licence is the template with the largest cosine of any of its units, among those that reach
``LEAST`` (short templates) or ``LEAST_LONG``; ties go to the smaller identifier.

Templates are titles, notices and whole short licences. Two rules keep apart what has nearly the same words: a
short template is a candidate only where all its words occur (but articles and the like), a long one only where
the version occurs that its identifier and text name. A version is one word, however it is written (v2, 2.0).

A file without one inherits from the nearest directory above it whose licence file has one, by a
join of every ancestor path with the licence files' directories.

Templates are few and broadcast after a check of their number. Texts without a word that some template needs,
which are nearly all, are only counted. Texts are read twice, for the frequencies and for the cosines; what was found
is stored without them, and the joins start from there. Counts of words and the best licence of a
directory are aggregated map-side; nothing is gathered by directory.

Odd input: a null text has no lines, and a null path no directory; such files inherit nothing and
a null path is no licence file; equal paths are separate files, of whose licences the directory gets the
one with the larger cosine, ties to the smaller name; repeated rows stay; very long texts are read whole, their
largest unit at a time; an empty table gives no rows; no templates match nothing. Only path and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

#: Least cosine that counts as a match, of short templates (whose words must all occur) and of long ones.
LEAST = 0.6
LEAST_LONG = 0.8
MAX_TEMPLATES = 10_000

#: Templates of at most so many words must occur with all of them.
SHORT = 12
#: Words that a short template may lack.
OPTIONAL = frozenset({"a", "is", "the", "this", "under", "v", "version"})

# Titles of licences, the notices they recommend and whole short licences, by SPDX identifier.
TITLES = {
    "0BSD": ["Zero-Clause BSD", "BSD Zero Clause License"],
    "AGPL-3.0-only": [
        "GNU Affero General Public License, version 3",
        "GNU Affero General Public License Version 3, 19 November 2007",
    ],
    "Apache-2.0": [
        "Apache License, Version 2.0",
        "Apache License Version 2.0, January 2004",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD 3-Clause License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License - Version 1.0 - August 17th, 2003"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["CC0 1.0", "Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal"],
    "EPL-1.0": ["Eclipse Public License - v 1.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0"],
    "GPL-1.0-only": ["GNU General Public License, version 1", "GNU General Public License Version 1, February 1989"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License Version 2, June 1991"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License Version 3, 29 June 2007"],
    "ISC": ["ISC License"],
    "LGPL-2.0-only": [
        "GNU Library General Public License, version 2",
        "GNU Library General Public License Version 2, June 1991",
    ],
    "LGPL-2.1-only": [
        "GNU Lesser General Public License, version 2.1",
        "GNU Lesser General Public License Version 2.1, February 1999",
    ],
    "LGPL-3.0-only": [
        "GNU Lesser General Public License, version 3",
        "GNU Lesser General Public License Version 3, 29 June 2007",
    ],
    "MIT": ["MIT License", "The MIT License (MIT)"],
    "MPL-1.1": ["Mozilla Public License, version 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0"],
}
PROGRAM = "This program is free software; you can redistribute it and/or modify it under the terms of the "
LIBRARY = "This library is free software; you can redistribute it and/or modify it under the terms of the "
PUBLISHED = "as published by the Free Software Foundation"
LATER = "of the License, or (at your option) any later version."
BSD_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce "
    "the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution. "
)
BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies."
ISC_REST = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
NOTICES = {
    "0BSD": [ISC_GRANT + ".", ISC_GRANT + "." + ISC_REST],
    "AGPL-3.0-only": [f"{PROGRAM} GNU Affero General Public License {PUBLISHED}, version 3 of the License."],
    "AGPL-3.0-or-later": [f"{PROGRAM} GNU Affero General Public License {PUBLISHED}, either version 3 {LATER}"],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
    ],
    "BSD-2-Clause": [BSD_CLAUSES + BSD_DISCLAIMER],
    "BSD-3-Clause": [BSD_CLAUSES + BSD_THIRD + BSD_DISCLAIMER],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    ],
    "GPL-2.0-only": [
        f"{PROGRAM} GNU General Public License {PUBLISHED}; version 2 of the License.",
        f"{PROGRAM} GNU General Public License version 2 {PUBLISHED}.",
    ],
    "GPL-2.0-or-later": [f"{PROGRAM} GNU General Public License {PUBLISHED}; either version 2 {LATER}"],
    "GPL-3.0-only": [f"{PROGRAM} GNU General Public License {PUBLISHED}, version 3 of the License."],
    "GPL-3.0-or-later": [f"{PROGRAM} GNU General Public License {PUBLISHED}, either version 3 {LATER}"],
    "ISC": [ISC_GRANT + ISC_NOTICE, ISC_GRANT + ISC_NOTICE + ISC_REST],
    "LGPL-2.1-only": [f"{LIBRARY} GNU Lesser General Public License {PUBLISHED}; version 2.1 of the License."],
    "LGPL-2.1-or-later": [f"{LIBRARY} GNU Lesser General Public License {PUBLISHED}; either version 2.1 {LATER}"],
    "LGPL-3.0-or-later": [f"{LIBRARY} GNU Lesser General Public License {PUBLISHED}; either version 3 {LATER}"],
    "MIT": [MIT_GRANT, MIT_GRANT + MIT_REST],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: (identifier, text): each title in the usual phrases, the identifier in its tag, and the notices.
PHRASES = ["{}", "Licensed under the {}", "Released under the {}", "This work is licensed under the {}"]
TEMPLATES = (
    [(i, phrase.format(title)) for i, titles in TITLES.items() for title in titles for phrase in PHRASES]
    + [(i, f"SPDX-License-Identifier: {i}") for i in sorted({*TITLES, *NOTICES})]
    + [(i, notice) for i, notices in NOTICES.items() for notice in notices]
)

# A version number is one word; a dot elsewhere parts words.
_WORD = re.compile(r"v?[0-9]+(?:\.[0-9]+)+(?![a-z0-9])|[a-z0-9]+")
_HAS_WORD = re.compile(r"[A-Za-z0-9]")
_VERSION = re.compile(r"v?([0-9]+(?:\.[0-9]+)*?)(?:\.0)*")


def _plain(word: str) -> str:
    version = _VERSION.fullmatch(word)
    return version[1] if version else word


def words_of(text: str) -> list[str]:
    """Words in lower case; ``v2``, ``2.0`` and ``2`` are the same version."""
    return [w if w[-1] > "9" else _plain(w) for w in _WORD.findall(text.lower())]


def units_of(text: str | None, whole: bool) -> Iterator[str]:
    """Candidate notices: lines, paragraphs and blocks of several lines, and for a licence file its whole text."""
    if not text:
        return
    lines = text.splitlines()
    yield from lines
    run: list[str] = []
    block: list[str] = []
    paragraphs = 0
    for line in [*lines, ""]:
        if _HAS_WORD.search(line):
            run.append(line)
        elif run:
            if len(run) > 1:
                yield "\n".join(run)
            run, paragraphs = [], paragraphs + 1
        if line.strip():
            block.append(line)
        elif block:
            if paragraphs > 1:
                yield "\n".join(block)
            block, paragraphs = [], 0
    if whole and len(lines) > 1:
        yield text


class Templates:
    """Template vectors for given document frequencies."""

    def __init__(
        self,
        texts: list[tuple[str, str]],
        frequency: dict[str, int] | None = None,
        lines: int = 0,
        least: float = LEAST,
        least_long: float = LEAST_LONG,
    ):
        texts = sorted(texts)
        self.names = [name for name, _ in texts]
        words = [Counter(words_of(text)) for _, text in texts]
        self.required = [required_words(name, list(counts.elements())) for name, counts in zip(self.names, words)]
        self.least = [least if counts.total() <= SHORT else least_long for counts in words]
        frequency = frequency or {}
        self.rare = self.idf_of(0, lines)
        self.idf = {w: self.idf_of(frequency.get(w, 0), lines) for counts in words for w in counts}
        self.postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for number, counts in enumerate(words):
            norm = math.sqrt(sum((n * self.idf[w]) ** 2 for w, n in sorted(counts.items())))
            for w, n in sorted(counts.items()):
                self.postings[w].append((number, n * self.idf[w] / norm))

    @staticmethod
    def idf_of(frequency: int, lines: int) -> float:
        return math.log((1 + lines) / (1 + frequency)) + 1

    def best(self, line: str) -> tuple[float, str] | None:
        """The largest cosine that suffices and its template's identifier, ties to the smaller one."""
        counts = Counter(words_of(line))
        known = {w: n for w, n in counts.items() if w in self.postings}
        if not known:
            return None
        square = sum((n * self.idf.get(w, self.rare)) ** 2 for w, n in sorted(counts.items()))
        scores: dict[int, float] = defaultdict(float)
        for w, n in sorted(known.items()):
            for number, weight in self.postings[w]:
                scores[number] += n * self.idf[w] * weight
        length = math.sqrt(square)
        fit = [
            (-round(min(1.0, score / length), 12), self.names[number])
            for number, score in scores.items()
            if self.required[number] <= known.keys() and round(score / length, 12) >= self.least[number]
        ]
        return (-min(fit)[0], min(fit)[1]) if fit else None


def required_words(name: str, words: list[str]) -> frozenset[str]:
    """Words without which a template does not match: all of a short one, the version in a long one."""
    if len(words) <= SHORT:
        return frozenset(words) - OPTIONAL or frozenset(words)
    return frozenset(w for w in words_of(name) if w[0].isdigit()).intersection(words)


def _hint(words) -> re.Pattern:
    """Finds any of the words, versions in every form."""
    forms = [f"v?{re.escape(w)}(?:\\.0)*" if w[0].isdigit() else re.escape(w) for w in sorted(words)]
    return re.compile(r"(?<![a-z0-9])(?:" + "|".join(forms) + r")(?![a-z0-9])")


def _count(known: frozenset[str]):
    """Lines in all, and lines with each template word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column("text"):
                for line in (text.as_py() or "").splitlines():
                    seen[""] += 1
                    seen.update(known.intersection(words_of(line)))
            yield pa.record_batch({"word": list(seen), "n": pa.array(list(seen.values()), pa.int64())})

    return count


def best_unit(text: str | None, whole: bool, templates: Templates, hint: re.Pattern) -> tuple[float, str] | None:
    """The largest cosine of a unit with a word that some template needs."""
    if not text or not hint.search(text.lower()):
        return None
    scores = (templates.best(unit) for unit in units_of(text, whole) if hint.search(unit.lower()))
    return min((s for s in scores if s), key=lambda s: (-s[0], s[1]), default=None)


def _match(templates: Templates):
    """Replaces the texts by their licence and its cosine."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hint = _hint(needed_words(templates)) if templates.postings else None
        for batch in batches:
            found = []
            for text, whole in zip(batch.column("text"), batch.column("whole").to_pylist()):
                best = best_unit(text.as_py(), whole, templates, hint) if hint else None
                found.append(best or (None, None))
            kept = [batch.column(name) for name in ("row", "path", "whole")]
            licence = pa.array([f[1] for f in found], pa.string())
            cosine = pa.array([f[0] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*kept, licence, cosine], ["row", "path", "whole", "licence", "cosine"])

    return match


def needed_words(templates: Templates) -> set[str]:
    """Words of which any unit that matches some template has one.

    The heaviest of the words a template requires is enough for it. Of a template that requires none, the
    heaviest words are taken until the rest of its unit vector is shorter than the least cosine.
    """
    needed: set[str] = set()
    weights: dict[int, dict[str, float]] = defaultdict(dict)
    for word, postings in templates.postings.items():
        for number, weight in postings:
            weights[number][word] = weight
    for number, words in weights.items():
        heaviest = sorted(words, key=lambda w: (-words[w], w))
        required = [w for w in heaviest if w in templates.required[number]]
        names = [w for w in required if not w[0].isdigit()]
        if names:
            needed.add(names[0])
            continue
        left = 1.0
        for word in heaviest:
            if left < templates.least[number] ** 2 - 1e-9:
                break
            needed.add(word)
            left -= words[word] ** 2
    return needed


def directory(path: Column) -> Column:
    """The path up to its last slash, empty at the top."""
    return F.regexp_replace(F.regexp_replace(path, r"[^/]*$", ""), r"/$", "")


def scan(
    files: DataFrame,
    is_licence_file: Column,
    path_col: str = "path",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    least: float = LEAST,
    least_long: float = LEAST_LONG,
) -> DataFrame:
    """(row, own, cosine, licence, inherited_from) per file; ``row`` is its input row without the text.

    ``own`` is the licence of the file's text, ``licence`` that or the inherited one.
    """
    texts = TEMPLATES if templates is None else templates
    if len(texts) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = files.select(
        F.struct(*[F.col(f"`{c}`") for c in files.columns if c != text_col]).alias("row"),
        F.col(path_col).cast("string").alias("path"),
        F.col(text_col).cast("string").alias("text"),
        (F.coalesce(is_licence_file, F.lit(False)) & F.col(path_col).isNotNull()).alias("whole"),
    )
    known = frozenset(Templates(texts).idf)
    counts = rows.select("text").mapInArrow(_count(known), "word string, n long")
    frequency = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    model = Templates(texts, frequency, frequency.get("", 0), least, least_long)

    row_type = rows.schema["row"].dataType.simpleString()
    found = f"row {row_type}, path string, whole boolean, licence string, cosine double"
    own = stored(rows.mapInArrow(_match(model), found), "licences")
    directories = (
        own.where("whole and licence is not null")
        .groupBy(directory(F.col("path")).alias("directory"))
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "licence")).alias("first"))
        .select("directory", F.col("first.licence").alias("given"))
    )
    # Every directory above a file without licence, the nearest first; each directory once.
    lacking = own.where("licence is null and path is not null").withColumn("at", directory(F.col("path")))
    names = F.split("at", "/")
    above = (
        lacking.select("at")
        .distinct()
        .select(
            "at",
            F.explode(
                F.transform(
                    F.sequence(F.size(names), F.lit(0), F.lit(-1)),
                    lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"),
                )
            ).alias("directory"),
        )
    )
    nearest = (
        above.join(directories, "directory")
        .groupBy("at")
        .agg(F.max_by(F.struct("directory", "given"), F.length("directory")).alias("found"))
    )
    inherited = lacking.join(nearest, "at", "left").select(
        "row", "licence", "cosine", F.col("found.given").alias("given"), F.col("found.directory").alias("inherited_from")
    )
    # Files with a licence of their own, or without a path, take no part in the joins.
    rest = own.where("licence is not null or path is null").select(
        "row", "licence", "cosine", F.lit(None).cast("string").alias("given"), F.lit(None).cast("string").alias("inherited_from")
    )
    return rest.unionAll(inherited).select(
        "row", F.col("licence").alias("own"), "cosine", F.coalesce("licence", "given").alias("licence"), "inherited_from"
    )
