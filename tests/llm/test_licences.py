"""Licence scan: full licence files, look-alikes, and a plain version with dense vectors and a walk up the path."""

from __future__ import annotations

import functools
import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarmac.llm import licenses

COMMON = "/usr/share/common-licenses"

FILES = [
    ("r/LICENSE", "The MIT License\n"),
    ("r/a/b/x.py", "# Licensed under the Apache License, Version 2.0\ncode"),
    ("r/a/b/y.py", "code only"),
    ("r/a/LICENSE", "nothing known"),
    ("r/c/LICENSE", "Licensed under CC BY-NC 4.0."),
    ("r/c/d/e/z.py", None),
    ("top.py", "code"),
    (None, "Released under the MIT License."),
    ("s/x.py", ""),
]


def test_licences(spark):
    files = spark.createDataFrame([(*f, "q") for f in FILES], "path string, text string, own string")
    found = licenses.scan(files, F.col("path").endswith("LICENSE"))
    got = [(r["row"]["path"], r["own"], r["licence"], r["inherited_from"]) for r in found.collect()]
    want = [
        ("r/LICENSE", "MIT", "MIT", None),
        ("r/a/b/x.py", "Apache-2.0", "Apache-2.0", None),
        ("r/a/b/y.py", None, "MIT", "r"),
        ("r/a/LICENSE", None, "MIT", "r"),
        ("r/c/LICENSE", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        ("r/c/d/e/z.py", None, "CC-BY-NC-4.0", "r/c"),
        ("top.py", None, None, None),
        (None, "MIT", "MIT", None),
        ("s/x.py", None, None, None),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(files.limit(0), F.lit(True)).count() == 0
    assert licenses.scan(files, F.lit(True), templates=[]).where("licence is not null").count() == 0


def test_lines_that_match_hold_a_needed_word():
    frequency = {"the": 900, "under": 40, "license": 5}
    templates = licenses.Templates(licenses.TEMPLATES, frequency, 1000)
    needed = licenses.needed_words(templates)
    hint = licenses._hint(needed)
    rng = random.Random(4)
    words = sorted(templates.idf)
    matched = 0
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(2000)]
    for _, text in licenses.TEMPLATES:
        some = text.split()
        lines += [" ".join(w for w in some if rng.random() < 0.9) for _ in range(5)]
    for line in lines:
        if templates.best(line):
            matched += 1
            assert needed & set(licenses.words_of(line)) and hint.search(line.lower())
    assert matched > 100


def best(text, whole=True):
    templates = licenses.Templates(licenses.TEMPLATES)
    found = licenses.best_unit(text, whole, templates, licenses._hint(licenses.needed_words(templates)))
    return found and found[1]


@pytest.mark.parametrize(
    "file, name",
    [
        ("Apache-2.0", "Apache-2.0"),
        ("BSD", "BSD-3-Clause"),
        ("CC0-1.0", "CC0-1.0"),
        ("GPL-1", "GPL-1.0-only"),
        ("GPL-2", "GPL-2.0-only"),
        ("GPL-3", "GPL-3.0-only"),
        ("LGPL-2", "LGPL-2.0-only"),
        ("LGPL-2.1", "LGPL-2.1-only"),
        ("LGPL-3", "LGPL-3.0-only"),
        ("MPL-1.1", "MPL-1.1"),
        ("MPL-2.0", "MPL-2.0"),
        ("Artistic", None),
        ("GFDL-1.3", None),
    ],
)
def test_full_licence_files(file, name):
    path = os.path.join(COMMON, file)
    if not os.path.exists(path):
        pytest.skip("not on this machine")
    with open(path, errors="replace") as text:
        assert best(text.read()) == name


CLAUSES = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """
3. Neither the name of Example Corp. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
HEADER = """/*
 * thing.c - does things
 *
 * Copyright (C) 2020 Somebody
 *
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; {}
 *
 * This program is distributed in the hope that it will be useful.
 */
int main() {{ return 0; }}
"""


def commented(text):
    return "".join(f" * {line}\n" if line else " *\n" for line in text.splitlines())


@pytest.mark.parametrize(
    "text, name",
    [
        ("BSD 2-Clause License\n\nCopyright (c) 2020, X\n\n" + CLAUSES + DISCLAIMER, "BSD-2-Clause"),
        ("Copyright (c) 2020, X\nAll rights reserved.\n\n" + CLAUSES + DISCLAIMER, "BSD-2-Clause"),
        ("Copyright (c) 2020, X\n\n" + CLAUSES + THIRD + DISCLAIMER, "BSD-3-Clause"),
        ("Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS", "EPL-2.0"),
        ("Eclipse Public License - v 1.0\n", "EPL-1.0"),
        ("GNU GENERAL PUBLIC LICENSE", None),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 4, June 2040", None),
        ("Some Public License, v2.0", None),
        ("BSD License", None),
        ("Boost Software License - Version 1.0 - August 17th, 2003", "BSL-1.0"),
    ],
)
def test_licence_files_that_look_alike(text, name):
    assert best(text) == name


@pytest.mark.parametrize(
    "text, name",
    [
        (HEADER.format("either version 2\n * of the License, or (at your option) any later version."), "GPL-2.0-or-later"),
        (HEADER.format("version 2\n * of the License."), "GPL-2.0-only"),
        (HEADER.format("either version 3\n * of the License, or (at your option) any later version."), "GPL-3.0-or-later"),
        ("/*\n" + commented("Copyright 2020 X\n\n" + CLAUSES + DISCLAIMER) + " */\ncode();\n", "BSD-2-Clause"),
        ("/*\n" + commented("Copyright 2020 X\n\n" + CLAUSES + THIRD + DISCLAIMER) + " */\n", "BSD-3-Clause"),
        ("# SPDX-License-Identifier: GPL-2.0-only\nx = 1", "GPL-2.0-only"),
        ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"),
        ("Released under the apache license, v2.", "Apache-2.0"),
        ("x = 1\n" * 1000, None),
    ],
)
def test_headers(text, name):
    assert best(text, whole=False) == name


# A plain version: words by hand, dense vectors, every unit against every template, a walk up each path.


def plain_words(text):
    words = []
    for token in re.findall(r"[a-z0-9.]+", text.lower()):
        token = token.strip(".")
        if re.fullmatch(r"v?\d+(\.\d+)*", token):
            number = token.removeprefix("v")
            while number.endswith(".0"):
                number = number.removesuffix(".0")
            words.append(number)
        else:
            words += [part for part in token.split(".") if part]
    return words


def plain_units(text, whole):
    lines = (text or "").splitlines()
    units = list(lines)
    for blank in (lambda line: not any(c.isascii() and c.isalnum() for c in line), lambda line: not line.strip()):
        run = []
        for line in [*lines, ""]:
            if blank(line):
                units.append("\n".join(run))
                run = []
            else:
                run.append(line)
    return units + ([text] if whole and text else [])


def plain_scan(files, templates):
    lines = [set(plain_words(line)) for _, text in files for line in (text or "").splitlines()]
    known = {w for _, t in templates for w in plain_words(t)}
    in_lines = Counter(w for line in lines for w in line & known)

    def vector(text):
        return {w: n * (math.log((1 + len(lines)) / (1 + in_lines[w])) + 1) for w, n in Counter(plain_words(text)).items()}

    vectors = [(name, plain_words(text), vector(text)) for name, text in templates]

    def cosine(a, b):
        return sum(a[w] * b.get(w, 0) for w in a) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    def matches(text, whole):
        found = [(0, None)]
        for words in filter(None, map(vector, plain_units(text, whole))):
            for name, template, weights in vectors:
                short = len(template) <= licenses.SHORT
                needed = set(template)
                needed -= licenses.OPTIONAL if short else {w for w in template if w[0] not in "0123456789" or w not in plain_words(name)}
                score = round(cosine(words, weights), 9)
                if needed <= set(words) and score >= (0.6 if short else 0.8):
                    found.append((-score, name))
        return min(found, key=lambda x: (x[0], x[1] or ""))

    matches = functools.cache(matches)
    own = [matches(text, path is not None and path.endswith("LICENSE")) for path, text in files]
    given = {}
    for (path, _), (score, name) in zip(files, own):
        if path and path.endswith("LICENSE") and name:
            given.setdefault(os.path.dirname(path), []).append((score, name))
    result = []
    for (path, _), (score, name) in zip(files, own):
        source = None
        if not name and path is not None:
            at = os.path.dirname(path)
            while at and at not in given:
                at = os.path.dirname(at)
            source = at if at in given else None
        result.append((path, name, round(-score, 6) if name else None, name or (source is not None and min(given[source])[1]) or None, source))
    return result


def test_like_the_plain_version(spark):
    templates = [t for t in licenses.TEMPLATES if t[0] in ("MIT", "GPL-2.0-or-later", "GPL-2.0-only", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0")]
    texts = [
        "The MIT License\n\nfine", "MIT", "GNU General Public License\nv2, June 1991", "nothing\n\nhere", "", None,
        HEADER.format("either version 2 of the License, or (at your option) any later version."), CLAUSES + THIRD + DISCLAIMER,
        CLAUSES + DISCLAIMER, "This work is licensed under the CC0 1.0", "long words " * 30_000 + "\nMIT License",
        "some words\nReleased under the BSD 3-clause license\nand more", "Released under the MIT License but not quite all of it",
    ]
    rng = random.Random(7)
    files = [(None, texts[0]), ("LICENSE", "CC0 1.0 Universal"), ("a/LICENSE", texts[0]), ("a/LICENSE", texts[9]), ("a/LICENSE", texts[0])]
    for _ in range(300):
        folders = [rng.choice("abc") for _ in range(rng.randint(0, 4))]
        # Texts without a licence prevail, and a third of the files are in one folder.
        path = "a/b/hot" if rng.random() < 0.33 else "/".join([*folders, rng.choice(["LICENSE", "x.py", "y.py"])])
        files.append((path, rng.choice(texts[3:6] if rng.random() < 0.6 else texts)))
    frame = spark.createDataFrame([(*f, i, "x", "y") for i, f in enumerate(files)], "path string, text string, row int, licence string, at string")
    found = licenses.scan(frame, F.col("path").endswith("LICENSE"), templates=templates).collect()
    got = [
        (r["row"]["path"], r["own"], r["cosine"] and round(r["cosine"], 6), r["licence"], r["inherited_from"])
        for r in sorted(found, key=lambda r: r["row"]["row"])
    ]
    assert got == plain_scan(files, templates)
    assert len({r[4] for r in got if r[4] is not None}) > 3
