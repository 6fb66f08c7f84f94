import math
import random
import re
from collections import Counter

from retourlens.llm import licences
from tests.llm.helpers import rows

SCHEMA = "path string, text string, licence string, own string"


def cosine(first, second, weights):
    def vector(text):
        counts = Counter(re.findall(licences.TOKEN, text.lower()))
        return {t: n * weights.idf.get(t, weights.other) for t, n in counts.items()}

    a, b = vector(first), vector(second)
    length = math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    return sum(w * b.get(t, 0) for t, w in a.items()) / length if length else 0


def scan(spark, files):
    table = spark.createDataFrame([(p, t, "clash", "x") for p, t in files], SCHEMA)
    return licences.scan(table, carry=["path", "own"])


def test_nearest_ancestor_counts(spark):
    mit, apache, gpl = (licences.TEMPLATES[n][0] for n in ("MIT", "Apache-2.0", "GPL-3.0-only"))
    found = scan(spark, [
        ("LICENSE", mit), ("a/LICENSE.txt", apache), ("a/b/c/x.py", "print()"), ("a/b/COPYING", "no licence here"),
        ("z/y.py", None), ("top.py", ""), ("a/own.py", f"# header\n# {gpl}\ncode"), (None, mit), (None, None),
        ("ab/x.py", "under the tree"), ("a/b/c/x.py", "print()"), ("b/LICENSE", mit), ("b/COPYING", apache), ("b/q", "-"),
    ])
    assert found.columns == ["path", "own", "own_licence", "own_score", "licence", "inherited_from"]
    got = rows(found, "path", "own_licence", "licence", "inherited_from")
    assert got == sorted([
        ("LICENSE", "MIT", "MIT", None), ("a/LICENSE.txt", "Apache-2.0", "Apache-2.0", None),
        ("a/b/c/x.py", None, "Apache-2.0", "a"), ("a/b/COPYING", None, "Apache-2.0", "a"), ("z/y.py", None, "MIT", ""),
        ("top.py", None, "MIT", ""), ("a/own.py", "GPL-3.0-only", "GPL-3.0-only", None), (None, "MIT", "MIT", None),
        (None, None, None, None), ("ab/x.py", None, "MIT", ""), ("a/b/c/x.py", None, "Apache-2.0", "a"),
        ("b/LICENSE", "MIT", "MIT", None), ("b/COPYING", "Apache-2.0", "Apache-2.0", None), ("b/q", None, "Apache-2.0", "b"),
    ], key=repr)


def passages(text):
    """Lines, sentences of lines, paragraphs of several lines."""
    lines = text.split("\n")
    sentences = [s for line in lines if re.search(licences.SENTENCE_END, line) for s in re.split(licences.SENTENCE_END, line)]
    return lines + sentences + [p for p in re.split(licences.PARAGRAPH_END, text) if "\n" in p]


def test_scores_against_plain_cosine(spark):
    weights, listed = licences.Weights.of(licences.TEMPLATES), licences.listed(licences.TEMPLATES)
    texts = [
        *[t for _, t in listed], "released under the mit license and nothing else", "Licensed under CC BY 4.0",
        "THIS WORK IS LICENSED UNDER THE GNU LESSER GENERAL PUBLIC LICENSE VERSION 3", "the license", "under under under", "",
        "# This file is\n# released under\n# the MIT License.\n#\n# other words", "one. Released under the MIT License. two",
    ]
    got = {r["path"]: r for r in scan(spark, [(f"f{i}.c", t) for i, t in enumerate(texts)]).collect()}
    for i, text in enumerate(texts):
        best = max(round(cosine(p, t, weights), 6) for p in passages(text) for _, t in listed)
        row = got[f"f{i}.c"]
        assert row["own_score"] == (best if best >= licences.LEAST_SCORE else None)
    assert all(got[f"f{i}.c"]["own_licence"] == name for i, (name, _) in enumerate(listed))


def test_anchors_miss_no_passage():
    """No passage made of template words reaches the score without an anchor."""
    weights = licences.Weights.of(licences.TEMPLATES)
    anchors = set(weights.anchors(licences.LEAST_SCORE))
    assert not anchors & {"the", "this", "of", "your", "and"}
    for _, text in licences.listed(licences.TEMPLATES):
        rest = " ".join(t for t in re.findall(licences.TOKEN, text.lower()) if t not in anchors)
        assert cosine(rest, text, weights) < licences.LEAST_SCORE


TAGS = [
    "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense",
]
WORDINGS = [
    *[(name, f"{mark} SPDX-License-Identifier: {name}\nint main() {{}}") for name in TAGS for mark in ("//", " *")],
    ("MIT", "Copyright 2020 Jane Roe. Released under the MIT License."), ("MIT", "MIT License\n\nCopyright (c) 2021 Ann Other"),
    ("MIT", "The MIT License (MIT)\nCopyright 1999"), ("MIT", "# Licensed under the MIT license."),
    ("MIT", "/* this file is released under the MIT license */"), ("MIT", "-- This code is released under the MIT License."),
    ("Apache-2.0", "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance\n# with the License.\n"),
    ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n"),
    ("Apache-2.0", "code is licensed under the Apache License, version 2.0"), ("Apache-2.0", "Apache License 2.0"),
    ("GPL-3.0-or-later", "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n"),
    ("LGPL-3.0-or-later", " * This library is free software: you can redistribute it and/or modify it\n * under the terms of the GNU Lesser General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or (at\n * your option) any later version.\n"),
    ("GPL-3.0-or-later", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n"),
    ("MPL-2.0", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"),
    ("MPL-2.0", "Mozilla Public License Version 2.0\n=================================="), ("ISC", "ISC License\n\nCopyright (c) 2019"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its\n  contributors may be used to endorse or promote products derived from\n  this software without specific prior written permission.\n"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International (CC BY 4.0)"), ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
NEGATIVES = [
    "The committee granted a license to the driver.", "mit der Zeit und mit dem Rad", "Version 2.0 was released in January.",
    "This software is subject to change without notice.", "The public library is free for all persons.", "SPDX-License-Identifier: Zlib",
    "He was licensed to teach under the new rules.", "Apache helicopters were seen.", "copyright 2020 all rights reserved",
    "permission to publish was refused by the foundation", "See the terms of use on our website.", "creative commons are meadows",
]


def test_wordings_of_real_files(spark):
    """Tags, titles, headers over several lines and grants: of those with a licence nine in ten are found, of others none."""
    files = [(f"d{i}/f.c", t) for i, (_, t) in enumerate(WORDINGS)] + [(f"n{i}/f.c", t) for i, t in enumerate(NEGATIVES)]
    got = {r["path"]: r["own_licence"] for r in scan(spark, files).collect()}
    found = [got[f"d{i}/f.c"] for i in range(len(WORDINGS))]
    right = sum(f == name for f, (name, _) in zip(found, WORDINGS))
    named = sum(f is not None for f in found)
    assert len(WORDINGS) >= 50 and right >= 0.9 * len(WORDINGS), [(f, w) for f, w in zip(found, WORDINGS) if f != w[0]]
    assert right >= 0.95 * named
    assert [t for i, t in enumerate(NEGATIVES) if got[f"n{i}/f.c"]] == []


def test_columns_of_any_name(spark):
    table = spark.createDataFrame([("a/LICENSE", "MIT License", 1, 2, 3, 4, 5)], "path string, text string, above int, dir int, given int, own int, row int")
    found = licences.scan(table)
    assert found.columns == [*table.columns, *licences.RESULTS]
    assert found.first()["licence"] == "MIT" and found.first()["above"] == 1 and found.first()["row"] == 5


def test_long_licence_file_and_empty_table(spark):
    long = "\n".join(["word another third"] * 30_000 + [licences.TEMPLATES["MIT"][0]])
    assert scan(spark, [("p/LICENSE", long)]).first()["own_licence"] == "MIT"
    assert scan(spark, []).count() == 0


def test_shared_beginnings_match_the_same_words():
    words = licences.Weights.of(licences.TEMPLATES).anchors(0.8)
    pattern = re.compile(rf"(?<![a-z0-9]){licences.any_of(words)}(?![a-z0-9])")
    plain = re.compile(rf"(?<![a-z0-9])(?:{'|'.join(map(re.escape, words))})(?![a-z0-9])")
    r = random.Random(4)
    for _ in range(3000):
        word = r.choice(words)
        at = r.randrange(len(word) + 1)
        text = r.choice([word, word[:at], word + "s", "x" + word, f"{word[:at]}-{word}", f"a {word}."])
        assert bool(pattern.search(text)) == bool(plain.search(text))
    assert all(pattern.search(w)[0] for w in words)
