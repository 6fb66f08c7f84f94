"""Licence scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retourlens.llm.tables import whole_text
from retourlens.session import settle

#: Cosine from which a passage counts as a template's.
LEAST_SCORE = 0.8
RESULTS = ["own_licence", "own_score", "licence", "inherited_from"]

# Notices, titles, grants and tags by SPDX identifier (public texts), and names of licence files.
_GNU = (
    "is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the "
    "Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met:"
)
_BSD_NAME = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BY = "This work is licensed under a Creative Commons {name} 4.0 International License."
TEMPLATES = {
    "AGPL-3.0-or-later": [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        _GNU.format(name="GNU Affero General Public License", version=3), "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an '
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "Apache License 2.0", "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Distributed under the BSD 2-Clause License.", "BSD 2-Clause License", "Simplified BSD License", "SPDX-License-Identifier: BSD-2-Clause", _BSD,
    ],
    "BSD-3-Clause": [
        "Distributed under the BSD 3-Clause License.", "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause", _BSD_NAME,
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.", _BY.format(name="Attribution"), "Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.", _BY.format(name="Attribution-NonCommercial"), "Creative Commons Attribution-NonCommercial 4.0 International",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.", _BY.format(name="Attribution-ShareAlike"), "Creative Commons Attribution-ShareAlike 4.0 International",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0-1.0": [
        "Dedicated to the public domain under CC0 1.0.", "CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal Public Domain Dedication",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL-2.0-or-later": [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", _GNU.format(name="GNU General Public License", version=2),
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "GPL-3.0-or-later": [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _GNU.format(name="GNU General Public License", version=3),
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Released under the ISC License.", "ISC License", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-3.0-only": ["This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "LGPL-3.0-or-later": [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _GNU.format(name="GNU Lesser General Public License", version=3),
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "MIT": [
        "Released under the MIT License.", "This file is released under the MIT License.", "MIT License", "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT", "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "Subject to the terms of the Mozilla Public License, version 2.0.", "Mozilla Public License Version 2.0", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.", "The Unlicense", "SPDX-License-Identifier: Unlicense",
    ],
}
#: Words of any prose, by which no passage should be recognised.
COMMON = frozenset(
    "a all an and any as at be by can code either except file following for found free from general in including is it later "
    "may must name names no not of on one option or person persons products public purpose required rights source "
    "specific subject terms that the this to under universal use version with without work written you your".split()
)
#: What ends a sentence within a line, and what parts paragraphs.
SENTENCE_END, PARAGRAPH_END = r"[.;:!?][ \t]+", r"\n[ \t#*/;-]*\n"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|notice)([._-].*)?$"
TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Weights:
    """TF-IDF of the templates: idf by token, the idf of any other token, and each template's licence and unit vector."""

    idf: dict[str, float]
    other: float
    templates: list[tuple[str, dict[str, float]]]

    @classmethod
    def of(cls, templates: dict[str, list[str]]) -> Weights:
        counts = [(name, Counter(re.findall(TOKEN, text.lower()))) for name, text in listed(templates)]
        df = Counter(token for _, c in counts for token in c)
        idf = {token: math.log((1 + len(counts)) / (1 + n)) + 1 for token, n in sorted(df.items())}
        vectors = []
        for name, c in counts:
            raw = {token: n * idf[token] for token, n in sorted(c.items())}
            length = math.sqrt(sum(w * w for w in raw.values()))
            vectors.append((name, {token: w / length for token, w in raw.items()}))
        return cls(idf, math.log(1 + len(counts)) + 1, vectors)

    def anchors(self, least: float) -> list[str]:
        """Tokens of which any passage with a score of ``least`` has one.

        A cosine is at most the length of the part of the template that the
        passage shares, so tokens can be left out as long as together they are
        shorter than that: first those that any prose has, then the short ones.
        Which ones are left out changes no result.
        """
        found = set()
        for _, vector in self.templates:
            used = 0.0
            for token, weight in sorted(vector.items(), key=lambda kv: (kv[0] not in COMMON, len(kv[0]), kv[0])):
                used += weight * weight
                if used >= least * least * 0.999:
                    found.add(token)
        return sorted(found)


def listed(templates: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(licence, text) of all templates, in the order that settles ties."""
    return [(name, text) for name, texts in sorted(templates.items()) for text in texts]


def _map(values: dict, kind: str) -> Column:
    """A constant map; as one text to read, which Spark folds, in place of a node for each number."""
    return F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")


def any_of(words: list[str]) -> str:
    """A pattern for one of the words, which shares their beginnings so that few are tried at a place."""
    if len(words) < 2:
        return re.escape("".join(words))
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[:1], []).append(word[1:])
    ends = "" in groups
    parts = [re.escape(first) + any_of(sorted(set(rest))) for first, rest in sorted(groups.items()) if first]
    return f"(?:{'|'.join(parts)})" + "?" * ends


def _score(passage: Column, weights: Weights, least: float) -> Column:
    """Best (score, minus the template's number) of a passage; ties to the first template.

    Null if the score must be under ``least``: unknown tokens lengthen a passage
    without adding to its part along any template, which is at most as long as if
    all its known tokens were one of the rarest.
    """
    tokens = F.regexp_extract_all(F.translate(passage, UPPER, LOWER), F.lit(f"({TOKEN})"))
    shares = {token: [vector.get(token, 0.0) * idf for _, vector in weights.templates] for token, idf in weights.idf.items()}

    top = max(weights.idf.values(), default=0.0)

    def near(both: Column) -> Column:
        along = F.pow(F.size(both["known"]) * F.lit(top), F.lit(2.0))
        aside = (F.size(both["words"]) - F.size(both["known"])) * F.lit(weights.other**2)
        return along >= F.lit(least * least * 0.999) * (along + aside)

    def best(words: Column, known: Column) -> Column:
        start = F.struct(F.lit("").alias("token"), F.lit(0.0).alias("n"), F.lit(0.0).alias("sum"))
        weight = lambda t: F.coalesce(F.try_element_at(_map(weights.idf, "double"), t), F.lit(weights.other))

        def run(state: Column, token: Column) -> Column:
            # n occurrences add n * n, so one more adds 2 n + 1.
            n = F.when(state["token"] == token, state["n"]).otherwise(F.lit(0.0))
            more = (2 * n + 1) * weight(token) * weight(token)
            return F.struct(token.alias("token"), (n + 1).alias("n"), (state["sum"] + more).alias("sum"))

        length = F.aggregate(F.array_sort(words), start, run, lambda s: F.sqrt(s["sum"]))
        vectors = F.transform(known, lambda t: F.try_element_at(_map(shares, "array<double>"), t))
        dots = F.aggregate(vectors, F.array_repeat(F.lit(0.0), len(weights.templates)), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
        both = F.array(F.struct(dots.alias("dots"), length.alias("length")))

        def scores(b: Column) -> Column:
            return F.transform(b["dots"], lambda dot, i: F.struct(F.round(dot / b["length"], 6).alias("score"), (-i).alias("place")))

        return F.array_max(F.element_at(F.transform(both, scores), 1))

    # Arrays of one, so that tokens, and then their sums, are worked out once.
    split = F.transform(F.array(tokens), lambda t: F.struct(t.alias("words"), F.filter(t, lambda w: w.isin(list(weights.idf))).alias("known")))
    scored = lambda both: F.when((F.size(both["words"]) > 0) & near(both), best(both["words"], both["known"]))
    return F.element_at(F.transform(split, scored), 1)


def own_licences(
    files: DataFrame, weights: Weights, least: float = LEAST_SCORE, text: str = "text", path: str = "path"
) -> Column:
    """(score, licence) of the best passage of a file, or null.

    Passages are its lines, the sentences of a line, paragraphs of several
    lines, and, for files named as licences, the whole text; all of them with a
    token that a licence notice must have.
    """
    must = any_of(weights.anchors(least))
    may = lambda passage: passage.rlike(rf"(?i)(?<![a-z0-9]){must}(?![a-z0-9])")
    named = F.coalesce(F.regexp_extract(path, r"([^/]*)$", 1).rlike(LICENCE_FILE), F.lit(False))

    def passages(whole: Column) -> Column:
        lines = F.filter(F.split(whole, "\n"), may)
        sentences = F.filter(F.flatten(F.transform(F.filter(lines, lambda x: x.rlike(SENTENCE_END)), lambda x: F.split(x, SENTENCE_END))), may)
        paragraphs = F.filter(F.split(whole, PARAGRAPH_END), lambda p: p.contains("\n") & may(p))
        return F.concat(lines, sentences, paragraphs, F.when(named, F.array(whole)).otherwise(F.array().cast("array<string>")))

    texts = F.filter(F.array(whole_text(text)), may)
    best = F.array_max(F.transform(F.flatten(F.transform(texts, passages)), lambda p: _score(p, weights, least)))
    names = F.lit([name for name, _ in weights.templates])
    licence = F.element_at(names, (1 - best["place"]).cast("int"))
    return F.when(best["score"] >= least, F.struct(best["score"].alias("score"), licence.alias("licence")))


def directory(path: Column) -> Column:
    """The path without its last part; empty at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """The folder and all above it, with the empty one at the top."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def scan(
    files: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST_SCORE, text: str = "text",
    path: str = "path", carry: list[str] | None = None,
) -> DataFrame:
    """``carry`` (all columns unless given) with own and valid licence of each file.

    ``own_licence`` and ``own_score`` come from the best passage of the text, if
    it reaches ``least``; ``licence`` is the own one or that of the nearest
    directory above (or beside) the file whose licence file has one, which
    ``inherited_from`` then names. Of several such files in a directory the best
    score counts, then the smaller name. Null texts have no own licence, null
    paths inherit none. Columns of these names are replaced, all others stay,
    whatever their names.

    Every text is scored once; what follows works on the written scores.
    Directories, not files, meet their ancestors, so a large directory costs as
    much as a small one; the tables that are joined have one row a directory.
    """
    weights = Weights.of(templates or TEMPLATES)
    carry = [c for c in (carry or files.columns) if c.lower() not in RESULTS]
    boxed = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    rows = settle(files.select(
        boxed, own_licences(files, weights, least, text, path).alias("own"), directory(F.col(path)).alias("folder"),
        F.coalesce(F.regexp_extract(path, r"([^/]*)$", 1).rlike(LICENCE_FILE), F.lit(False)).alias("named"),
    ), "licence-scores")
    # The best score is the smallest of its negatives, names then break ties.
    first = F.min(F.struct((-F.col("own.score")).alias("s"), F.col("own.licence").alias("l")))
    licensed = rows.where(F.col("named") & F.col("own").isNotNull()).groupBy(F.col("folder").alias("above")).agg(first["l"].alias("given"))
    up = rows.select("folder").distinct().select(F.col("folder").alias("dir"), F.explode(ancestors(F.col("folder"))).alias("above"))
    nearest = F.max(F.struct(F.length("above").alias("depth"), "above", "given"))
    inherited = up.join(licensed, "above").groupBy("dir").agg(nearest.alias("near"))
    return rows.join(inherited, F.col("folder") == F.col("dir"), "left").select(
        "row.*", F.col("own.licence").alias("own_licence"), F.col("own.score").alias("own_score"),
        F.coalesce("own.licence", "near.given").alias("licence"),
        F.when(F.col("own").isNull(), F.col("near.above")).alias("inherited_from"),
    )
