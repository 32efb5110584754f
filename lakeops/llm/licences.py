"""Licence scan: sparse TF-IDF cosine to templates, then inheritance along paths.

A file is compared in three ways, each by the cosine of sparse TF-IDF vectors; inverse document
frequencies come from the templates, and a word that no template has counts as the rarest:

1. the whole text with the whole licence texts in ``licence_texts`` (AGPL-3.0 and BSD-2-Clause are
   derived from the texts of GPL-3.0 and BSD-3-Clause);
2. the blocks of the text (lines without an empty or bare comment line between them, joined)
   with titles, first paragraphs and notices of licences (BLOCKS);
3. all lines, and the sentences of lines with several, with short notices (TEMPLATES).

What reaches ``threshold`` decides: the whole text first, else the better of the best block and the
best line, where "all rights reserved" alone gives way to any block.

A text is cut into terms once. Texts, blocks and lines are skipped without a comparison only if that is
exact. Words that no template has take so much of a text's norm that it cannot reach the threshold; and
the terms of a template are split into telling ones and the rest, such that the rest alone cannot reach
the threshold (both by Cauchy-Schwarz), so a line or block needs a telling term of some template, and
is looked for only in texts that have one.

A file without a licence of its own inherits that of the nearest directory at or above its own with a
licence file. Only distinct directories are joined with their ancestors, and files then with their
directory, so a directory that holds very many files costs one row until the last join, which Spark
can split.

Defined cases: a null or empty text has no header; bytes that are not UTF-8 are read as U+FFFD. Very long
texts are compared whole, as are their blocks and lines. A null path has no directory and inherits nothing.
Of several licence files in a directory the one with the smallest path decides; of equal cosines the
first template by name, of equal lines or blocks the first. Repeated rows get equal results. Empty tables give
empty results. Columns are carried along where asked for; one with the name of an output column gives
way to it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

#: Short licence notices as they stand in headers. (Fixed values.)
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright. All rights reserved."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    (
        "BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("EPL-2.0", "This program is made available under the terms of the Eclipse Public License 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: SPDX identifiers and the names that notices use; None where the notice stands in TEMPLATES. (Fixed values.)
NAMES = {
    "AGPL-3.0": None, "AGPL-3.0-only": None, "AGPL-3.0-or-later": None,
    "Apache-2.0": "Apache 2.0", "BSD-2-Clause": "BSD 2-Clause", "BSD-3-Clause": "BSD 3-Clause", "BSL-1.0": "Boost 1.0",
    "CC-BY-4.0": None, "CC-BY-SA-4.0": None, "CC0-1.0": None, "EPL-1.0": "EPL 1.0", "EPL-2.0": "EPL 2.0",
    "GPL-2.0": "GPL v2", "GPL-2.0-only": None, "GPL-2.0-or-later": None,
    "GPL-3.0": "GPL v3", "GPL-3.0-only": None, "GPL-3.0-or-later": None, "ISC": "ISC",
    "LGPL-2.1": "LGPL v2.1", "LGPL-2.1-only": None, "LGPL-2.1-or-later": None,
    "LGPL-3.0": "LGPL v3", "LGPL-3.0-only": None, "LGPL-3.0-or-later": None,
    "MIT": "MIT", "MIT OR Apache-2.0": "MIT or Apache 2.0", "MPL-2.0": "MPL 2.0", "Unlicense": None, "Zlib": "zlib",
}
TEMPLATES += [
    (spdx, form)
    for spdx, name in NAMES.items()
    for form in (f"SPDX-License-Identifier: {spdx}", name and f"Licensed under the {name} license", name and f"Released under the {name} license")
    if form and (spdx, form) not in TEMPLATES
]
_GNU = "GNU {}GENERAL PUBLIC LICENSE Version {}"
_FREE = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General "
    "Public License as published by the Free Software Foundation; either version {version} of the License, or "
    "(at your option) any later version."
)
#: Titles, first paragraphs and notices of licences. (Fixed values.)
BLOCKS = [
    ("AGPL-3.0", _GNU.format("AFFERO ", "3, 19 November 2007")),
    ("AGPL-3.0", _FREE.format(what="program", kind="Affero ", version="3")),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("GPL-2.0", _GNU.format("", "2, June 1991")),
    ("GPL-2.0", _FREE.format(what="program", kind="", version="2")),
    ("GPL-3.0", _GNU.format("", "3, 29 June 2007")),
    ("GPL-3.0", _FREE.format(what="program", kind="", version="3")),
    ("LGPL-2.1", _GNU.format("LESSER ", "2.1, February 1999")),
    ("LGPL-2.1", _FREE.format(what="library", kind="Lesser ", version="2.1")),
    ("LGPL-3.0", _GNU.format("LESSER ", "3, 29 June 2007")),
    ("LGPL-3.0", _FREE.format(what="library", kind="Lesser ", version="3")),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "This file is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("ISC", "ISC License"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
]
#: Between two blocks: a line that is empty or has comment marks only.
_GAP = re.compile(r"\n[ \t\r]*(?:[#*;%!\-]+|//+|/\*+|\*+/|<!--|-->)?[ \t\r]*(?=\n)")
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_SENTENCE = re.compile(r"(?<=[a-z)][.;:])[ \t]+")


def terms(text: str) -> Counter[str]:
    return Counter(_TERM.findall(text.lower()))


#: Words of ordinary prose: telling only where the others do not suffice. (Fixed values.)
_COMMON = frozenset(
    "a all an and any as at be by can copy do file following for free from if in is it license licensed may no not of on one or "
    "other out own person public source state that the their this to under use used v version was with without work you "
    "0 1 2 3 4 1.0 2.0 3.0 4.0".split()
)


@lru_cache(maxsize=1)
def licence_texts() -> list[tuple[str, str]]:
    """The whole licence texts."""
    found = {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    found["AGPL-3.0"] = re.sub(r"(GNU\s+)(General\s+Public)", r"\1Affero \2", found["GPL-3.0"], flags=re.I)
    found["BSD-2-Clause"] = re.sub(r"\n3\. .*?\n\n", "\n", found["BSD-3-Clause"], flags=re.S).replace("3-", "2-")
    return sorted(found.items())


class Templates:
    """TF-IDF vectors of the templates and the telling terms."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        bags = [(name, terms(text)) for name, text in templates]
        seen = Counter(t for _, bag in bags for t in bag)
        self.idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in seen.items()}
        self.rarest = math.log(1 + len(bags)) + 1
        self.threshold = threshold
        self.names = [name for name, _ in bags]
        self.of_term: dict[str, list[tuple[int, float]]] = {}
        self.telling: set[str] = set()
        for k, (_, bag) in enumerate(bags):
            weights = {t: n * self.idf[t] for t, n in bag.items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            rest = 1.0
            for t, w in sorted(weights.items(), key=lambda x: (x[0] in _COMMON, -x[1], x[0])):
                self.of_term.setdefault(t, []).append((k, w / norm))
                if math.sqrt(max(rest, 0)) >= threshold - 1e-9:
                    self.telling.add(t)
                rest -= (w / norm) ** 2

    def best(self, bag: Counter[str]) -> tuple[float, str] | None:
        """(cosine, name) of the template nearest to a bag of terms; None below the threshold."""
        idf = self.idf
        weights = {t: n * idf[t] for t, n in bag.items() if t in idf}
        known = sum(w * w for w in weights.values())
        unknown = sum(n * n for t, n in bag.items() if t not in idf)
        norm = math.sqrt(known + self.rarest * self.rarest * unknown)
        if not norm or math.sqrt(known) < (self.threshold - 1e-9) * norm:
            return None
        dots = [0.0] * len(self.names)
        for t, weight in weights.items():
            for k, w in self.of_term[t]:
                dots[k] += w * weight
        top = max(dots)
        if top / norm < self.threshold - 1e-9:
            return None
        return top / norm, min(name for name, dot in zip(self.names, dots, strict=True) if dot >= top - 1e-9 * norm)


def _better(top: tuple[float, str] | None, found: tuple[float, str] | None) -> tuple[float, str] | None:
    return found if found and (top is None or found[0] > top[0] + 1e-9) else top


def _places(text: str, words: set[str]) -> list[int]:
    """Where one of the words stands in a lower-case text, also inside longer words, in order."""
    found = []
    for word in words:
        at = text.find(word)
        while at >= 0:
            found.append(at)
            at = text.find(word, at + len(word))
    return sorted(found)


def sentences(line: str) -> list[str]:
    """A line and, if it has several, its sentences."""
    parts = _SENTENCE.split(line)
    return [line, *parts] if len(parts) > 1 else [line]


class Scan:
    """The whole text, its blocks and its lines against their templates."""

    def __init__(self, templates: list, threshold: float, blocks: list, whole: list):
        self.lines, self.blocks, self.whole = (Templates(x, threshold) for x in (templates, blocks, whole))

    def line(self, low: str, words: set[str]) -> tuple[float, str] | None:
        """The best line, or sentence of a line, of a lower-case text that holds these telling words."""
        top, end = None, -1
        for at in _places(low, words):
            if at < end:
                continue  # in the line before
            start, end = low.rfind("\n", 0, at) + 1, low.find("\n", at)
            end = len(low) if end < 0 else end
            for part in sentences(low[start:end]):
                top = _better(top, self.lines.best(Counter(_TERM.findall(part))))
        return top

    def block(self, low: str, words: set[str]) -> tuple[float, str] | None:
        """The best block of a lower-case text that holds these telling words."""
        places, top, start = _places(low, words), None, 0
        gaps = _GAP.finditer(low)
        while places:
            gap = next(gaps, None)
            end = gap.start() + 1 if gap else len(low)
            here = bisect_left(places, end)
            if here:
                top = _better(top, self.blocks.best(Counter(_TERM.findall(low[start:end]))))
                places = places[here:]
            if gap is None:
                break
            start = gap.end()
        return top

    def licence(self, text: str) -> tuple[float, str] | None:
        """(cosine, name) of the licence of a text; the text is cut into terms once."""
        low = text.lower()
        bag = Counter(_TERM.findall(low))
        if found := self.whole.best(bag):
            return found
        words = bag.keys()
        line = self.line(low, here) if (here := self.lines.telling & words) else None
        block = self.block(low, here) if (here := self.blocks.telling & words) else None
        if block and (not line or block[0] > line[0] or line[1] == "Proprietary"):
            return block
        return line


OUTPUT = ("own_licence", "own_score", "directory", "licence", "licence_from")


def headers(
    files: DataFrame, carry: list[str], text: str = "text", threshold: float = 0.8, templates: list = TEMPLATES
) -> DataFrame:
    """The ``carry`` columns of every file with own_licence and own_score (null without a header)."""
    carry = [c for c in carry if c not in OUTPUT]
    whole = licence_texts()  # read by the driver: some 150 KB that go with the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Scan(templates, threshold, BLOCKS, whole)
        for batch in slices(batches, text, 8 << 20):
            found = [known.licence(t) if t else None for t in texts(batch.column(text))]
            columns = [batch.column(c) for c in carry]
            columns += [
                pa.array([f and f[1] for f in found], pa.string()),
                pa.array([f and round(f[0], 12) for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "own_licence", "own_score"])

    types = dict(files.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in carry), "own_licence string, own_score double"])
    return files.select(*dict.fromkeys([*carry, text])).mapInArrow(run, schema)


def _directory(path: str) -> str:
    return f"CASE WHEN {path} LIKE '%/%' THEN regexp_replace({path}, '/[^/]*$', '') WHEN {path} IS NOT NULL THEN '' END"


def inherit(files: DataFrame, path: str = "path", is_licence_file: str | None = None) -> DataFrame:
    """``files`` (with own_licence) and directory, licence and licence_from (path of the licence file).

    ``is_licence_file`` is an SQL condition; by default the file's name starts with LICENSE, LICENCE or COPYING.
    """
    named = is_licence_file or f"regexp_like(`{path}`, '(?i)(^|/)(licen[cs]e|copying)[^/]*$')"
    placed = files.withColumn("directory", F.expr(_directory(f"`{path}`")))
    givers = (
        placed.where(f"own_licence IS NOT NULL AND directory IS NOT NULL AND ({named})")
        .groupBy("directory")
        .agg(F.min(F.struct(F.col(path).alias("from"), F.col("own_licence").alias("given"))).alias("g"))
        .selectExpr("directory AS above", "g")
    )
    parts = "split(directory, '/')"
    up = f"transform(sequence(0, size({parts})), n -> array_join(slice({parts}, 1, n), '/'))"
    nearest = (
        placed.where("directory IS NOT NULL")
        .select("directory")
        .distinct()
        .selectExpr("directory", f"explode(array_distinct({up})) AS above")
        .join(givers, "above")
        .groupBy("directory")
        .agg(F.max_by("g", F.length("above")).alias("g"))
        .selectExpr("directory AS d", "g")
    )
    joined = placed.alias("f").join(nearest.alias("x"), F.expr("f.directory = x.d"), "left")
    return joined.selectExpr(
        "f.*",
        "coalesce(f.own_licence, x.g.given) AS licence",
        "CASE WHEN f.own_licence IS NULL THEN x.g.`from` END AS licence_from",
    )
