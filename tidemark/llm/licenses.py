"""License scan: MinHash bands over text windows retrieve templates, containment verifies.

Texts and templates become shingles of up to five words.  For every template
length, windows a quarter longer slide over the text; a window is MinHashed,
and a band that equals one of a template's bands makes the template a candidate.
A candidate is verified by the exact share of the template's shingles that the
window holds, ``CONTAINMENT`` or more.

A window that holds that share has a Jaccard similarity of at least
0.8/(1.25+0.2), about 0.55, with the template, so that ``BANDS`` bands of
``ROWS`` rows miss it with a probability under a millionth (``miss_chance``).
Only windows that begin with a shingle of some template are hashed: others
either share none, and then no band can be equal, or hold no more than the
window that begins at the next such shingle.

Null and empty texts match nothing.  Every row gives a row, repeats included.
Very long texts are looked through whole.  Of matches of one license of which
one lies inside the other the longer stays; of two with the same span the one
whose template's name sorts first.  Matches of different licenses all stay, also
where they begin together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from tidemark.llm.decontamination import _WORD_BYTES, words_of
from tidemark.llm.tables import map_texts

SHINGLE = 5
CONTAINMENT = 0.8
STRETCH = 1.25
BANDS, ROWS = 40, 2

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution."
)
_BSD_3RD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)

# Public license notices, by license and wording.  Long licenses
# are found by their openings.  Versions that differ in a word have templates
# short enough for that word to decide.
TEMPLATES = {
    "Apache-2.0/short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
    "file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0/body": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS "
    "FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "MIT/short": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License",
    "MIT/grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without restriction',
    "MIT/body": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
    "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "GPL-3.0/short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/name": "GNU General Public License, version 3",
    "GPL-3.0/body": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "GPL-2.0/name": "GNU General Public License, version 2",
    "GPL-2.0/body": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL/header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "LGPL/name": "GNU Lesser General Public License",
    "LGPL/library": "GNU Library General Public License",
    "AGPL/name": "GNU Affero General Public License",
    "ISC/short": "Licensed under the ISC License",
    "ISC/grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD/grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "BSD/style": "governed by a BSD-style license",
    "BSD/short": "Licensed under the BSD License",
    "BSD-2-Clause/name": "BSD 2-Clause License",
    "BSD-2-Clause/simplified": "Simplified BSD License",
    "BSD-3-Clause/name": "BSD 3-Clause License",
    "BSD-3-Clause/new": "New BSD License",
    "BSD/conditions": _BSD_2,
    "BSD-3-Clause/third": _BSD_3RD,
    "CC0-1.0/name": "CC0 1.0 Universal",
    "CC-BY-NC-4.0/short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0/short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    **{
        f"CC-{kind.replace(' ', '-')}-{version}/name": f"CC {kind} {version}"
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("2.0", "2.5", "3.0", "4.0")
    },
    **{
        f"CC-{kind}-{version}/long": f"Creative Commons {name} {version}"
        for kind, name in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for version in ("2.0", "2.5", "3.0", "4.0")
    },
    "MPL-2.0/header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0/name": "Mozilla Public License Version 2.0",
    "EPL-2.0/name": "Eclipse Public License v2.0",
    "EPL-2.0/spaced": "Eclipse Public License v 2.0",
    "EPL-1.0/name": "Eclipse Public License v1.0",
    "Unlicense/body": "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib/body": "This software is provided 'as-is', without any express or implied warranty. In no event will the "
    "authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
    "use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "BSL-1.0/name": "Boost Software License, Version 1.0",
    # A longer identifier (GPL-2.0-only) holds the shorter one.
    **{
        f"{i}/spdx": f"SPDX-License-Identifier: {i}"
        for i in (
            "Apache-2.0 MIT ISC BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 LGPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 "
            "EPL-1.0 EPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 Unlicense Zlib BSL-1.0"
        ).split()
    },
}

# Notices that name no license, and so are reported apart.
NOTICES = {"all-rights-reserved/short": "All rights reserved."}


def miss_chance(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """How likely no band of two sets of that Jaccard similarity is equal."""
    return (1 - similarity**rows) ** bands


class TemplateIndex:
    def __init__(self, templates: Mapping[str, str]):
        draw = np.random.default_rng(23)
        n = BANDS * ROWS
        self.factor = draw.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = draw.integers(0, 1 << 63, n, dtype=np.uint64)
        self.shingles: dict[str, set] = {}
        # By (words of a shingle, window in shingles): bands to templates.
        self.bands: dict[tuple[int, int], dict[tuple, list[str]]] = {}
        self.known: dict[int, set] = {}
        for name, text in templates.items():
            words = words_of(text.encode())
            if not words:
                continue
            size = min(SHINGLE, len(words))
            pieces = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
            self.shingles[name] = pieces
            self.known.setdefault(size, set()).update(pieces)
            window = math.ceil(STRETCH * len(pieces))
            index = self.bands.setdefault((size, window), {})
            hashes = np.array([_hash(p) for p in pieces], np.uint64)
            for band, key in enumerate(self._signatures(hashes[None, :])[0]):
                index.setdefault((band, key), []).append(name)
        self.first_words = {p[0] for pieces in self.known.values() for p in pieces}

    def _signatures(self, hashes: np.ndarray) -> list[list[int]]:
        """Band keys of each row of shingle hashes."""
        lowest = np.empty((len(hashes), BANDS * ROWS), np.uint64)
        for k in range(BANDS * ROWS):
            mixed = hashes * self.factor[k] + self.shift[k]
            lowest[:, k] = (mixed ^ (mixed >> np.uint64(31))).min(axis=1)
        keys = lowest.reshape(len(hashes), BANDS, ROWS)
        odd = np.uint64(0x9E3779B97F4A7C15)
        total = np.zeros(keys.shape[:2], np.uint64)
        for r in range(ROWS):
            total = (total ^ keys[:, :, r]) * odd
        return total.tolist()

    def find(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """Matches as template, first word and end word; those of one template do not overlap.

        A match inside another one of the same license is left out.
        """
        firsts = [i for i, w in enumerate(words) if w in self.first_words]
        out = []
        for size, known in self.known.items():
            starts = [i for i in firsts if tuple(words[i : i + size]) in known]
            if starts:
                out += self._windows(words, size, starts)
        kept, ends = [], {}
        for match in sorted(out, key=lambda m: (m[1], -m[2], m[0])):
            license_ = match[0].split("/")[0]
            if match[2] > ends.get(license_, 0):
                ends[license_] = match[2]
                kept.append(match)
        return kept

    def _windows(self, words, size, starts):
        hashes = {}
        out, end = [], {}
        last = len(words) - size
        for (k, window), index in self.bands.items():
            if k != size:
                continue
            for begin in range(0, len(starts), 128):
                some = starts[begin : begin + 128]
                # A window cut off by the text's end repeats its last shingle.
                places = [[min(i + j, last) for j in range(window)] for i in some]
                for row in places:
                    for i in row:
                        if i not in hashes:
                            hashes[i] = _hash(tuple(words[i : i + size]))
                values = np.array([[hashes[i] for i in row] for row in places], np.uint64)
                for row, keys in zip(places, self._signatures(values), strict=True):
                    names = {n for b, key in enumerate(keys) for n in index.get((b, key), ())}
                    for name in sorted(names):
                        if row[0] < end.get(name, 0):
                            continue
                        wanted = self.shingles[name]
                        held = [i for i in row if tuple(words[i : i + size]) in wanted]
                        have = len({tuple(words[i : i + size]) for i in held})
                        if have >= CONTAINMENT * len(wanted):
                            end[name] = held[-1] + size
                            out.append((name, held[0], end[name]))
            if len(hashes) > 1_000_000:
                hashes = {}
        return out


def _hash(shingle: tuple[bytes, ...]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b" ".join(shingle), 1)


def license_matches(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    *,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``doc`` (a struct of ``keep``), ``names`` of the matched templates, and their ``starts`` and ``ends``.

    Places are code points of the text, ends exclusive.
    """
    given = dict(templates)

    def make():
        index = TemplateIndex(given)

        def work(texts):
            names, starts, ends = [], [], []
            for value in texts:
                found = index.find(words_of(value))
                a, b = [], []
                if found:
                    spans = [m.span() for m in re.finditer(rb"[^ ]+", value.translate(_WORD_BYTES))]
                    point = lambda at, v=value: len(v[:at].decode("utf-8", "replace"))
                    a = [point(spans[i][0]) for _, i, _ in found]
                    b = [point(spans[j - 1][1]) for _, _, j in found]
                names.append([n for n, _, _ in found])
                starts.append(a)
                ends.append(b)
            return names, starts, ends

        return work

    fields = [
        StructField("names", ArrayType(StringType())),
        StructField("starts", ArrayType(LongType())),
        StructField("ends", ArrayType(LongType())),
    ]
    return map_texts(docs, text, fields, make, keep)


def license_report(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document the number of matches, the licenses, and all spans as template:start:end.

    Notices that name no license count as matches and have columns of their own.
    """
    licenses = options.pop("templates", TEMPLATES)
    found = license_matches(docs, {**licenses, **NOTICES}, keep=[doc_id], **options)
    apart = [n for n in NOTICES if n not in licenses]
    spans = F.transform(
        "names", lambda n, i: F.struct(n.alias("name"), F.get("starts", i).alias("a"), F.get("ends", i).alias("b"))
    )
    found = found.select("doc", "names", spans.alias("spans"))

    def listed(which):
        names = F.transform(F.filter("names", which), lambda n: F.split_part(n, F.lit("/"), F.lit(1)))
        texts = F.transform(
            F.filter("spans", lambda s: which(s["name"])), lambda s: F.concat_ws(":", s["name"], s["a"], s["b"])
        )
        return F.array_join(F.array_sort(F.array_distinct(names)), ","), F.array_join(texts, ",")

    names, places = listed(lambda n: ~n.isin(apart))
    notices, notice_places = listed(lambda n: n.isin(apart))
    return found.select(
        F.col(f"doc.`{doc_id}`").alias("doc_id"),
        F.size("names").cast("bigint").alias("n_matches"),
        names.alias("licenses"),
        places.alias("spans"),
        notices.alias("notices"),
        notice_places.alias("notice_spans"),
    )
