"""Licence scans: Dice coefficient of word bigrams against licence templates.

A text is cut into units: its lines, and its paragraphs (between blank lines) where those have more
than one line. A unit's words are its runs of digits and ASCII letters, lower-cased; its set holds the
distinct bigrams. A template matches if 2 * shared >= least * (unit + template), compared in whole
percent. Two sizes alone bound the coefficient by 2 * smaller / (smaller + larger), so a unit meets only
templates within that range, found by size; an index from bigrams to these templates then counts what
is shared. A unit outside all ranges is not looked at further.

Null and empty texts have no units and no licences; units of fewer than two words have no bigrams. Of
equal coefficients the template that is first by name wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dockpulse.llm.common import annotate

LEAST_PERCENT = 80

# Public licence notices. Fixed values.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
    # Headers and paragraphs of licence texts, and SPDX lines.
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
    "this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed "
    "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.",
    "BSD-3-Clause-text": "Neither the name of the copyright holder nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior written "
    "permission.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:",
    "CC-BY-4.0-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-deed": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
    "International License.",
    "CC-BY-SA-4.0-deed": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
    "International License.",
    "CC0-1.0-deed": "To the extent possible under law, the author has waived all copyright and related or "
    "neighboring rights to this work.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation; either "
    "version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain.",
    "AGPL-3.0-only-spdx": "SPDX-License-Identifier: AGPL-3.0-only",
    "AGPL-3.0-or-later-spdx": "SPDX-License-Identifier: AGPL-3.0-or-later",
    "Apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "BSD-2-Clause-spdx": "SPDX-License-Identifier: BSD-2-Clause",
    "BSD-3-Clause-spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "CC-BY-4.0-spdx": "SPDX-License-Identifier: CC-BY-4.0",
    "CC-BY-NC-4.0-spdx": "SPDX-License-Identifier: CC-BY-NC-4.0",
    "CC-BY-SA-4.0-spdx": "SPDX-License-Identifier: CC-BY-SA-4.0",
    "CC0-1.0-spdx": "SPDX-License-Identifier: CC0-1.0",
    "GPL-2.0-only-spdx": "SPDX-License-Identifier: GPL-2.0-only",
    "GPL-2.0-or-later-spdx": "SPDX-License-Identifier: GPL-2.0-or-later",
    "GPL-3.0-only-spdx": "SPDX-License-Identifier: GPL-3.0-only",
    "GPL-3.0-or-later-spdx": "SPDX-License-Identifier: GPL-3.0-or-later",
    "ISC-spdx": "SPDX-License-Identifier: ISC",
    "LGPL-3.0-only-spdx": "SPDX-License-Identifier: LGPL-3.0-only",
    "LGPL-3.0-or-later-spdx": "SPDX-License-Identifier: LGPL-3.0-or-later",
    "MIT-spdx": "SPDX-License-Identifier: MIT",
    "MPL-2.0-spdx": "SPDX-License-Identifier: MPL-2.0",
    "Unlicense-spdx": "SPDX-License-Identifier: Unlicense",
}
# End of fixed values.

KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B)}
LOWER = {b: b + 32 for b in range(0x41, 0x5B)}
FOLD = bytes(LOWER.get(b, b if b in KEPT else 0x20) for b in range(256))
FOLD_LINES = FOLD[:10] + b"\n" + FOLD[11:]  # the same, but line ends stay


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:], strict=False))


class LicenceScanner:
    def __init__(self, templates: Mapping[str, str], least: int = LEAST_PERCENT):
        self.least = least
        self.names = sorted(templates)
        sets = [bigrams(templates[n].encode().translate(FOLD).split()) for n in self.names]
        self.sizes = [len(s) for s in sets]
        self.holders: dict[tuple, list[int]] = {}
        for i, s in enumerate(sets):
            for pair in s:
                self.holders.setdefault(pair, []).append(i)
        # Of n and t bigrams: 200 * min(n, t) >= least * (n + t).
        self.low = min([t * least / (200 - least) for t in self.sizes if t], default=1)
        self.high = max([t * (200 - least) / least for t in self.sizes], default=0)

    def best(self, words: list[bytes]) -> tuple[str, float] | None:
        """The template that a unit matches best, if any."""
        if len(words) - 1 < self.low:  # no more distinct bigrams than that
            return None
        found = bigrams(words)
        n = len(found)
        if not self.low <= n <= self.high:
            return None
        shared: Counter[int] = Counter()
        for pair in found:
            for i in self.holders.get(pair, ()):
                if 200 * min(n, self.sizes[i]) >= self.least * (n + self.sizes[i]):
                    shared[i] += 1
        hits = [
            (-2 * s / (n + self.sizes[i]), self.names[i])
            for i, s in shared.items()
            if 200 * s >= self.least * (n + self.sizes[i])
        ]
        if not hits:
            return None
        dice, name = min(hits)
        return name, -dice

    def scan(self, text: str | None) -> dict[str, float]:
        """Every licence that some unit matches best, with its highest coefficient."""
        out: dict[str, float] = {}
        lines = [line.split() for line in text.encode().translate(FOLD_LINES).split(b"\n")] if text else []
        paragraph: list[list[bytes]] = []
        raw = text.split("\n") if text else []
        units = []
        for words, line in zip([*lines, []], [*raw, ""], strict=True):
            if words:
                units.append(words)
            if line.strip(" \t\r"):
                paragraph.append(words)
                continue
            if len(paragraph) > 1 and sum(map(len, paragraph)) - 1 >= self.low:
                units.append([w for part in paragraph for w in part])
            paragraph = []
        for words in units:
            hit = self.best(words)
            if hit:
                out[hit[0]] = max(hit[1], out.get(hit[0], 0.0))
        return out


LICENCES = T.StructType(
    [
        T.StructField("licences", T.ArrayType(T.StringType())),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
    ]
)


def scan_licences(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    least: int = LEAST_PERCENT,
    text: str = "text",
    into: str = "licence",
    keep=None,
) -> DataFrame:
    """Append ``licences``, sorted by name, and the highest coefficient of each as ``scores``."""

    def make():
        scanner = LicenceScanner(templates, least)

        def work(texts):
            found = [sorted(scanner.scan(t).items()) for t in texts]
            return [[n for n, _ in f] for f in found], [[s for _, s in f] for f in found]

        return work

    return annotate(docs, into, LICENCES, make, text, keep)


_VALUES = ",\n  ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[0-9a-z]+')"
)
SQL = rf"""
WITH t(name, body) AS (VALUES
  {_VALUES}),
tw AS (SELECT name, {_WORDS.format("body")} AS ws FROM t),
tb AS (SELECT DISTINCT name, ws[i] || ' ' || ws[i + 1] AS b
       FROM (SELECT name, ws, unnest(range(1, len(ws))) AS i FROM tw)),
ts AS (SELECT name, count(*) AS n FROM tb GROUP BY name),
u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM documents
      UNION ALL
      SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*(?:\n[ \t\r]*)+')) FROM documents),
uw AS (SELECT doc_id, row_number() OVER () AS unit, {_WORDS.format("unit")} AS ws FROM u),
ub AS (SELECT DISTINCT doc_id, unit, ws[i] || ' ' || ws[i + 1] AS b
       FROM (SELECT doc_id, unit, ws, unnest(range(1, len(ws))) AS i FROM uw)),
us AS (SELECT unit, count(*) AS n FROM ub GROUP BY unit),
m AS (SELECT doc_id, ub.unit, name, count(*) AS s FROM ub JOIN tb USING (b) GROUP BY ALL),
h AS (SELECT doc_id, unit, name, 2 * s / (us.n + ts.n) AS dice
      FROM m JOIN us USING (unit) JOIN ts USING (name) WHERE 200 * s >= 80 * (us.n + ts.n)),
f AS (SELECT doc_id, name, dice, row_number() OVER (PARTITION BY unit ORDER BY dice DESC, name) AS r
      FROM h),
g AS (SELECT doc_id, name, max(dice) AS dice FROM f WHERE r = 1 GROUP BY ALL),
a AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licences, count(*) AS n_licences,
             max(dice) AS best FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(licences, '') AS licences, coalesce(n_licences, 0) AS n_licences, best
FROM documents LEFT JOIN a USING (doc_id)"""
