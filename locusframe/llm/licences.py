"""Licence scans: Dice coefficient over word bigrams against licence templates.

A text is normalised (runs of anything but ASCII letters and digits become one space, lower case)
and cut into segments: every line, every block of two or more consecutive lines with words, and
the whole text if it has several blocks. A template is a candidate for a segment only if the
segment's bigram count lies within the bounds that the threshold allows: with n and m bigrams
the coefficient is at most 2 min(n, m) / (n + m).

Null and empty texts have no segments. Segments of one word match nothing. Repeated bigrams count
once. A document's licences are listed in alphabetical order; equal rows get equal results. Texts of
any length are scanned whole; an empty table gives no rows. The result has the named columns alone;
other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from locusframe.llm.shared import bounded_batches

# Licence statements and notices, by SPDX-like name.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

PATTERN = r"[^A-Za-z0-9\n]+"


def _normal(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text).lower().split()


class Matcher:
    """Templates by bigram count, and the templates that have each bigram."""

    def __init__(self, templates: list[tuple[str, str]], least: float):
        self.least = least
        self.names, sets = [n for n, _ in templates], [set(zip(w, w[1:], strict=False)) for w in (_normal(t) for _, t in templates)]
        self.sizes = [len(s) for s in sets]
        self.having: dict[tuple[str, str], list[int]] = {}
        for i, s in enumerate(sets):
            for g in s:
                self.having.setdefault(g, []).append(i)
        self.known = set(self.having)
        self.low = [least * n / (2 - least) for n in self.sizes]
        self.high = [n * (2 - least) / least for n in self.sizes]
        self.fewest, self.most = min(self.low), max(self.high)

    def match(self, words: list[str]) -> tuple[str, float] | None:
        """The best template of a segment (ties: alphabetical order), or None."""
        grams = set(zip(words, words[1:], strict=False))
        n = len(grams)
        if not self.fewest <= n <= self.most or not (hit := grams & self.known):
            return None
        shared: dict[int, int] = {}
        for g in hit:
            for i in self.having[g]:
                if self.low[i] <= n <= self.high[i]:
                    shared[i] = shared.get(i, 0) + 1
        best = min(((-2 * k / (n + self.sizes[i]), self.names[i]) for i, k in shared.items()), default=(0.0, ""))
        return (best[1], -best[0]) if -best[0] >= self.least else None

    def segments(self, text: str) -> Iterator[list[str]]:
        blocks, block = [], []
        for line in text.split("\n"):
            if words := line.split():
                block.append(words)
            elif block:
                blocks.append(block)
                block = []
        if block:
            blocks.append(block)
        for block in blocks:
            yield from block
            if len(block) > 1 and sum(map(len, block)) >= self.fewest:
                yield [w for x in block for w in x]
        if len(blocks) > 1:
            yield [w for block in blocks for x in block for w in x]


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """Per document: doc_id, n_matches (segments), licences (names, comma between them), best_dice (0 if none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, least)
        for b in batches:
            texts = pc.replace_substring_regex(pc.fill_null(b["text"].cast(pa.large_string()), ""), PATTERN, " ")
            count, names, best = [], [], []
            for t in texts.to_numpy(zero_copy_only=False).tolist():
                found = [m for s in matcher.segments(t.lower()) if (m := matcher.match(s))]
                count.append(len(found))
                names.append(",".join(sorted({n for n, _ in found})))
                best.append(max((d for _, d in found), default=0.0))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(count, pa.int64()), pa.array(names, pa.string()), pa.array(best, pa.float64())], ["doc_id", "n_matches", "licences", "best_dice"])

    return bounded_batches(docs).select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, "doc_id long, n_matches long, licences string, best_dice double")


def oracle(templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.8) -> str:
    values = ", ".join("({}, '{}', '{}')".format(i, n, " ".join(_normal(t))) for i, (n, t) in enumerate(templates))
    grams = "list_distinct(list_transform(range(1, len({w})), lambda i: {w}[i] || ' ' || {w}[i + 1]))"
    return f"""
        WITH t AS (SELECT id, name, {grams.format(w='w')} AS g FROM (SELECT id, name, string_split(words, ' ') AS w FROM (VALUES {values}) v(id, name, words))),
        lines AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
          SELECT doc_id, list_transform(string_split(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\n]+', ' ', 'g')), chr(10)), lambda x: list_filter(string_split(x, ' '), lambda y: y <> '')) AS w FROM documents)),
        full_lines AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS block FROM lines WHERE len(w) > 0),
        blocks AS (SELECT doc_id, block, flatten(list(w ORDER BY i)) AS w, count(*) AS n FROM full_lines GROUP BY doc_id, block),
        segments AS (
          SELECT doc_id, w, i AS k FROM full_lines
          UNION ALL SELECT doc_id, w, -1 - block FROM blocks WHERE n > 1
          UNION ALL SELECT doc_id, flatten(list(w ORDER BY block)), -1000000000 FROM blocks GROUP BY doc_id HAVING count(*) > 1),
        grams AS (SELECT doc_id, row_number() OVER () AS s, {grams.format(w='w')} AS g FROM segments WHERE len(w) >= 2),
        scored AS (
          SELECT doc_id, s, name, 2 * len(list_intersect(grams.g, t.g)) / (len(grams.g) + len(t.g)) AS dice
          FROM grams JOIN t ON len(grams.g) BETWEEN {least} * len(t.g) / (2 - {least}) - 1 AND len(t.g) * (2 - {least}) / {least} + 1),
        best AS (SELECT doc_id, s, name, dice FROM scored WHERE dice >= {least} QUALIFY row_number() OVER (PARTITION BY s ORDER BY dice DESC, name) = 1),
        per_doc AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names, max(dice) AS dice FROM best GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(names, '') AS licences, round(coalesce(dice, 0)::DOUBLE, 6) AS best_dice
        FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""
