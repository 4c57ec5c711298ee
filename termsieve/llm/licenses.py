"""Licence notices in texts by conditional compression, confirmed by exact wording differences.

Candidate blocks are windows of words, around a cue, that hold enough of a template's words to be its notice. A block is
compressed alone and with the template as zstandard raw dictionary; all blocks and templates of a stretch of text are
ranked by the share of bytes that the template saves. In that order the exact word differences confirm a block or not,
and what is confirmed claims its words from templates ranked behind it.
"""

from __future__ import annotations

import difflib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsieve.llm.runtime import ship

#: Identifiers and the wording of common licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Words without which no template matches.
CUES = ("licens", "permission", "redistribut", "copyright", "public domain", "warrant", "cc0")
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


@dataclass(frozen=True)
class Settings:
    """confirm: share of the template's words that must be there in order. level: of the compression. reach: characters
    around a cue that are searched. Line ends, comment signs and other punctuation don't part words.
    """

    confirm: float = 0.85
    level: int = 3
    reach: int = 4000


_GAP = "[^a-z0-9]+"  # words of a cue may stand on two lines


def has_cue(text: Column) -> Column:
    """Whether a text can hold a notice at all; decided without leaving the JVM."""
    low = F.lower(text)
    out = F.lit(False)
    for cue in CUES:
        out = out | (low.rlike(cue.replace(" ", _GAP)) if " " in cue else low.contains(cue))
    return out


_CUE = re.compile("|".join(re.escape(cue).replace("\\ ", _GAP) for cue in CUES), re.I)


def blocks(text: str, s: Settings) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches of a text within reach of its cues; those that touch are one."""
    start, end = -1, -1
    for found in _CUE.finditer(text):
        a, b = max(0, found.start() - s.reach), min(len(text), found.end() + s.reach)
        if start >= 0 and a <= end:
            end = b
        else:
            if start >= 0:
                yield start, end
            start, end = a, b
    if start >= 0:
        yield start, end


class Scanner:
    """Compressors and word lists of the templates, made once a task."""

    def __init__(self, s: Settings, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> None:
        import zstandard as zstd

        self.s, self.templates = s, templates
        self.plain = zstd.ZstdCompressor(level=s.level, write_content_size=False)
        self.with_template = [
            zstd.ZstdCompressor(level=s.level, dict_data=zstd.ZstdCompressionDict(t.encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT), write_content_size=False)
            for _, t in templates
        ]
        self.words = [[w.lower() for w in WORD.findall(t)] for _, t in templates]
        self.counts = [Counter(w) for w in self.words]
        self.need = [math.ceil(s.confirm * len(w) - 1e-9) for w in self.words]

    def saved(self, notice: str, template: int) -> float:
        """Share of the compressed size that the template saves."""
        raw = notice.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(raw))
        return (alone - len(self.with_template[template].compress(raw))) / alone

    def differences(self, have: list[str], template: int) -> tuple[float, list[str], list[int]]:
        """Share of the template's words found in order, what differs from its first to its last matching word, and
        the places of the matching words.
        """
        want = self.words[template]
        steps = difflib.SequenceMatcher(None, want, have, autojunk=False).get_opcodes()
        at = [j for op, _, _, j1, j2 in steps if op == "equal" for j in range(j1, j2)]
        inner = [k for k, step in enumerate(steps) if step[0] == "equal"]
        out = []
        for k, (op, i1, i2, j1, j2) in enumerate(steps):
            if op != "equal":
                edge = not inner or k < inner[0] or k > inner[-1]
                extra = [] if edge else have[j1:j2]
                if i2 > i1 or extra:
                    out.append(f"-{' '.join(want[i1:i2])} +{' '.join(extra)}")
        return len(at) / len(want), out, at

    def _fullness(self, have: list[str], template: int, lo: int, hi: int) -> list[int]:
        """How many of the template's words the window from each word of have[lo:hi] on holds: twice their number and 16 words."""
        most, wide = self.counts[template], 2 * len(self.words[template]) + 16
        seen, over, end, n = Counter(), [], lo, 0
        for j in range(lo, hi):
            while end < min(hi, j + wide):
                w, end = have[end], end + 1
                if w in most:
                    seen[w] += 1
                    n += seen[w] <= most[w]
            over.append(n)
            if have[j] in most:
                n -= seen[have[j]] <= most[have[j]]
                seen[have[j]] -= 1
        return over

    def notices(self, block: str) -> list[tuple[int, int, str, float, float, list[str]]]:
        """(start, end, license, saved, similarity, differences) of all confirmed notices, the closest first.

        Of templates that claim the same words the one with the fewest differences has them; another licence's needs a
        fifth of its words, two at least, for itself. Notices of one licence don't overlap.
        """
        found = [(m.start(), m.end(), m.group().lower()) for m in WORD.finditer(block)]
        have = [w for _, _, w in found]
        counted = Counter(have)
        fullness: dict[tuple[int, int], tuple[int, list[int]]] = {}
        ranked: list[tuple[float, int, int, int, int, int, int]] = []

        def rank(k: int, lo: int, hi: int, j: int) -> None:
            """Puts the next candidate block of a template, from word j on, in its place; the region it lies in is lo to hi."""
            need = self.need[k]
            if hi - j < need:
                return
            if (k, hi) not in fullness:
                fullness[k, hi] = lo, self._fullness(have, k, lo, hi)
            first, over = fullness[k, hi]
            while j < hi and over[j - first] < need:
                j += 1
            while j + 1 < hi and over[j + 1 - first] >= over[j - first]:
                j += 1
            if j < hi:
                n = len(self.words[k])  # a first word that comes again behind the notice has not held the window
                a, z = max(lo, j - n), min(hi, j + 4 * n + 32)
                heapq.heappush(ranked, (-self.saved(block[found[a][0] : found[z - 1][1]], k), k, lo, hi, j, a, z))

        for k, most in enumerate(self.counts):
            if sum(min(n, counted[w]) for w, n in most.items()) >= self.need[k]:
                rank(k, 0, len(have), 0)
        places, exact = [], set()
        while ranked:
            _, k, lo, hi, j, a, z = heapq.heappop(ranked)
            share, rest, at = self.differences(have[a:z], k)
            if share < self.s.confirm:
                rank(k, lo, hi, j + 1 + len(self.words[k]) // 8)
                continue
            at = [a + i for i in at]
            if rest or not exact.issuperset(at):
                places.append((len(rest), -share, -len(self.words[k]), k, at, rest))
                exact.update(at if not rest else ())
            rank(k, lo, at[0], lo)
            rank(k, at[-1] + 1, hi, at[-1] + 1)
        out, claimed, spans = [], set(), {}
        for _, share, n, k, at, rest in sorted(places):
            name, start, end = self.templates[k][0], found[at[0]][0], found[at[-1]][1]
            own = sum(w not in claimed for w in at)  # 'under the MIT License or the Apache License': two may share words
            if own < max(2, -n // 5) or any(a < end and start < b for a, b in spans.get(name, ())):
                continue
            saved = self.saved(block[start:end], k)
            if saved > 0:
                claimed.update(at)
                spans.setdefault(name, []).append((start, end))
                out.append((start, end, name, saved, -share, rest))
        return out

    def best(self, block: str) -> tuple[str, float, float, list[str]] | None:
        """(license, saved, similarity, differences) of the closest notice."""
        return next((row[2:] for row in self.notices(block)), None)


def _scan(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(s)
        kind = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("saved", pa.float64()), ("similarity", pa.float64()), ("exact", pa.bool_()), ("differences", pa.list_(pa.string())), ("notice", pa.string())])
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for a, b in blocks(text, s):
                    for start, end, name, saved, share, rest in sorted(scanner.notices(text[a:b])):
                        rows.append((i, a + start, a + end, name, saved, share, not rest, rest, text[a + start : a + end]))
            cols = list(zip(*rows, strict=True)) or [[]] * len(kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], schema=kind)

    return run


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per notice found: id_col, start, end, license, saved, similarity, exact, differences, notice.

    start and end count code points. differences lists template words that are missing (-) and other words in their
    place (+). Null and empty texts and texts without a cue have no rows; repeated rows and null ids are scanned like
    others. Very long texts are scanned whole, a stretch around cues at a time. An empty table gives an empty one.
    Other columns are not read. Nothing is shuffled.
    """
    ship(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(has_cue(F.col("text")))
    kind = "id long, start long, end long, license string, saved double, similarity double, exact boolean, differences array<string>, notice string"
    return two.mapInArrow(_scan(settings or Settings()), kind).withColumnRenamed("id", id_col)
