"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies them.

A text is cut into windows of 2c shingles that start every c shingles, for each template size class c (a power of two at
least the template's size), so that every place where a template of the class can stand lies wholly in a window. A window
with a share `containment` of the template has Jaccard similarity `likeness` to it at least (the union also counts what the
window lacks of the template); the number of bands of one
hash is set so that such a window meets the template in a band with probability 1 - `miss` or more. Then the template's
shingles are counted in the window exactly.

Defined cases: null and empty texts and texts of fewer than five words have no shingles and no match; templates need five
words; of several matches of a license in a text the one with the largest containment, then the first, is reported, by the
shortest stretch of words that holds it; rows are judged alone; extra columns are dropped.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.llm.kernels import U, byte_set, column, grams, hash_words, lower_table, pieces, split_words, tidy, weights
from coverloom.llm.util import arrow_batches, ship

SHINGLE, CONTAINMENT, MISS, LEAST_CLASS = 5, 0.8, 1e-3, 2

#: Public license notices, as (license, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)


def likeness(size: int, c: int, containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a template of `size` shingles and a window of 2c that holds the share `containment` of it."""
    need = ceil(containment * size)
    return need / (2 * c + size - need)


def bands(likeness: float, miss: float = MISS) -> int:
    """Bands of one hash so that sets of this Jaccard similarity meet with probability 1 - miss."""
    return ceil(log(miss) / log(1 - likeness))


def shingled(data, starts, ends):
    """Words of rows and the shingle at each word (place and row of each shingle, its hash, words of each row)."""
    table = byte_set((48, 57), (97, 122), (128, 255))
    d = lower_table()[data]
    first, last, row = split_words(d, starts, ends, table)
    h = hash_words(d, first, last)
    n = np.bincount(row, minlength=len(starts))
    if len(h) < SHINGLE:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), n
    g = grams(h, SHINGLE)
    ok = row[: len(g)] == row[SHINGLE - 1 :]
    at = np.flatnonzero(ok)
    return at - np.searchsorted(row, row[at]), row[at], g[ok], n


def shortest(kinds) -> tuple[int, int]:
    """First and last place of the shortest, then first, stretch that has all kinds."""
    most, held, have, a, best = len(set(kinds.tolist())), {}, 0, 0, (0, len(kinds) - 1)
    for z, k in enumerate(kinds.tolist()):
        held[k] = held.get(k, 0) + 1
        have += held[k] == 1
        while have == most:
            if z - a < best[1] - best[0]:
                best = a, z
            held[int(kinds[a])] -= 1
            have -= held[int(kinds[a])] == 0
            a += 1
    return best


class Templates:
    """Size classes with the band values of their templates."""

    def __init__(self, templates, containment: float, miss: float):
        raw = [t.encode() for _, t in templates]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(t) for t in raw])
        _, row, g, _ = shingled(data, ends - [len(t) for t in raw], ends)
        self.names = [n for n, _ in templates]
        self.sets = [np.unique(g[row == i]) for i in range(len(raw))]
        if not all(len(s) for s in self.sets):
            raise ValueError("a template has fewer than five words")
        self.containment, self.classes = containment, {}
        for i, s in enumerate(self.sets):
            self.classes.setdefault(max(LEAST_CLASS, 1 << (len(s) - 1).bit_length()), []).append(i)
        self.bands = max(bands(likeness(len(self.sets[i]), c, containment), miss) for c, own in self.classes.items() for i in own)
        self.mult = weights(self.bands, 41)
        self.low = {c: np.stack([(self.sets[i][:, None] * self.mult[None, :]).min(0) for i in own]) for c, own in self.classes.items()}

    def matches(self, place, row, g):
        """(row, template, containment, first word, end word) of every window that holds a template."""
        out = []
        if not len(g):
            return out
        most = max(self.classes)
        block, begin = None, None
        found: dict[int, list] = {c: [] for c in self.classes}
        for p in range(self.bands):
            v = g * self.mult[p]
            c = LEAST_CLASS
            key_row, key_block = row, place // c
            while c <= most:
                new = np.concatenate(([True], (key_row[1:] != key_row[:-1]) | (key_block[1:] != key_block[:-1])))
                at = np.flatnonzero(new)
                v = np.minimum.reduceat(v, at)
                key_row, key_block = key_row[at], key_block[at]
                if c in self.classes:
                    w = v.copy()  # a window is a block and the next one of its row
                    np.minimum(w[:-1], np.where(key_row[1:] == key_row[:-1], v[1:], w[:-1]), out=w[:-1])
                    table = np.zeros(1 << 16, bool)
                    table[(self.low[c][:, p] >> U(48)).astype(np.int64)] = True
                    hit = np.flatnonzero(table[(w >> U(48)).astype(np.int64)])
                    for k, i in enumerate(self.classes[c]):
                        z = hit[w[hit] == self.low[c][k, p]]
                        found[c] += [(int(key_row[x]), int(key_block[x]), i) for x in z]
                c, key_block = 2 * c, key_block // 2
        bounds = np.searchsorted(row, np.arange(row[-1] + 2))
        for c, pairs in found.items():
            for r, b, i in sorted(set(pairs)):
                lo = bounds[r] + b * c
                hi = min(lo + 2 * c, bounds[r + 1])
                s = self.sets[i]
                inside = np.isin(g[lo:hi], s)
                share = len(np.unique(g[lo:hi][inside])) / len(s)
                if share >= self.containment:
                    at = np.flatnonzero(inside)
                    a, z = shortest(np.searchsorted(s, g[lo:hi][at]))
                    out.append((r, i, share, int(place[lo + at[a]]), int(place[lo + at[z]]) + SHINGLE))
        return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """doc_id, n_words and matches (array of struct<license, containment, first, end>; one for each license, by name) for every row of docs; first and end count words."""
    spark = docs.sparkSession
    arrow_batches(spark)
    Templates(templates, containment, miss)  # raises here if a template is too short; each task makes its own
    kind = pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first", pa.int32()), ("end", pa.int32())])

    def run(batches):
        t = Templates(templates, containment, miss)
        for b in batches:
            data, starts, ends, _ = column(b, "text")
            words, best = np.zeros(b.num_rows, np.int64), {}
            for i, j in pieces(starts, ends):
                a = starts[i]
                place, row, g, n = shingled(data[a : ends[j - 1]], starts[i:j] - a, ends[i:j] - a)
                words[i:j] = n
                for r, k, share, first, end in t.matches(place, row, g):
                    key, value = (i + r, t.names[k]), (-share, first, end)
                    best[key] = min(best.get(key, value), value)
            rows: list[list] = [[] for _ in range(b.num_rows)]
            for (r, name), (share, first, end) in sorted(best.items()):
                rows[r].append({"license": name, "containment": -share, "first": first, "end": end})
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words), pa.array(rows, pa.list_(kind))], ["doc_id", "n_words", "matches"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return own.mapInArrow(tidy(run), "doc_id long, n_words long, matches array<struct<license:string,containment:double,first:int,end:int>>")


ship(__name__)
