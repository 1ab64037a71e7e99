"""Operator 2, licence scans: MinHash bands over overlapping text windows retrieve templates.

Templates are grouped by length; a group's windows are a quarter longer than its longest template
and start every quarter, so some window holds any copy whole and its Jaccard similarity to the
template is at least `LEAST`. With `BANDS` bands of one MinHash value such a window collides with
probability at least 1 - (1 - LEAST)^BANDS, above 1 - 1e-10. Minima are kept by quarter window; a
window's minimum is put together only around a quarter that has a template's value, as no other
window can collide. Every retrieved pair is verified by exact shingle containment (five words, 0.8
or more), and adjoining hits are one region.

Words are runs of letters and digits (ASCII punctuation separates), lower-cased. Texts are scanned
whole, in tasks of their own; nothing is shuffled, as the templates are a fixed short list.

Null, empty and short texts have no hits and so no rows. Repeated rows are scanned alike. An empty
table gives an empty result. Other columns are ignored. Templates under five words are refused.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import SEED, buffers, mix64, shingle_hashes, sub_batches, word_hashes

WIDTH = 5
CONTAINED = 0.8
BANDS = 32  # of one MinHash value each
LEAST = 0.55
GROUP = 1.3  # the longest template of a group against its shortest
#: Public licence notices, and whole short licences, as their publishers word them.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT-line": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "BSL-1.0-text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
_SPLIT = np.arange(256, dtype=np.uint8)
_SPLIT[[b for b in range(128) if not chr(b).isalnum()]] = 32


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    return word_hashes(_SPLIT[raw], off)


def _salts() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(SEED)) | np.uint64(1)


def _minhash(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ salt) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


class Index:
    """Templates by length group, with their shingle sets and band keys."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        texts = pa.array(list(templates.values()), pa.large_string())
        words, woff, _, _ = _words(*buffers(texts))
        size = np.diff(woff)
        if len(size) and size.min() < WIDTH:
            raise ValueError("a template needs five words at least")
        sh, off = shingle_hashes(words, woff, WIDTH)
        self.sets = [np.unique(sh[off[i] : off[i + 1]]) for i in range(len(size))]
        self.groups: list[tuple[int, int, list[list[tuple[np.uint64, list[int]]]]]] = []  # shingles a block, blocks a window, by band the templates' values
        left = sorted(range(len(size)), key=lambda i: size[i])
        while left:
            members = [i for i in left if size[i] <= GROUP * size[left[0]]]
            left = left[len(members) :]
            most = int(size[members[-1]]) - WIDTH + 1
            block = max(1, most // 4)
            bands = []
            for s in _salts():
                by: dict[np.uint64, list[int]] = {}
                for i in members:
                    by.setdefault(_minhash(self.sets[i], s).min(), []).append(i)
                bands.append(list(by.items()))
            self.groups.append((block, -(-most // block) + 1, bands))

    def best(self, hits: list[tuple[int, int, float, int, int]]) -> list[tuple[int, int, float, int, int]]:
        """Of hits that overlap in a row, the one that matches most shingles: a whole licence before a line of it, a notice
        before those worded alike."""
        out: dict[int, list[tuple]] = {}  # by row: kept regions in order, none of which overlap
        for hit in sorted(hits, key=lambda x: (x[0], -x[2] * len(self.sets[x[1]]), x[1], x[3])):
            kept = out.setdefault(hit[0], [])
            k = bisect(kept, (hit[4], len(self.names)))
            if not k or kept[k - 1][2] < hit[3]:
                kept.insert(k, (hit[3], hit[1], hit[4], hit))
        return [x[3] for kept in out.values() for x in kept]

    def hits(self, sh: np.ndarray, off: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(row, template, containment, first and last matched shingle) of every region in rows of shingles."""
        if not len(sh):
            return []
        count = np.diff(off)
        cut = []
        for block, _, _ in self.groups:
            blocks = -(-count // block)
            boff = np.concatenate([[0], np.cumsum(blocks)])
            owner = np.repeat(np.arange(len(count)), blocks)
            cut.append((boff, owner, off[:-1][owner] + (np.arange(boff[-1]) - boff[:-1][owner]) * block))
        pairs: list[set[tuple[int, int]]] = [set() for _ in self.groups]
        for k, salt in enumerate(_salts()):
            value = _minhash(sh, salt)
            for (block, many, bands), (boff, owner, starts), found_here in zip(self.groups, cut, pairs, strict=True):
                low = value if block == 1 else np.minimum.reduceat(value, starts)
                for v, members in bands[k]:
                    for j in np.flatnonzero(low == v).tolist():
                        first, end = int(boff[owner[j]]), int(boff[owner[j] + 1])
                        for w in range(max(first, j - many + 1), j + 1):
                            if any((w, t) not in found_here for t in members) and low[w : min(w + many, end)].min() == v:
                                found_here.update((w, t) for t in members)
        found = []
        for (_, many, _), (boff, owner, starts), here in zip(self.groups, cut, pairs, strict=True):
            for w, t in here:
                row = int(owner[w])
                lo, stop = int(starts[w]), min(w + many, int(boff[row + 1]))
                hi = int(starts[stop]) if stop < int(boff[row + 1]) else int(off[row + 1])
                in_template = np.flatnonzero(np.isin(sh[lo:hi], self.sets[t]))
                share = len(np.unique(sh[lo:hi][in_template])) / len(self.sets[t])
                if share >= CONTAINED:
                    found.append((row, t, share, lo + int(in_template[0]) - int(off[row]), lo + int(in_template[-1]) - int(off[row])))
        out: list[tuple[int, int, float, int, int]] = []
        for hit in sorted(found, key=lambda x: (x[0], x[1], x[3], x[4])):
            if out and out[-1][:2] == hit[:2] and hit[3] <= out[-1][4] + 1:
                out[-1] = (*hit[:2], max(out[-1][2], hit[2]), out[-1][3], max(out[-1][4], hit[4]))
            else:
                out.append(hit)
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", best: bool = True) -> DataFrame:
    """doc_id, licence, containment, and the region in code points (start, end) of every notice found; with `best`, of
    overlapping ones the fullest match only."""
    index = Index(templates or TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, 2 << 20):
                raw, off = buffers(b.column(1))
                words, woff, start, end = _words(raw, off)
                sh, soff = shingle_hashes(words, woff, WIDTH)
                count = np.diff(woff)
                hits = [h for h in index.hits(sh, soff) if count[h[0]] >= WIDTH]
                hits = index.best(hits) if best else hits
                lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]) if hits else None
                rows = [h[0] for h in hits]
                first = [int(lead[start[woff[r] + a]] - lead[off[r]]) for r, _, _, a, _ in hits]
                until = [int(lead[end[woff[r] + z + WIDTH - 1]] - lead[off[r]]) for r, _, _, _, z in hits]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows, pa.int64())), pa.array([index.names[h[1]] for h in hits], pa.string()), pa.array([h[2] for h in hits], pa.float64()), pa.array(first, pa.int64()), pa.array(until, pa.int64())],
                    ["doc_id", "licence", "containment", "start", "end"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(run, f"doc_id {kind}, licence string, containment double, start long, end long")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op2_licences": op2_licences}
