"""Licence scans: passages compared to licence templates by the Dice coefficient over word bigrams.

A text is lowered and stripped to words; bigrams are pairs of neighbours, counted once each. A passage is any
stretch of words that begins and ends with bigrams of the template; its Dice coefficient with a
template of t bigrams is 2 * shared / (own + t). At threshold d a passage must have between
t * d / (2 - d) and t * (2 - d) / d bigrams, which bounds the stretches, and share at least t * d / (2 - d)
of the template's, which drops most templates before any stretch is measured. The best stretch of a
template is found, then the best ones before and after it, and so on: all passages come out, of every licence.
Further templates, whole licence texts among them, are given as ``known``.

Null and empty texts match nothing. Of a text's passages the best comes first; ties go to the longer template, then the
first name, then the first place. A text of one word has no bigram. Texts of any length are scanned whole. Repeated rows get the
same result, and rows with a null id are scanned like others; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmesh.llm import textkernels as tk
from quillmesh.llm.common import only

#: Public licence texts: notices by which a work is put under a licence, and the short licences themselves.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ],
    "BSL-1.0": [
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

#: Words: letters, digits and what lies beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Templates:
    names: list[str]
    sizes: np.ndarray
    #: Bigrams of all templates, sorted; the template of each beside it.
    bigram: np.ndarray
    owner: np.ndarray


def bigrams(p: tk.Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bigram, start byte, end byte) in order of place."""
    s, e = p.runs(LETTER)
    row, word = p.rows(s), p.hashes(s, e, tk.LOWER)
    pair, first = tk.ngrams(word, row, 2)
    return row[first], pair, s[first], e[first + 1] if len(first) else s[:0]


def templates(texts: dict[str, list[str]] = TEMPLATES) -> Templates:
    names = [k for k, v in texts.items() for _ in v]
    p = next(tk.packs(pa.array([t for v in texts.values() for t in v], pa.string()), 1 << 62))[2]
    row, pair, _, _ = bigrams(p)
    key = np.unique(np.rec.fromarrays([pair, row], names="b,t"))
    return Templates(names, np.bincount(key.t, minlength=len(names)), key.b.copy(), key.t.copy())


def neighbours(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the same bigram before and after each place: -1 and the end where there is none."""
    order = np.argsort(pair, kind="stable")
    same = pair[order][1:] == pair[order][:-1]
    before, after = np.full(len(pair), -1), np.full(len(pair), len(pair))
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def best_stretch(a: int, end: int, of: np.ndarray, before: np.ndarray, size: int, most: int) -> tuple[float, int]:
    """(Dice, last) of the best stretch of bigrams from ``a`` that ends before ``end``; ``of`` marks those that the template has."""
    wide = 2 * most + 2
    while True:  # a bigram is new in the stretch if it last stood before a
        b = min(a + wide, end)
        new = before[a:b] < a
        own = np.cumsum(new)
        if b == end or own[-1] > most:
            break
        wide *= 4
    n = int(np.searchsorted(own, most, "right"))
    has = of[a : a + n]
    dice = np.where(has, 2 * np.cumsum(new[:n] & has) / (own[:n] + size), 0)
    k = int(np.argmax(dice))
    return float(dice[k]), a + k


def all_passages(pair: np.ndarray, of: np.ndarray, size: int, threshold: float) -> list[tuple[float, int, int]]:
    """(Dice, first, last) of the best passage, then of the best one beside it, and so on, of Dice ``threshold`` at least.

    A stretch need not go on to where its first bigram stands again: without the first place it would be as good.
    """
    before, after = neighbours(pair)
    most = int(size * (2 - threshold) / threshold + 1e-9)
    heap = []
    for a in np.flatnonzero(of).tolist():
        dice, b = best_stretch(a, int(after[a]), of, before, size, most)
        if dice >= threshold:
            heap.append((-dice, a, b))
    heapq.heapify(heap)
    begins: list[int] = []
    taken: dict[int, int] = {}
    while heap:
        dice, a, b = heapq.heappop(heap)
        k = bisect.bisect_right(begins, a)
        if k and taken[begins[k - 1]] >= a:
            continue
        if k < len(begins) and begins[k] <= b:  # cut short by a better passage
            again, b = best_stretch(a, begins[k], of, before, size, most)
            if again >= threshold:
                heapq.heappush(heap, (-again, a, b))
            continue
        begins.insert(k, a)
        taken[a] = b
    return sorted(((2 * len(set(pair[a : b + 1][of[a : b + 1]].tolist())) / (len(set(pair[a : b + 1].tolist())) + size), a, b) for a, b in taken.items()), key=lambda x: (-x[0], x[1]))


def distinct_names(found: list[tuple[float, int, str, int, int]]) -> list[tuple[str, float, int, int]]:
    """(name, dice, start, end), best first; of passages of one licence's templates that overlap, the first."""
    out: list[tuple[str, float, int, int]] = []
    taken: dict[str, list[tuple[int, int]]] = {}
    for d, _, name, x, y in sorted(found):
        if all(y <= a or b <= x for a, b in taken.get(name, ())):
            taken.setdefault(name, []).append((x, y))
            out.append((name, -d, x, y))
    return out


PASSAGE = pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, threshold: float = 0.8, known: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """doc_id, license (null if none reaches the threshold), dice, start, end (bytes of the best passage), n_licenses, passages (all, best first); a row for each row of docs."""
    t = templates(known)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in tk.packs(batch.column("text")):
                row, pair, start, end = bigrams(p)
                first, stop = np.searchsorted(t.bigram, pair, "left"), np.searchsorted(t.bigram, pair, "right")
                hit = np.flatnonzero(stop > first)
                # Distinct bigrams that a text shares with each template.
                n = (stop - first)[hit]
                owner = t.owner[np.repeat(first[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                key = np.unique(np.rec.fromarrays([np.repeat(row[hit], n), owner, np.repeat(pair[hit], n)], names="r,t,b"))
                shared = np.zeros((p.n, len(t.names)), np.int32)
                np.add.at(shared, (key.r, key.t), 1)
                cut = np.searchsorted(row, np.arange(p.n + 1))
                best, passages = [(None, 0.0, None, None, 0)] * p.n, [[]] * p.n
                enough = (shared > 0) & (shared >= t.sizes * threshold / (2 - threshold) - 1e-9)
                for i in np.flatnonzero(enough.any(1)):
                    at, mine, found = cut[i], pair[cut[i] : cut[i + 1]], []
                    for k in np.flatnonzero(enough[i]):
                        has = np.isin(mine, t.bigram[t.owner == k])
                        found += [(-dice, -int(t.sizes[k]), t.names[k], int(start[at + x] - p.off[i]), int(end[at + y] - p.off[i])) for dice, x, y in all_passages(mine, has, int(t.sizes[k]), threshold)]
                    if found := distinct_names(found):
                        best[i] = (*found[0], len({f[0] for f in found}))
                        passages[i] = [dict(zip(("license", "dice", "start", "end"), f, strict=True)) for f in found]
                cols = list(zip(*best, strict=True))
                kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column("doc_id"), *(pa.array(c, kind) for c, kind in zip(cols, kinds, strict=True)), pa.array(passages, pa.list_(PASSAGE))], names=["doc_id", "license", "dice", "start", "end", "n_licenses", "passages"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return only(docs, "doc_id", "text").mapInArrow(apply, f"doc_id {kind}, license string, dice double, start long, end long, n_licenses long, passages array<struct<license string, dice double, start long, end long>>")
