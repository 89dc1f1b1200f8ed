"""License scans: MinHash bands over overlapping word windows, then exact containment.

A template is cut into parts of at most ``PART`` shingles (of five words; most
notices are one part). For each window length in use, every window of a text
(they overlap in all but one word) has ``BANDS`` MinHash values of its
shingles, one row to a band, so a window that shares a fraction s of its
shingles with a part retrieves the template with probability 1 - (1 - s)^BANDS,
and nothing is retrieved that shares no shingle. Window lengths are chosen so
that a part has at least 0.8 of one of them (``window_lengths``). A text that
holds ``CONTAINMENT`` of a template holds as much of one of its parts; where
that part stands together, s is 0.55 at least, which one window misses once in
eight million times; where it is torn over twice its length, s is 0.25 at
least, which one window misses once in 300 times, and each overlapping window
is a further chance.

Every retrieved pair of text and template is verified exactly over the whole
text: a match is a run of as many shingles as the template has twice over that
holds ``CONTAINMENT`` of the template's distinct shingles. Retrieval decides
only whether a pair is looked at, never where.

Texts and templates are compared lower-cased (A-Z) and without ASCII
punctuation. The templates go to the executors with the code (their number and
length bound their size); no document is shuffled. A text of any length is read
whole, in memory of some 30 times its size; it is a block of its own where it
is longer than a block.

Null and empty texts have no notices and so no rows. Repeated rows give rows
each. Of places with equal containment the first counts, of these the shortest.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import cut, text_bytes
from .substring_dedup import window_hashes

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 20
PART = 124
SEED = 5
BLOCK_TEXT = 2 << 20

#: Public license notices (fixed values).
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "bsd-3-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "lgpl-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "cc0-1.0-line": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "cc-by-nd-4.0-line": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nc-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "cc-by-nc-nd-4.0-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "wtfpl": "You just DO WHAT THE FUCK YOU WANT TO.",
}

_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_NONE = np.uint64((1 << 64) - 1)


def normal_words(text: bytes) -> list[bytes]:
    return text.lower().translate(None, _PUNCTUATION).split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    return window_hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), SHINGLE_WORDS)


def window_lengths(lengths: list[int]) -> list[int]:
    """Window lengths (in shingles) such that each template has at least 0.8 of one of them.

    With four fifths of a template there, a window of its length shares at
    least 0.64 / 1.36 of the union in the worst case, some one half.
    """
    out: list[int] = []
    for n in sorted(set(lengths), reverse=True):
        if not out or n < 0.8 * out[-1]:
            out.append(n)
    return out[::-1]


def _permuted(hashes: np.ndarray, band: int) -> np.ndarray:
    rng = np.random.default_rng((SEED, band))
    a, b = (np.uint64(x) for x in rng.integers(1, 1 << 63, 2, dtype=np.int64))
    out = hashes * (a | np.uint64(1)) + b
    return out ^ (out >> np.uint64(29))


class Index:
    """Templates by band: MinHash values of their parts to the templates."""

    def __init__(self, templates: dict[str, str], bands: int = BANDS):
        self.names = sorted(templates)
        self.words = [normal_words(templates[n].encode()) for n in self.names]
        if bad := [n for n, w in zip(self.names, self.words, strict=True) if len(w) < SHINGLE_WORDS]:
            raise ValueError(f"templates need {SHINGLE_WORDS} words: {bad}")
        every = [shingle_hashes(w) for w in self.words]
        self.shingles = [np.unique(h) for h in every]
        self.bands = bands
        # Parts of one template are of one length, or differ by one.
        parts = [(k, p) for k, h in enumerate(every) for p in np.array_split(h, -(-len(h) // PART))]
        self.lengths = window_lengths([len(p) for _, p in parts])
        self.values: dict[tuple[int, int], tuple[np.ndarray, list[list[int]]]] = {}
        for length in self.lengths:
            own = [(k, p) for k, p in parts if length == next(x for x in self.lengths if len(p) <= x)]
            for band in range(bands):
                by: dict[int, list[int]] = {}
                for k, p in own:
                    by.setdefault(int(_permuted(p, band).min()), []).append(k)
                keys = sorted(by)
                self.values[length, band] = np.array(keys, np.uint64), [by[v] for v in keys]

    def candidates(self, hashes: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(text, template) pairs that some window retrieves.

        ``_NONE`` marks places without a shingle; texts begin at ``starts`` and
        lie apart by more than a window.
        """
        found: set[tuple[int, int]] = set()
        none = hashes == _NONE
        for band in range(self.bands):
            low, size = _permuted(hashes, band), 1
            low[none] = _NONE
            for length in self.lengths:
                while 2 * size <= length:
                    low = np.minimum(low[:-size], low[size:])
                    size *= 2
                window = low if size == length else np.minimum(low[: len(low) - (length - size)], low[length - size :])
                keys, of = self.values[length, band]
                if not len(window) or not len(keys):
                    continue
                at = np.minimum(np.searchsorted(keys, window), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == window)
                # The only text that a window can touch is the last one that begins before its end.
                texts = np.searchsorted(starts, hit + length - 1, "right") - 1
                for pair in np.unique(texts * len(keys) + at[hit]).tolist():
                    found.update((pair // len(keys), k) for k in of[pair % len(keys)])
        return found


def best_place(hashes: np.ndarray, shingles: np.ndarray, containment: float) -> tuple[float, int, int] | None:
    """(containment, first word, last word + 1) of the best run in a text, or None.

    ``shingles`` are a template's distinct ones, sorted. Runs begin at one of
    them and are twice as many shingles long; a pass over their occurrences
    keeps the count of distinct ones.
    """
    n = len(shingles)
    code = np.minimum(np.searchsorted(shingles, hashes), n - 1)
    here = np.flatnonzero(shingles[code] == hashes)
    codes = code[here].tolist()
    if len(set(codes)) < containment * n:
        return None
    ends = np.searchsorted(here, here + 2 * n).tolist()
    held, distinct, j, best = [0] * n, 0, 0, None
    places = here.tolist()
    for i, first in enumerate(places):
        for c in codes[j : ends[i]]:
            distinct += not held[c]
            held[c] += 1
        j = ends[i]
        share = distinct / n
        if share >= containment:
            found = share, -first, -places[j - 1]
            best = found if best is None else max(best, found)
        held[codes[i]] -= 1
        distinct -= not held[codes[i]]
    return best and (best[0], -best[1], -best[2] + SHINGLE_WORDS)


def scan(texts: list[bytes], index: Index, containment: float = CONTAINMENT) -> list[tuple[int, str, float, int, int]]:
    """(text number, template, containment, first word, last word + 1) for the best place of each template in each text."""
    words = [normal_words(t) for t in texts]
    pad = max(index.lengths)
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(counts.sum()))
    every = window_hashes(flat, SHINGLE_WORDS)
    firsts = np.cumsum(counts) - counts
    own = np.maximum(counts - SHINGLE_WORDS + 1, 0)
    # Texts lie apart by more than a window, so no window touches two of them.
    starts = pad + np.cumsum(own + pad) - own - pad
    hashes = np.full(int((own + pad).sum()) + pad, _NONE, np.uint64)
    place = np.repeat(starts - np.cumsum(own) + own, own) + np.arange(int(own.sum()))
    source = np.repeat(firsts - np.cumsum(own) + own, own) + np.arange(int(own.sum()))
    hashes[place] = every[source]
    found = []
    for t, k in sorted(index.candidates(hashes, starts)):
        if best := best_place(hashes[starts[t] : starts[t] + own[t]], index.shingles[k], containment):
            found.append((t, index.names[k], *best))
    return sorted(found)


def _scan_batches(templates: dict[str, str], containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for table in cut(batches, "_text", max_bytes=BLOCK_TEXT):
            ids = table.column("doc_id").to_pylist()
            rows = scan(text_bytes(table.column("_text")), index, containment)
            yield pa.RecordBatch.from_arrays([pa.array([ids[r[0]] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())], names=["doc_id", "license", "containment", "first_word", "end_word"])

    return run


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, license, containment, first_word, end_word: the best place of each notice in each text that has it.

    Word numbers count words that keep a character without punctuation.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return own.mapInArrow(_scan_batches(TEMPLATES if templates is None else templates, containment), "doc_id long, license string, containment double, first_word long, end_word long")
