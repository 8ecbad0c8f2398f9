"""License texts in documents: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into runs of three words, and of each three neighbouring runs the one of least value is kept as a
fingerprint with its place; an inverted index leads from a fingerprint to templates and places. A document is winnowed alike,
so that any five words in common leave a fingerprint on both sides. Fingerprints of one template that lie on nearby diagonals
(place in the document less place in the template) make a candidate. It is aligned word by word within a band about those
diagonals, for the longest common subsequence, which allows for words that were changed, added or left out. A match is an
alignment that covers ``LEAST_COVERAGE`` percent of the template. What lies before and after it is aligned again, so that
statements repeated close together are all found. Of matches that overlap, the one with most words stays.

Words are lower-cased runs of ASCII letters and digits and of anything beyond ASCII. Null, empty and wordless texts have no
match and give no row. Null ids pass through, repeated rows are scanned each for itself, other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordtide.llm import words as W
from recordtide.llm.tables import keyed_texts

RUN = 3
WINDOW = 3
BAND = 12
LEAST_COVERAGE = 80

#: Wordings by which licenses are stated or granted.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "BSD-3-Clause-line": "Released under the BSD 3-Clause License.",
    "BSD-2-Clause-line": "Released under the BSD 2-Clause License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0-line": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and"
        " this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED"
        " \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF"
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS"
        " BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
        " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and"
        " the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and"
        " the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
        " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
        " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the"
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable"
        " law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT"
        " WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means."
    ),
}


class Index:
    """Templates by fingerprint."""

    def __init__(self, templates: Mapping[str, str]):
        self.hashes = W.WordHashes()
        self.templates = {name: W.alnum_words(text.encode()) for name, text in templates.items()}
        self.places = defaultdict(list)
        for name, words in self.templates.items():
            for value, place in self.fingerprints(words):
                self.places[value].append((name, place))
        self.values = np.array(sorted(self.places), np.uint64)

    def fingerprints(self, words: list[bytes]) -> list[tuple[int, int]]:
        runs = W.rolling(self.hashes.of(words), RUN)
        at = np.unique(W.window_minima(runs, min(WINDOW, max(1, len(runs)))))
        return list(zip(runs[at].tolist(), at.tolist()))

    def candidates(self, words: list[bytes]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Template and hits that lie together, as diagonal and place in the document."""
        runs = W.rolling(self.hashes.of(words), RUN)
        if not len(runs) or not len(self.values):
            return
        at = np.unique(W.window_minima(runs, min(WINDOW, len(runs))))
        known = self.values[np.minimum(np.searchsorted(self.values, runs[at]), len(self.values) - 1)] == runs[at]
        diagonals = defaultdict(list)
        for place in at[known].tolist():
            for name, own in self.places[int(runs[place])]:
                diagonals[name].append((place - own, place))
        for name, found in diagonals.items():
            found.sort()
            start = 0
            for k in range(1, len(found)):
                if found[k][0] - found[k - 1][0] > BAND:
                    yield name, found[start:k]
                    start = k
            yield name, found[start:]


def align(template: list[bytes], words: list[bytes], low: int, high: int) -> tuple[int, int, int]:
    """Longest common subsequence within the band of diagonals ``low - BAND`` to ``high + BAND``.

    In a wide band one near its middle is taken, so that what is left on both sides is about half of it. Returns the number of common words and the first and last of them in ``words``, the last not included.
    """
    first, width = low - BAND, high - low + 2 * BAND + 1
    # Cell k of row i stands for word i + first + k of the document.
    rows, above = [np.zeros(width, np.int32)], np.zeros(width + 1, np.int32)
    for i, word in enumerate(template):
        equal = np.fromiter((0 <= j < len(words) and words[j] == word for j in range(i + first, i + first + width)), bool, width)
        # One row up, the same word of the document is one cell further right, and the word before it is this cell.
        row = np.maximum.accumulate(np.maximum(above[1:], above[:-1] + equal))
        rows.append(row)
        above = np.append(row, row[-1])
    i, k = len(template), int(np.argmax(rows[-1] == rows[-1][-1]))
    if width > 16 * BAND:
        k = max(k, width // 2)
    common, begin, end = int(rows[-1][-1]), -1, -1
    left = common
    while i and left:
        j = i - 1 + first + k
        up = rows[i - 1][min(k + 1, width - 1)]
        if 0 <= j < len(words) and words[j] == template[i - 1] and rows[i - 1][k] == left - 1:
            begin, end = j, max(end, j + 1)
            i, left = i - 1, left - 1
        elif k and rows[i][k - 1] == left:
            k -= 1
        elif up == left:
            i, k = i - 1, min(k + 1, width - 1)
        else:
            i, left = i - 1, left - 1
    return common, max(begin, 0), max(end, 0)


def statements(template: list[bytes], words: list[bytes], hits: list[tuple[int, int]], least: int) -> Iterator[tuple[int, int, int]]:
    """First word, end and common words of all alignments that reach the coverage, none of which overlap."""
    stretches = [(0, len(words), hits)]
    while stretches:
        start, stop, inside = stretches.pop()
        inside = [hit for hit in inside if start <= hit[1] < stop]
        if not inside:
            continue
        low, high = inside[0][0], inside[-1][0]
        first, last = max(start, low - BAND), min(stop, len(template) + high + BAND)
        common, begin, end = align(template, words[first:last], low - first, high - first)
        if common * 100 < least * len(template):
            continue
        begin, end = begin + first, end + first
        # Words of two statements may make one alignment: it is parted where both sides reach the coverage.
        room = -(-least * len(template) // 100)
        cut = next((c for c in range(begin + room, end - room + 1) if all(
            align(template, words[x:y], low - x, high - x)[0] * 100 >= least * len(template) for x, y in ((begin, c), (c, end))
        )), None) if room else None
        if cut is None:
            yield begin, end, common
            stretches += [(start, begin, inside), (end, stop, inside)]
        else:
            stretches += [(start, cut, inside), (cut, stop, inside)]


def matches(index: Index, text: bytes | None, least: int = LEAST_COVERAGE) -> list[tuple[str, int, int, int, int]]:
    """Name, first word, end, common words and words of the template for each match, in the document's order."""
    words = W.alnum_words(text)
    found = []
    for name, hits in index.candidates(words):
        template = index.templates[name]
        found.extend((name, begin, end, common, len(template)) for begin, end, common in statements(template, words, hits, least))
    found.sort(key=lambda m: (-m[3], m[4] - m[3], m[1], m[0]))
    kept: list[tuple[str, int, int, int, int]] = []
    for match in found:
        if all(match[2] <= other[1] or match[1] >= other[2] for other in kept):
            kept.append(match)
    return sorted(kept, key=lambda m: m[1])


_MATCHES = pa.schema(
    [("doc_id", pa.int64()), ("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("n_matched", pa.int64()), ("n_template", pa.int64()), ("coverage", pa.float64())]
)


def _scan(templates: Mapping[str, str], least: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)

        def rows():
            for part in parts:
                for doc_id, text in zip(part.column(0).to_pylist(), W.texts(part.column(1))):
                    for name, begin, end, common, size in matches(index, text, least):
                        yield doc_id, name, begin, end, common, size, common / size

        yield from W.batches(rows(), _MATCHES)

    return go


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: int = LEAST_COVERAGE) -> DataFrame:
    """``doc_id, license, start_word, end_word, n_matched, n_template, coverage``: one row per match."""
    columns = "doc_id long, license string, start_word long, end_word long, n_matched long, n_template long, coverage double"
    return keyed_texts(docs).mapInArrow(_scan(dict(templates), least), columns)
