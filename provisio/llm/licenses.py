"""License scans (operator 10): MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them.

A template's shingles are its runs of five words (letters and digits, lower-cased).
Templates are put into classes by size: class c (2, 4, 8, ...) has those of more than c/2
and up to c shingles (class 2 also those of one).  A text is cut into blocks of c shingles,
and its windows are all pairs of neighbouring blocks, so every passage of c shingles lies
whole in a window.  A window holding 0.75 of a template has a Jaccard similarity of at
least 0.17 with it; with 32 bands of one MinHash each such a window collides in
some band with a probability of at least 1 - 0.83**32 = 0.997 (0.9999 for a whole
template).  A collision only proposes the pair; the window's exact containment of the
template's shingles decides.

Signatures are maxima of the shingles' hashes times odd numbers, block by block in numpy, so
memory is bounded by a slice of texts and every word is covered.  Templates are broadcast
(``MAX_TEMPLATE_WORDS`` bounds them).  A template of fewer than five words is one shingle of its
words, which no text window has; give longer ones.

Null and empty texts match nothing.  Repeated rows match as often as they occur and null
ids are kept; empty tables give no rows; other columns are ignored.  A text that holds
two similar templates' words (two versions of one license) is reported with both and
their containments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from provisio.llm import wordhash as wh
from provisio.llm.common import slices, texts

SHINGLE = 5
CONTAINMENT = 0.75
BANDS = 32
MAX_TEMPLATE_WORDS = 1_000_000

#: fixed values: notices, standard headers and passages of common licenses; a license may have several wordings
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-licensed": "Licensed under the MIT License.",
    "mit-notice-distributed": "Distributed under the MIT License.",
    "mit-notice-terms": "under the terms of the MIT License.",
    "mit-notice-an": "licensed under an MIT license.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                      "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                      "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                      "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
                      "conditions: The above copyright notice and this permission notice shall be included in all copies or "
                      "substantial portions of the Software.",
    "mit-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
                    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
                    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
                    "SOFTWARE.",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                      "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
                    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
                    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
                    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
                    "OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-notice": "Redistributed under the BSD License.",
    "bsd-notice-licensed": "Licensed under the BSD License.",
    "bsd-style-notice": "use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                      "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
                      "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
                      "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
                      "materials provided with the distribution.",
    "bsd-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                       "products derived from this software without specific prior written permission.",
    "bsd-warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
                    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
                    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
                    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
                    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
                    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice-released": "Released under the Apache License 2.0.",
    "apache-2.0-notice-short": "licensed under the Apache 2.0 license.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License.",
    "apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
                        "REPRODUCTION, AND DISTRIBUTION",
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice-released": "Released under the GNU General Public License.",
    "gpl-notice-terms": "under the terms of the GNU General Public License",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                      "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                      "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
                      "GNU General Public License for more details.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                      "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                      "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
                      "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
                      "GNU General Public License for more details.",
    "gpl-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is "
                     "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                       "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
                       "your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY "
                       "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
                       "Lesser General Public License for more details.",
    "lgpl-notice-terms": "under the terms of the GNU Lesser General Public License",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                       "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                       "your option) any later version.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                      "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-notice-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-sa-4.0-notice-short": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-notice-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc0-1.0-title": "CC0 1.0 Universal Public Domain Dedication",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                 "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                 "commercial or non-commercial, and by any means.",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
            "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
            "including commercial applications, and to alter it and redistribute it freely.",
    "boost-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
}


def _shingles(text: str) -> np.ndarray:
    words = wh.split([text.encode()], wh.ALNUM_LOWER)
    h = wh.word_hashes(words, wh.ALNUM_LOWER)
    return np.unique(wh.runs(h, min(SHINGLE, len(h))) if len(h) else np.zeros(0, np.uint64)) | np.uint64(1)


def size_class(n: int) -> int:
    return max(2, 1 << (n - 1).bit_length())


class Scanner:
    def __init__(self, templates: dict[str, str], bands: int = BANDS, containment: float = CONTAINMENT):
        self.names = sorted(templates)
        self.sets = [np.unique(_shingles(templates[n])) for n in self.names]
        self.containment = containment
        self.factors = np.random.default_rng(11).integers(1, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.classes: dict[int, list[int]] = {}
        for t, s in enumerate(self.sets):
            if len(s):
                self.classes.setdefault(size_class(len(s)), []).append(t)
        self.largest = max(self.classes, default=2)

    def scan(self, parts: list[bytes]) -> list[tuple[int, int, float, int]]:
        """(text, template, containment, first word of the window): the best window of each match."""
        words = wh.split(parts, wh.ALNUM_LOWER)
        h = wh.word_hashes(words, wh.ALNUM_LOWER)
        s = wh.runs(h, SHINGLE) | np.uint64(1)
        own = np.maximum(np.diff(words.first) - SHINGLE + 1, 0)          # shingles of each text
        if not own.any() or not self.classes:
            return []
        # Every text is padded to whole blocks of the largest class; 0 never is a maximum.
        room = -(-own // self.largest) * self.largest
        at = np.concatenate([[0], np.cumsum(room)])
        inside = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        x = np.zeros(int(at[-1]), dtype=np.uint64)
        x[inside + np.repeat(at[:-1], own)] = s[inside + np.repeat(words.first[:-1], own)]
        proposed: set[tuple[int, int, int]] = set()
        for f in self.factors:
            block = x * f
            c = 1
            while c < self.largest:
                block, c = np.maximum(block[0::2], block[1::2]), c * 2
                if c in self.classes:
                    window = np.maximum(block, np.append(block[1:], np.uint64(0)))
                    low = np.zeros(1 << 16, bool)
                    marks = {}
                    for t in self.classes[c]:
                        top = (self.sets[t] * f).max()
                        marks.setdefault(int(top), []).append(t)
                        low[int(top) & 0xFFFF] = True
                    for i in np.flatnonzero(low[(window & np.uint64(0xFFFF)).astype(np.uint16)]):
                        for t in marks.get(int(window[i]), ()):
                            proposed.add((t, c, int(i)))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for t, c, i in sorted(proposed):
            doc = int(np.searchsorted(at, i * c, "right")) - 1
            seen = x[i * c:min(int(at[doc + 1]), (i + 2) * c)]
            share = np.isin(self.sets[t], seen, assume_unique=False).sum() / len(self.sets[t])
            if share >= self.containment and share > best.get((doc, t), (0.0, 0))[0]:
                best[doc, t] = float(share), int(i * c - at[doc])
        return [(d, t, share, place) for (d, t), (share, place) in sorted(best.items())]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT,
                 bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and template held: doc_id, license, containment, at (the window's first word)."""
    templates = TEMPLATES if templates is None else templates
    if sum(len(t.split()) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of over {MAX_TEMPLATE_WORDS} words are not broadcast; scan them in parts")
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates, bands, containment))

    def run(batches):
        scanner = shared.value
        for ids, text in slices(batches, 1_000_000):
            found = scanner.scan([(t or "").encode("utf-8", "surrogatepass") for t in text])
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[d] for d, *_ in found], pa.int64()), pa.array([scanner.names[t] for _, t, *_ in found], pa.string()),
                 pa.array([s for *_, s, _ in found], pa.float64()), pa.array([p for *_, p in found], pa.int64())],
                names=["doc_id", "license", "containment", "at"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, license string, containment double, at long")
