"""License scans: MinHash bands over overlapping windows of words retrieve templates, exact containment confirms.

Window sizes follow the templates: a template of m shingles is looked for in windows of two blocks of b shingles,
where b is the least power of two that is not below m, one window starting at every block. So any stretch of m
shingles lies in a window. A window that holds three quarters of a template has a Jaccard similarity with it of
0.176 or more; with 64 bands of one row it then collides with a probability above 0.999995.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import ALNUM, grams, texts, words

#: Notices of public licenses, whole texts of the short ones, and the clauses that tell variants apart
#: (a text under three BSD clauses holds bsd-2-clause and bsd-3-clause). Long licenses are known by their notices.
TEMPLATES = {
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "boost-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "bsd-2-clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-4-clause": "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "mit-full": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}
_SEEDS = np.random.default_rng(23)
_XOR = _SEEDS.integers(1, 1 << 63, 256, dtype=np.uint64)
_TIMES = _SEEDS.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
FOUND = "array<struct<license:string,containment:double,first_word:int>>"


def template_shingles(text: str, size: int) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    hashes, _ = words(data, np.array([0, len(data)]), ALNUM)
    if len(hashes) < size:
        raise ValueError(f"a template needs {size} words: {text!r}")
    return np.unique(grams(hashes, size))


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 75,
    bands: int = 64,
) -> DataFrame:
    """doc_id and licenses: for each template found, its name, containment and the word its best window starts at.

    A template is found where a window holds percent or more of its distinct size-word shingles; case and
    punctuation do not count. Null, empty and wordless texts have none, and an empty table gives no rows. Of windows
    that hold equal shares the first is given. Rows are scanned one by one, so repeated rows and null keys need no
    care; a very long text is scanned in one task, as arrays. Only the two named columns are read, whatever others
    are called. Templates are a list given by the caller, so their tables are small and go with the tasks.
    """
    wanted = {name: template_shingles(x, size) for name, x in sorted((templates or TEMPLATES).items())}
    by_block: dict[int, list[str]] = {}
    for name, shingles in wanted.items():
        by_block.setdefault(1 << (len(shingles) - 1).bit_length(), []).append(name)
    marks = {name: ((x[None] ^ _XOR[:bands, None]) * _TIMES[:bands, None]).min(axis=1) for name, x in wanted.items()}
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_word", pa.int32())]))

    def candidates(shingles: np.ndarray, first: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, str, int, int]]:
        """Row, template, and first and end shingle of each window that collides in a band."""
        layout = {}
        for block in by_block:
            blocks = -(-counts // block)
            row = np.repeat(np.arange(len(counts)), blocks)
            nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            layout[block] = row, first[row] + nth * block, (first + counts)[row]
        hits = {name: np.zeros(len(layout[b][0]), dtype=bool) for b, names in by_block.items() for name in names}
        used = np.zeros(len(shingles), dtype=bool)
        for a, n in zip(first, counts):
            used[a : a + n] = True
        for k in range(bands):
            values = (shingles ^ _XOR[k]) * _TIMES[k]
            values[~used] = 0xFFFFFFFFFFFFFFFF
            for block, names in by_block.items():
                row, start, _ = layout[block]
                low = np.minimum.reduceat(values, start) if block > 1 else values[start]
                low[:-1] = np.where(row[1:] == row[:-1], np.minimum(low[:-1], low[1:]), low[:-1])
                for name in names:
                    hits[name] |= low == marks[name][k]
        for block, names in by_block.items():
            row, start, end = layout[block]
            for name in names:
                for w in np.flatnonzero(hits[name]):
                    yield int(row[w]), name, int(start[w]), int(min(start[w] + 2 * block, end[w]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: list[dict[str, tuple[float, int]]] = [{} for _ in range(batch.num_rows)]
            for first, end, data, starts in texts(batch.column(1), 1 << 21):
                hashes, before = words(data, starts, ALNUM)
                shingles = grams(hashes, size)
                counts = np.maximum(0, np.diff(before) - size + 1)
                rows = np.flatnonzero(counts)
                if not len(rows):
                    continue
                for row, name, a, b in candidates(shingles, before[rows], counts[rows]):
                    share = np.isin(wanted[name], shingles[a:b]).mean()
                    doc = first + int(rows[row])
                    if 100 * share >= percent and share > best[doc].get(name, (0.0, 0))[0]:
                        best[doc][name] = (float(share), a - int(before[rows[row]]))
            values = [[{"license": k, "containment": v[0], "first_word": v[1]} for k, v in sorted(x.items())] for x in best]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, kind)], names=["doc_id", "licenses"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(found, f"doc_id long, licenses {FOUND}")


def op3_license_scan(docs: DataFrame) -> DataFrame:
    """Per document how many templates it holds, their names and where the first begins."""
    return scan(docs).select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.col("licenses.license"), ",").alias("licenses"),
        F.array_min(F.col("licenses.first_word")).cast("long").alias("first_word"),
        F.array_max(F.col("licenses.containment")).alias("containment"),
    )
