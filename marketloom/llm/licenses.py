"""License notices in documents: MinHash bands over overlapping windows, exact shingle containment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketloom.llm.common import as_bytes, chunks, mix
from marketloom.llm.minhash import sketches
from marketloom.llm.shingles import word_hashes, _PLACES

WORDS, PERCENT = 5, 75
# One sketch place per band. A window that holds a notice shares at least 1 in 12 of all shingles with it (a
# notice of 5 words in a window of 16), so it shares no band with a chance of at most (11/12)**128 = 1.5e-5.
BANDS = 128

# Public notices.
TEMPLATES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "gpl-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}
# Letters, digits and bytes of other scripts make words; ASCII punctuation separates.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _rolled(hashes: np.ndarray) -> np.ndarray:
    n = max(0, len(hashes) - WORDS + 1)
    out = np.zeros(n, np.uint64)
    for j in range(WORDS):
        out += hashes[j : j + n] * _PLACES[j]
    return mix(out)


@dataclass
class Library:
    """Templates by size: for each number of words 2**j the band tables of the templates it can hold."""

    names: list[str]
    sets: list[np.ndarray]
    sizes: dict[int, dict[int, list[int]]]  # words -> band key -> templates
    all: np.ndarray


@lru_cache(maxsize=4)
def library(items: tuple[tuple[str, str], ...]) -> Library:
    names, sets, sizes = [], [], {}
    with np.errstate(over="ignore"):
        for i, (name, text) in enumerate(items):
            hashes, _ = word_hashes([text.encode().translate(_PLAIN)])
            if len(hashes) < WORDS:
                raise ValueError(f"A template needs at least {WORDS} words: {name}")
            names.append(name)
            sets.append(np.unique(_rolled(hashes)))
            size = max(8, 1 << (len(hashes) - 1).bit_length())
            for b, v in enumerate(sketches([sets[-1]], BANDS)[0].tolist()):
                sizes.setdefault(size, {}).setdefault(b << 64 | v, []).append(i)
    return Library(names, sets, sizes, np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64))


def matches(hashes: np.ndarray, lib: Library, percent: int) -> dict[int, tuple[int, int]]:
    """Per template found in a text of these word hashes: (shingles matched, first word of the window)."""
    rolled = _rolled(hashes)
    known = np.isin(rolled, lib.all)  # a window without any template's shingle contains no template
    best: dict[int, tuple[int, int]] = {}
    if not known.any():
        return best
    seen = np.concatenate(([0], np.cumsum(known)))
    for size, table in lib.sizes.items():
        starts = np.arange(0, max(1, len(rolled)), size)
        ends = np.minimum(starts + 2 * size - WORDS + 1, len(rolled))
        starts, ends = starts[(hit := seen[ends] > seen[starts])], ends[hit]
        windows = [np.unique(rolled[s:e]) for s, e in zip(starts, ends)]
        for s, window, sketch in zip(starts, windows, sketches(windows, BANDS)):
            found = {t for b, v in enumerate(sketch.tolist()) for t in table.get(b << 64 | v, ())}
            for t in found:
                n = len(np.intersect1d(window, lib.sets[t], assume_unique=True))
                if 100 * n >= percent * len(lib.sets[t]) and n > best.get(t, (0, 0))[0]:
                    best[t] = (n, int(s))
    return best


def _scan(batches: Iterator[pa.RecordBatch], items: tuple[tuple[str, str], ...], percent: int) -> Iterator[pa.RecordBatch]:
    lib = library(items)
    with np.errstate(over="ignore"):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            out = []
            for lo, hi in chunks(texts):
                hashes, bounds = word_hashes([t.translate(_PLAIN) for t in texts[lo:hi]])
                for i in range(lo, hi):
                    for t, (n, at) in sorted(matches(hashes[bounds[i - lo] : bounds[i - lo + 1]], lib, percent).items()):
                        out.append((ids[i], lib.names[t], n, len(lib.sets[t]), at))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                ["doc_id", "license", "n_matched", "n_template", "word"],
            )


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, license, n_matched, n_template, word): a row per document and template of which a window of its text
    holds at least ``percent`` of 100 shingles; ``word`` is where the best such window starts.

    For templates of up to s words (s a power of two) windows have 2 * s words and start every s words, so any s
    words in a row lie in one. Words are runs of letters and digits, A-Z lower-cased. Null, empty and shorter texts
    match nothing. Rows that repeat an id are scanned each. Other columns are ignored.
    """
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    items = tuple((TEMPLATES if templates is None else templates).items())
    return rows.mapInArrow(
        partial(_scan, items=items, percent=percent),
        "doc_id bigint, license string, n_matched bigint, n_template bigint, word bigint",
    )
