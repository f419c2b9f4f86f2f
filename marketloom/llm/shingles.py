"""Word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

from marketloom.llm.common import ROLLING, chunks, mix, seeds

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_PLACES = seeds(64, 21) | np.uint64(1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the first word of each text (one more entry
    than texts). Words are maximal runs without ASCII white space; A-Z are lower-cased."""
    data = np.frombuffer(b"".join(t.lower() for t in texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~SPACE[data]
    first = solid[1:-1] & ~solid[:-2]
    last = solid[1:-1] & ~solid[2:]
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    first[cuts] = solid[1:-1][cuts]  # words end where texts end
    last[cuts - 1] = solid[1:-1][cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    prefixes = ROLLING.prefixes(data)
    return ROLLING.spans(prefixes, start, end), np.searchsorted(start, bounds)


def shingle_sets(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``words``-word shingles. A text with fewer words
    has one shingle of all of them; a text without words has none. 64-bit hashes stand for the
    shingles: two different shingles of a pair of texts agree with a chance of about 2**-60."""
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        for lo, hi in chunks(texts):
            hashes, bounds = word_hashes(texts[lo:hi])
            n = max(0, len(hashes) - words + 1)
            rolled = np.zeros(n, np.uint64)
            for j in range(words):
                rolled += hashes[j : j + n] * _PLACES[j]
            rolled = mix(rolled)
            for i in range(hi - lo):
                s, e = bounds[i], bounds[i + 1]
                if e - s >= words:
                    out.append(np.unique(rolled[s : e - words + 1]))
                elif e > s:
                    whole = (hashes[s:e] * _PLACES[: e - s]).sum(dtype=np.uint64) + np.uint64(e - s)
                    out.append(mix(np.array([whole], np.uint64)))
                else:
                    out.append(np.zeros(0, np.uint64))
    return out
