"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, the rest by a heap over linked bytes."""

from __future__ import annotations

import base64
import re
import string
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

BATCH_BYTES = 4 << 20

# The characters of Unicode's White_Space property.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# White space other than one plain space.
_RUN = re.compile(f"([{_WHITE}]{{2,}}|[{_WHITE.replace(' ', '')}])")


class PerfectHash:
    """A minimal perfect hash over the vocabulary: buckets of keys, most crowded first, look for a
    displacement that sends their keys to free slots; single keys take a free slot directly."""

    def __init__(self, keys: list[bytes]) -> None:
        n = self.n = len(keys)
        m = self.m = max(1, n // 2)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        buckets: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            buckets.setdefault(h % m, []).append(i)
        self.shift, self.slots = [0] * m, [-1] * n
        crowded = sorted(buckets.items(), key=lambda x: -len(x[1]))
        at = 0
        for at, (b, members) in enumerate(crowded):
            if len(members) == 1:
                break
            d = 1
            while True:
                places = [self._place(hashes[i], d) for i in members]
                if len(set(places)) == len(places) and all(self.slots[p] < 0 for p in places):
                    break
                d += 1
            self.shift[b] = d
            for p, i in zip(places, members):
                self.slots[p] = i
        else:
            at = len(crowded)
        free = (p for p in range(n) if self.slots[p] < 0)
        for b, (i,) in crowded[at:]:
            p = next(free)
            self.shift[b], self.slots[p] = -p - 1, i
        self.keys = keys

    def _place(self, h: int, d: int) -> int:
        return ((h >> 20) + d * ((h >> 41) | 1) + d * d) % self.n

    def get(self, key: bytes) -> int:
        """The key's index, -1 if it isn't in the vocabulary (its slot's key is compared)."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.m]
        i = self.slots[-d - 1 if d < 0 else self._place(h, d)]
        return i if self.keys[i] == key else -1


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of a pre-token that isn't a token itself: the pair of lowest rank, leftmost
    first, until none is left. A heap holds candidate pairs over linked pieces; an entry whose
    pieces have changed since is skipped."""
    n = len(word)
    stop = list(range(1, n + 1))  # piece starting at i ends at stop[i]; 0: merged away
    before = list(range(-1, n))
    get = ranks.get
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, mid, end = heappop(heap)
        if stop[i] != mid or mid >= n or stop[mid] != end:
            continue
        stop[i], stop[mid] = end, 0
        if end < n:
            before[end] = i
            if (r := get(word[i : stop[end]])) is not None:
                heappush(heap, (r, i, end, stop[end]))
        if i:
            p = before[i]
            if (r := get(word[p:end])) is not None:
                heappush(heap, (r, p, i, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : stop[i]]])
        i = stop[i]
    return out


class Units(dict):
    """Ids of texts by their units, the pieces between white space: as a dict, the ids of " " + unit.

    A text's pre-tokens are those of its units in order, each with the one space before it, and of the
    rest of the white space: a run followed by a word is one pre-token but for its last character, which
    belongs to the word if it is a space and else stands alone. Pre-tokens don't reach from a letter to
    punctuation either: a unit that ends in punctuation is its word and that ending. So units that
    repeat are resolved once per worker.
    """

    room = 500_000  # units kept per worker; beyond it units are resolved again each time
    mark = None  # a string that units holding it must not be cut in

    def __init__(self) -> None:
        self.plain: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """The ids of any text, as native 32-bit integers."""
        raise NotImplementedError

    def _kept(self, store: dict[str, bytes], key: str, text: str) -> bytes:
        ids = self.whole(text)
        if len(store) < self.room and len(key) < 64:
            store[key] = ids
        return ids

    def unspaced(self, text: str) -> bytes:
        """The ids of a unit with no space before it, of an ending, or of white space."""
        ids = self.plain.get(text)
        return self._kept(self.plain, text, text) if ids is None else ids

    def __missing__(self, unit: str) -> bytes:
        word = unit.rstrip(string.punctuation)
        if word != unit and word and word[-1].isalpha() and not (self.mark and self.mark in unit):
            return self[word] + self.unspaced(unit[len(word) :])
        return self._kept(self, unit, " " + unit)

    def encode(self, text: str) -> bytes:
        parts = _RUN.split(text)
        out, spaced, last = [], False, len(parts) - 1
        for i, part in enumerate(parts):
            if not part:
                continue
            if i % 2 == 0:
                units = part.split(" ")
                out.append(self[units[0]] if spaced else self.unspaced(units[0]) if units[0] else b"")
                out.extend(map(self.__getitem__, units[1:]))
            elif i + 1 == last and not parts[last]:
                out.append(self.unspaced(part))
            else:
                spaced = part[-1] == " "
                if rest := part[:-1]:
                    out.append(self.unspaced(rest))
                if not spaced:
                    out.append(self.unspaced(part[-1]))
        return b"".join(out)


class Encoder(Units):
    """Units resolved by a rank file: the perfect hash for pre-tokens in the vocabulary, merges for others."""

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__()
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        tokens = list(self.ranks)
        self.ids = np.array([self.ranks[t] for t in tokens], np.int64)
        self.perfect = PerfectHash(tokens)
        self.split = regex.compile(pattern).findall

    def piece(self, text: str) -> list[int]:
        word = text.encode()
        at = self.perfect.get(word)
        return [int(self.ids[at])] if at >= 0 else merge(word, self.ranks)

    def whole(self, text: str) -> bytes:
        return np.array([i for t in self.split(text) for i in self.piece(t)], np.int32).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with open(path, "rb") as f:
        pairs = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    tokens = [pairs.get(i, b"") for i in range(max(pairs, default=-1) + 1)]
    sizes = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes


def decode_ids(ids: np.ndarray, path: str) -> bytes:
    data, start, sizes = _vocabulary(path)
    size = sizes[ids]
    at = np.repeat(start[ids] - (np.cumsum(size) - size), size)
    return data[at + np.arange(len(at))].tobytes()


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    tool = encoder(path, pattern)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        lo, done, size = 0, [], 0
        for i, text in enumerate(texts):
            done.append(tool.encode(text) if text else b"")
            size += len(done[-1])
            if size > BATCH_BYTES or i + 1 == len(texts):
                ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in done]))).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(done), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(ends), ids)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, i + 1 - lo), lists], ["doc_id", "ids"])
                lo, done, size = i + 1, [], 0


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1)
        flat = lists.values.to_numpy(zero_copy_only=False)
        ends = lists.offsets.to_numpy()
        texts = [decode_ids(flat[s:e], path) for s, e in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.binary())], ["doc_id", "ids", "bytes"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for every row, by the rank file at ``path`` (on every executor) and
    the pre-token pattern. Null and empty texts have no ids; rows are neither merged nor dropped,
    whatever their id; other columns are ignored. No special token is recognised."""
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    return rows.mapInArrow(partial(_encode, path=path, pattern=pattern), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, bytes) of (doc_id, ids): the bytes the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(
        partial(_decode, path=path), "doc_id bigint, ids array<int>, bytes binary"
    )
