"""Sequences for instruction data: vector bin packing under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marketloom.llm.filetokens import FileTokens

LENGTH, SEGMENTS = 2048, 512
BLOCK = 384  # remainders that are packed together
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, loss_tokens bigint"
)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> FileTokens:
    return FileTokens(path)


class Packer:
    """Bins are filled one after another. The item taken next is the one whose demand (tokens,
    one segment, loss-bearing tokens, each as a share of its limit) has the largest dot product
    with what the bin has left, among those that fit. When none fits, an item is cut to fill the
    bin to its last token. Items are (doc, start, length, loss); a document's loss-bearing tokens are those from
    ``first[doc]`` on, so a cut knows which side they fall on.
    """

    def __init__(self, length: int, segments: int, loss: int) -> None:
        self.limits = np.array([length, segments, loss], np.int64)
        self.first: dict[int, int] = {}

    def item(self, doc: int, start: int, length: int) -> tuple[int, int, int, int]:
        return doc, start, length, max(0, start + length - max(start, self.first.get(doc, 0)))

    def _cut(self, item: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, length, _ = item
        return self.item(doc, start, at), self.item(doc, start + at, length - at)

    def pack(self, items: list[tuple], final: bool) -> tuple[list[list[tuple]], list[tuple]]:
        """Full bins, and the items of the last bin that isn't full (packed too if ``final``)."""
        demand = np.array([[x[2], 1, x[3]] for x in items], np.int64).reshape(-1, 3)
        free = np.ones(len(items), bool)
        bins: list[list[tuple]] = []
        while free.any():
            left, chosen = self.limits.copy(), []
            while True:
                fits = np.flatnonzero(free & (demand <= left).all(axis=1))
                if len(fits):
                    best = fits[np.argmax((demand[fits] / self.limits) @ (left / self.limits))]
                    chosen.append(items[best])
                    left = left - demand[best]
                    free[best] = False
                    continue
                if left[0] and left[1] and free.any():
                    # the longest is cut: its front fills the bin, as far as loss-bearing tokens allow
                    rest = np.flatnonzero(free)
                    best = rest[np.argmax(demand[rest, 0])]
                    doc, start, length, loss = items[best]
                    unscored = max(0, self.first.get(doc, 0) - start)
                    at = int(min(left[0], length - 1, unscored + left[2]))
                    if at > 0:
                        front, back = self._cut(items[best], at)
                        if front[3] <= left[2]:
                            chosen.append(front)
                            items[best], demand[best] = back, (back[2], 1, back[3])
                            left = left - np.array([front[2], 1, front[3]])
                            continue
                break
            if left[0] and not final and not free.any():
                return bins, chosen
            bins.append(chosen)
        return bins, []

    def split(self, chosen: list[tuple]) -> list[list[tuple]]:
        """A bin that isn't full as sequences of power-of-two lengths, which need no padding."""
        total, out, queue = sum(x[2] for x in chosen), [], list(reversed(chosen))
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            sequence = []
            while size:
                item = queue.pop()
                if item[2] > size:
                    item, back = self._cut(item, size)
                    queue.append(back)
                sequence.append(item)
                size -= item[2]
            out.append(sequence)
        return out


def _pack(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int, segments: int, loss: int
) -> Iterator[pa.RecordBatch]:
    tool, packer = tokenizer(path), Packer(length, segments, loss)
    end = np.array([end_id], "<u4").tobytes()
    partition = TaskContext.get().partitionId()
    count = 0
    held: dict[int, tuple] = {}  # per document with open items: (doc_id, its ids, number of ids)
    items: list[tuple] = []

    def rows(sequences: list[list[tuple]], count: int) -> pa.RecordBatch:
        out = []
        for k, sequence in enumerate(sequences):
            offset = 0
            for doc, start, size, lossy in sequence:
                doc_id, ids, n = held[doc]
                out.append((doc_id, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), n, (partition << 40) + count + k, offset, lossy))
                offset += size
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] or [pa.array([], pa.int64())] * 8, names)

    seen = 0
    for batch in batches:
        for doc_id, text, scored in zip(*(c.to_pylist() for c in batch.columns)):
            ids = (tool.encode(text) if text else b"") + end
            n, step = len(ids) // 4, min(length, loss)
            held[seen] = (doc_id, ids, n)
            packer.first[seen] = 0 if scored is None else n - min(max(scored, 0), n)
            items += [packer.item(seen, s, min(step, n - s)) for s in range(0, n, step)]
            seen += 1
            if len(items) >= BLOCK:
                full = [[x] for x in items if x[2] == length]
                bins, items = packer.pack([x for x in items if x[2] < length], False)
                full += [s for b in bins for s in ([b] if sum(x[2] for x in b) == length else packer.split(b))]
                if full:
                    yield rows(full, count)
                    count += len(full)
                still = {x[0] for x in items}
                held = {k: v for k, v in held.items() if k in still}
                packer.first = {k: v for k, v in packer.first.items() if k in still}
    full = [[x] for x in items if x[2] == length]
    bins, _ = packer.pack([x for x in items if x[2] < length], True)
    full += [s for b in bins for s in ([b] if sum(x[2] for x in b) == length else packer.split(b))]
    if full:
        yield rows(full, count)


def pack(
    docs: DataFrame, path: str, end_id: int = 1, length: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", loss_col: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    A row's ids are those of the tokenizer file at ``path`` (on every executor), then ``end_id``. The last ``loss_col`` of them
    bear loss, as the answer behind an unscored prompt does; all of them without that column, or where it is null. Null and empty texts are the one id ``end_id``. Each row is packed once; rows that
    repeat an id are separate documents under that id, and rows without an id keep a null id. Other
    columns are ignored. Each task packs its rows in blocks and hands what doesn't fill a bin to its next
    block, so nothing is shuffled; its last bin becomes sequences of power-of-two lengths. Sequence ids
    hold the partition's number, so a task that runs again gives the same rows.
    """
    scored = f"cast(`{loss_col}` as bigint)" if loss_col else "cast(null as bigint)"
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text", f"{scored} as scored")
    return rows.mapInArrow(
        partial(_pack, path=path, end_id=end_id, length=length, segments=segments, loss=loss or length), SCHEMA
    )
