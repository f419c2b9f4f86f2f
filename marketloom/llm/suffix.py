"""Repeated byte strings across documents, found by sampled suffixes and induced sorting.

A string of 50 bytes holds, by the choice of a minimizer, one sampled suffix at a place that its bytes
alone decide. Only the sampled suffixes (one in sixteen bytes) are shuffled and sorted, by Spark's and numpy's
sorts; what lies between them is induced: equal names of the stretch around a sampled suffix settle all
50-byte strings in it at once, and where stretches differ, the order of the sampled suffixes and their common
prefixes is carried leftwards, one byte at a time, to every position in front of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketloom.llm.common import ROLLING, as_bytes, chunks, mix, staged

LENGTH = 50  # bytes of a repeat
SEED = 20  # bytes of a sampled suffix that decide whether it is sampled
AHEAD = LENGTH - SEED + 1  # positions a minimizer is chosen from
HALF = 15  # bytes by which the second pass lengthens a seed, to the left or the right
COVERED, OPEN, SAME, MASK = 0, 1, 2, 3
PER_BUCKET = 300_000  # sampled suffixes a group holds on average


def _planes(a: np.ndarray) -> bytes:
    """Integers byte place by byte place, over their minimum, so that block compression sees runs."""
    a = a.astype(np.uint64)
    low = int(a.min(initial=np.iinfo(np.uint64).max)) if len(a) else 0
    d = a - np.uint64(low)
    width = (int(d.max(initial=0)).bit_length() + 7) // 8
    return struct.pack("<QBI", low, width, len(a)) + np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _integers(b: bytes) -> np.ndarray:
    low, width, n = struct.unpack_from("<QBI", b)
    out = np.zeros((n, 8), np.uint8)
    if width and n:
        out[:, :width] = np.frombuffer(b, np.uint8, offset=13).reshape(width, n).T
    return out.view(np.uint64).reshape(-1) + np.uint64(low)


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position, by doubling."""
    base = ROLLING.BASE
    h = {1: ROLLING.LETTERS[data]}
    for n in (1, 2, 4, 8):
        h[2 * n] = h[n][:-n] * np.uint64(pow(base, n, 1 << 64)) + h[n][n:]
    rest = SEED - 16
    return mix(h[16][: len(data) - SEED + 1] * np.uint64(pow(base, rest, 1 << 64)) + h[rest][16 : 16 + len(data) - SEED + 1])


def sampled(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of the documents data[bounds[i]:bounds[i+1]]: place, first and last start of the 50-byte
    strings they are the minimizer of, seed hash, hash of the stretch those strings cover."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    seeds = _seed_hashes(data)
    best = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
    for step in (1, 2, 4, 8, 15):  # minimum over 2, 4, 8, 16, 31 positions; the leftmost of equals
        best = np.minimum(best[:-step], best[step:])
    place = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)[:n]
    inside = np.zeros(len(data) + 1, np.int8)
    for s, e in zip(bounds[:-1], bounds[1:]):
        if e - s >= LENGTH:
            inside[s] += 1
            inside[e - LENGTH + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[:n]))
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    # minimizers never move left, so equal ones are neighbours; a document's end ends a run
    at = place[starts]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = starts[new]
    last = starts[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))]
    where = at[new]
    return where, first, last, seeds[where], ROLLING.spans(ROLLING.prefixes(data), first, last + LENGTH)


def _sample(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket of the seed hash the sampled suffixes of a block of documents. A stretch that occurs again in
    the block is settled here: in a later document it is covered, in the same one it has the first's fate. Those
    go to a bucket of the document's, so a very frequent stretch costs its bucket one row per block."""
    with np.errstate(over="ignore"):
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), as_bytes(batch.column(1))
            for lo, hi in chunks(texts):
                order = lo + np.argsort(ids[lo:hi], kind="stable")
                part = [texts[i] for i in order]
                own = ids[order]
                bounds = np.concatenate(([0], np.cumsum([len(t) for t in part]))).astype(np.int64)
                place, first, last, seed, name = sampled(np.frombuffer(b"".join(part), np.uint8), bounds)
                if not len(place):
                    continue
                row = np.searchsorted(bounds, place, side="right") - 1
                doc, pos = own[row], place - bounds[row]
                span = ((place - first) << 6 | (place - last)).astype(np.int64)
                by = np.argsort(seed ^ (name * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
                new = np.concatenate(([True], (seed[by][1:] != seed[by][:-1]) | (name[by][1:] != name[by][:-1])))
                head = by[new][np.cumsum(new) - 1]  # the first of its stretch, for each of ``by``
                rest, head = by[~new], head[~new]
                kind = np.where(doc[rest] == doc[head], SAME, COVERED)
                one = by[new]
                out = []
                for rows_, kinds, key in ((one, None, ((seed[one] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)), (rest, kind, doc[rest] % buckets)):
                    sort = np.argsort(key, kind="stable")
                    key, rows_ = key[sort], rows_[sort]
                    cuts = np.flatnonzero(np.diff(key)) + 1
                    for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))):
                        if e > s:
                            r = rows_[s:e]
                            more = [seed[r] & np.uint64((1 << 40) - 1), name[r] >> np.uint64(16)] if kinds is None else [kinds[sort[s:e]], pos[head[sort[s:e]]]]
                            out.append((int(key[s]), kinds is not None, *map(_planes, (doc[r].astype(np.int64).view(np.uint64), pos[r], span[r], *more))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.bool_(), *[pa.binary()] * 5))],
                    ["bucket", "settled", "docs", "places", "spans", "one", "two"],
                )


SAMPLE_SCHEMA = "bucket int, settled boolean, docs binary, places binary, spans binary, one binary, two binary"
ANSWER_SCHEMA = "doc_id bigint, code bigint, ref bigint"


def _answers(doc: np.ndarray, kind, pos: np.ndarray, span: np.ndarray, ref: np.ndarray) -> pa.Table:
    code = (np.asarray(kind, np.int64) << 60) | (span.astype(np.int64) << 44) | pos.astype(np.int64)
    return pa.table({"doc_id": pa.array(doc.view(np.int64)), "code": pa.array(code), "ref": pa.array(ref.astype(np.int64))})


def _name(group: pa.Table) -> pa.Table:
    """Sorts a bucket's sampled suffixes by seed, stretch and document. A stretch is covered in every document but
    the first that has it; there it stays open if other documents have the seed in another stretch."""
    settled = group["settled"].to_pylist()
    parts: tuple[list, list] = ([], [])
    for i, s in enumerate(settled):
        parts[s].append([_integers(group[c][i].as_py()) for c in ("docs", "places", "spans", "one", "two")])
    done = [np.concatenate(c) for c in zip(*parts[1])] or [np.zeros(0, np.uint64)] * 5
    out = [_answers(done[0], done[3], done[1], done[2], done[4])]
    if parts[0]:
        doc, pos, span, seed, name = (np.concatenate(c) for c in zip(*parts[0]))
        doc = doc.view(np.int64)
        by = np.lexsort((doc, name, seed))
        doc, pos, span, seed, name = doc[by], pos[by], span[by], seed[by], name[by]
        of_seed = np.concatenate(([True], seed[1:] != seed[:-1]))
        of_name = of_seed | np.concatenate(([True], name[1:] != name[:-1]))
        heads = np.flatnonzero(of_name)
        first = doc[heads][np.cumsum(of_name) - 1]
        covered = doc > first
        group_of = np.cumsum(of_seed) - 1
        starts = np.flatnonzero(of_seed)
        names = np.add.reduceat(of_name.astype(np.int64), starts)
        several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
        opened = of_name & ((names > 1) & several)[group_of]
        # an open stretch ends as a witness for others or as covered in part
        for mask, kind in ((covered, COVERED), (opened, OPEN)):
            out.append(_answers(doc[mask], np.full(mask.sum(), kind), pos[mask], span[mask], np.zeros(mask.sum(), np.int64)))
    return pa.concat_tables(out)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of open stretches, under the hash of the seed lengthened by HALF to the side most of each string is on."""
    names = ["key", "doc_id", "place", "far", "near", "bytes"]
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        out: tuple[list, ...] = ([], [], [], [], [], [])
        for doc, text, codes in zip(batch.column("doc_id").to_pylist(), texts, batch.column("codes").to_pylist()):
            for code in codes:
                p, far, near = code & ((1 << 44) - 1), code >> 50 & 63, code >> 44 & 63
                for left, a, b in ((1, far, max(near, HALF)), (0, min(far, HALF - 1), near)):
                    if a < b or p - a < 0 or p - b + LENGTH > len(text):
                        continue
                    seed = text[p - HALF : p + SEED] if left else text[p : p + SEED + HALF]
                    for c, v in zip(out, (hash_bytes(seed) ^ left, doc, p, a, b, text[p - a : p - b + LENGTH])):
                        c.append(v)
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _KINDS)], names)
                out = ([], [], [], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _KINDS)], names)


_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def hash_bytes(b: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b) >> 1


def induce(right: np.ndarray, left: np.ndarray, near: np.ndarray, far: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each sampled suffix the bits o for which the string of LENGTH bytes that starts o bytes before it
    also starts o bytes before one of a document with a smaller id.

    ``right`` (n x LENGTH) holds the bytes from each suffix, ``left`` (n x AHEAD) those before it, nearest
    first, both with zeros beyond what is known; suffix i is asked for near[i] <= o <= far[i]. The suffixes
    are sorted once. One byte further left their order is induced by a stable sort on that byte alone, and
    the common prefix of new neighbours is one more than the least between them in the old order.
    """
    n = len(doc)
    bits = np.zeros(n, np.int64)
    if not n:
        return bits
    order = np.argsort(np.ascontiguousarray(right).view(f"S{right.shape[1]}").reshape(-1), kind="stable")
    differs = right[order[1:]] != right[order[:-1]]
    common = np.zeros(n, np.int64)  # with the one before; 0 for the first
    common[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), right.shape[1])
    most = np.iinfo(np.int64).max
    for o in range(AHEAD):
        asked = (near[order] <= o) & (o <= far[order])
        if asked.any():
            heads = np.flatnonzero(np.concatenate(([True], common[1:] < LENGTH)))
            own = doc[order]
            least = np.minimum.reduceat(np.where(asked, own, most), heads)
            run = np.cumsum(np.concatenate(([0], (common[1:] < LENGTH).astype(np.int64))))
            hit = asked & (own > least[run])
            bits[order[hit]] |= 1 << o
        if o + 1 == AHEAD:
            break
        go_on = far[order] > o
        if not go_on.any():
            break
        if not go_on.all():
            kept = np.flatnonzero(go_on)
            common = np.minimum.reduceat(common[: kept[-1] + 1], np.concatenate(([0], kept[:-1] + 1)))
            order = order[kept]
            common[0] = 0
        byte = left[order, o]
        move = np.argsort(byte, kind="stable")
        same = byte[move][1:] == byte[move][:-1]
        grown = np.zeros(len(order), np.int64)
        if same.any():
            a, b = move[:-1][same] + 1, move[1:][same] + 1
            pairs = np.stack((a, np.minimum(b, len(common))), axis=1).reshape(-1)
            grown[1:][same] = np.minimum.reduceat(np.append(common, 0), pairs)[::2] + 1
        order, common = order[move], grown
    return bits


def _induce(group: pa.Table) -> pa.Table:
    doc, place = group["doc_id"].to_numpy(), group["place"].to_numpy()
    far, near = group["far"].to_numpy(), group["near"].to_numpy()
    found = []
    # keys are independent: a large bucket is worked through in runs of whole keys
    by = np.argsort(group["key"].to_numpy(), kind="stable")
    keys = group["key"].to_numpy()[by]
    texts = group["bytes"].combine_chunks()
    start = 0
    while start < len(by):
        end = min(len(by), start + 200_000)
        while end < len(by) and keys[end] == keys[end - 1]:
            end += 1
        rows = by[start:end]
        right = np.zeros((len(rows), LENGTH), np.uint8)
        left = np.zeros((len(rows), AHEAD), np.uint8)
        for i, b in enumerate(texts.take(pa.array(rows)).to_pylist()):
            s = far[rows[i]]
            tail = b[s : s + LENGTH]
            right[i, : len(tail)] = np.frombuffer(tail, np.uint8)
            left[i, :s] = np.frombuffer(b[:s], np.uint8)[::-1]
        bits = induce(right, left, near[rows].astype(np.int64), far[rows].astype(np.int64), doc[rows])
        found.append((doc[rows], place[rows], bits))
        start = end
    doc, place, bits = (np.concatenate(c) for c in zip(*found))
    hit = bits > 0
    return _answers(doc[hit], np.full(hit.sum(), MASK), place[hit], np.zeros(hit.sum(), np.int64), bits[hit])


def covered_bytes(size: int, codes: list[int], refs: list[int]) -> np.ndarray:
    """Which bytes of a document of ``size`` bytes its answers cover."""
    edge = np.zeros(size + 1, np.int64)
    spans: dict[int, int] = {}
    masks: dict[int, int] = {}

    def cover(start: int, end: int) -> None:
        if 0 <= start < end <= size:
            edge[start] += 1
            edge[end] -= 1

    def masked(p: int, bits: int) -> None:
        while bits:
            o = (bits & -bits).bit_length() - 1
            cover(p - o, p - o + LENGTH)
            bits &= bits - 1

    low = (1 << 44) - 1
    for code, ref in zip(codes, refs):
        if code >> 60 == COVERED:
            spans[code & low] = code >> 44 & 4095
        elif code >> 60 == MASK:
            masks[code & low] = masks.get(code & low, 0) | ref
    for p, span in spans.items():
        cover(p - (span >> 6), p - (span & 63) + LENGTH)
    for p, bits in masks.items():
        masked(p, bits)
    for code, ref in zip(codes, refs):
        if code >> 60 == SAME:
            p, span = code & low, code >> 44 & 4095
            if ref in spans:
                cover(p - (span >> 6), p - (span & 63) + LENGTH)
            if ref in masks:
                masked(p, masks[ref])
    return np.cumsum(edge[:size]) > 0


def whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` with the other bytes of every UTF-8 character that loses some."""
    at = np.arange(len(text))
    start = (text & 0xC0) != 0x80
    lead = np.maximum.accumulate(np.where(start, at, 0))
    size = 1 + (text >= 0xC2) + (text >= 0xE0) + (text >= 0xF0)
    char = np.cumsum(start | (at - lead >= size[lead]))  # a stray byte is by itself
    return (np.bincount(char, weights=gone) > 0)[char]


def _remove(batches: Iterator[pa.RecordBatch], schema: pa.Schema, carried: list[str], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        out: tuple[list, ...] = ([], [], [], [])
        for text, codes, refs in zip(texts, batch.column("codes").to_pylist(), batch.column("refs").to_pylist()):
            starts, ends, kept = [], [], text
            if codes:
                gone = covered_bytes(len(text), codes, refs)
                if whole:
                    gone = whole_characters(np.frombuffer(text, np.uint8), gone)
                step = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
                starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for c, v in zip(out, (len(text), len(text) - len(kept), [{"start": int(s), "end": int(e)} for s, e in zip(starts, ends)], kept)):
                c.append(v)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carried), *(pa.array(c, schema.field(n).type) for c, n in zip(out, ("n_bytes", "n_removed", "spans", "kept")))],
            [*carried, "n_bytes", "n_removed", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text", whole: bool = False
) -> DataFrame:
    """(doc_id, .. carried columns, n_bytes, n_removed, spans array<struct<start, end>>, kept binary): every
    document with the bytes covered by a LENGTH-byte string that also starts in a document of smaller id removed;
    with ``whole``, also the other bytes of a character of which some are.

    Null and empty texts have no bytes; texts shorter than LENGTH lose nothing. Rows without an id are left out. Rows
    that repeat an id and a text get that document's result each; an id never counts as smaller than itself. Columns
    that aren't named in ``carry`` are ignored.
    """
    names = {c: f"__c{i}" for i, c in enumerate(carry)}
    docs = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(n) for c, n in names.items())
    ).filter("doc_id is not null")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * tasks, ceil(total / 16 / PER_BUCKET))

    sample = docs.select("doc_id", "text").mapInArrow(partial(_sample, buckets=buckets), SAMPLE_SCHEMA)
    answers = staged(sample.groupBy("bucket").applyInArrow(_name, ANSWER_SCHEMA), "answers")
    opened = answers.filter(F.shiftright("code", 60) == OPEN)
    rows = opened.count()
    asked = opened.groupBy("doc_id").agg(F.collect_list("code").alias("codes"))
    stretches = docs.join(asked, "doc_id").mapInArrow(
        _stretches, "key bigint, doc_id bigint, place bigint, far int, near int, bytes binary"
    )
    parts = max(2 * tasks, ceil(rows / 100_000))
    masks = stretches.groupBy(F.pmod("key", F.lit(parts)).alias("part")).applyInArrow(_induce, ANSWER_SCHEMA)
    final = (
        answers.filter(F.shiftright("code", 60) != OPEN).unionAll(masks)
        .groupBy("doc_id").agg(F.collect_list(F.struct("code", "ref")).alias("a"))
        .select("doc_id", F.col("a.code").alias("codes"), F.col("a.ref").alias("refs"))
    )
    joined = docs.join(final, "doc_id", "left")
    carried = ["doc_id", *names.values()]
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", spans), ("kept", pa.binary())])
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    out = joined.mapInArrow(
        partial(_remove, schema=schema, carried=carried, whole=whole),
        f"{kinds}, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary",
    )
    return out.withColumnsRenamed({n: c for c, n in names.items()})
