"""Importance resampling towards a target distribution: hashed n-gram gains, perturbed scores, exact top share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import as_bytes, chunks, staged

BUCKETS, NGRAM, SEED = 10_000, 3, 42
MIN_WORDS, PERCENT = 20, 5
SLICE = 1 << 20  # bytes of text whose features are in memory at a time
KEYS = 1 << 16  # keys in one sorted block
REST = 4096  # so few keys left are ordered at once

WORD = np.zeros(256, bool)  # bytes of lower-cased words: 0-9, a-z and everything beyond ASCII
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


TABLE = _crc_table()


class Shifts:
    """crc(a + b) = shift(crc(a), len(b)) ^ crc(b); a shift is linear, so it is four look-ups by byte."""

    TALL = 64  # lengths with tables of their own; longer ones are shifted repeatedly

    def __init__(self) -> None:
        step = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
        tables = [step]
        for _ in range(self.TALL):
            step = TABLE[step & 0xFF] ^ (step >> np.uint32(8))
            tables.append(step)
        self.tables = np.array(tables).reshape(-1)

    def __call__(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        crc, length = crc.copy(), length.astype(np.int64)
        while len(crc):
            base = np.minimum(length, self.TALL) * 1024
            crc = (
                self.tables[base + (crc & 0xFF)] ^ self.tables[base + 256 + (crc >> 8 & 0xFF)]
                ^ self.tables[base + 512 + (crc >> 16 & 0xFF)] ^ self.tables[base + 768 + (crc >> 24)]
            )
            length = length - self.TALL
            if (length <= 0).all():
                break
            length = np.maximum(length, 0)
        return crc


SHIFT = Shifts()


def _crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of data[start : start + size] for each pair, one byte of all of them at a time."""
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-size, kind="stable")
    active = np.searchsorted(-size[order], -np.arange(1, int(size.max(initial=0)) + 1), side="right")
    for j, n in enumerate(active.tolist()):
        rows = order[:n]
        crc[rows] = TABLE[(crc[rows] ^ data[start[rows] + j]) & 0xFF] ^ (crc[rows] >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def _pieces(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A long text in slices that end between words, each led by the last words of the one before, and how many
    words lead it. So a feature is counted where its last word is."""
    if len(text) <= SLICE:
        yield text, 0
        return
    at, tail = 0, []
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text) and WORD[text[end]]:
            end += 1
        piece = b" ".join([*tail, text[at:end]])
        yield piece, len(tail)
        tail = _last_words(piece)
        at = end


def _last_words(piece: bytes) -> list[bytes]:
    """The last NGRAM - 1 words."""
    out: list[bytes] = []
    end = len(piece)
    while end and len(out) < NGRAM - 1:
        while end and not WORD[piece[end - 1]]:
            end -= 1
        start = end
        while start and WORD[piece[start - 1]]:
            start -= 1
        if end > start:
            out.append(piece[start:end])
        end = start
    return out[::-1]


def features(pieces: list[tuple[bytes, int]], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece of each feature, its bucket, words of each piece) of lower-cased pieces (text, leading words)."""
    joined = b"\n".join(p for p, _ in pieces)
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([0] + [len(p) + 1 for p, _ in pieces])
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = WORD[data]
    edge = np.diff(solid)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(start, bounds)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(pieces)), counts)
    place = np.arange(len(start)) - np.repeat(first[:-1], counts)  # a word's number in its piece
    lead = np.repeat(np.array([n for _, n in pieces], np.int64), counts)
    size = end - start
    one = _crcs(data, start, size)
    spaced = SHIFT(np.full(len(size), 0xE96CCF45, np.uint32), size) ^ one  # of " " + word
    crc, owners, out = one, [], []
    for n in range(NGRAM):
        if n:  # one word more at the end
            crc = SHIFT(crc[:-1], size[n:] + 1) ^ spaced[n:]
        own = (place[n:] >= n) & (place[n:] >= lead[n:])
        owners.append(owner[n:][own])
        out.append(crc[own] % np.uint32(buckets))
    words = counts - np.array([n for _, n in pieces], np.int64)
    return np.concatenate(owners), np.concatenate(out).astype(np.int64), words


def _blocks(texts: list[bytes]) -> Iterator[tuple[list[int], list[tuple[bytes, int]]]]:
    """Lower-cased texts together up to SLICE bytes; a longer one slice by slice."""
    for lo, hi in chunks(texts, SLICE):
        if hi - lo > 1 or len(texts[lo]) <= SLICE:
            yield list(range(lo, hi)), [(t.lower(), 0) for t in texts[lo:hi]]
        else:
            for piece in _pieces(texts[lo].lower()):
                yield [lo], [piece]


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        for _, pieces in _blocks(as_bytes(batch.column(0))):
            total += np.bincount(features(pieces, buckets)[1], minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row per bucket, the driver gets one."""
    rows = texts.selectExpr(f"cast(`{text_col}` as string) as text").mapInArrow(
        partial(_count, buckets=buckets), "bucket bigint, n bigint"
    )
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of the target's to the source's share) per bucket."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratios = [
        float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n)) for s, t in zip(source.tolist(), target.tolist())
    ]
    return np.floor([1000 * log(r) for r in ratios]).astype(np.int64)


def luck(doc_id: int | str | None, seed: int = SEED) -> int:
    """The id's standard Gumbel value in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return int(np.floor(-1000 * log(-log((h + 0.5) / 4294967296))))


SCORED = "doc_id bigint, n_features bigint, weight bigint, score bigint, n_words bigint"


def _score(batches: Iterator[pa.RecordBatch], gains: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(1))
        n, weight, words = (np.zeros(len(texts), np.int64) for _ in range(3))
        for rows, pieces in _blocks(texts):
            owner, bucket, count = features(pieces, len(gains))
            at = np.array(rows)
            n[at] += np.bincount(owner, minlength=len(rows))
            # sums of whole numbers below 2**53 are exact
            weight[at] += np.bincount(owner, weights=gains[bucket], minlength=len(rows)).astype(np.int64)
            words[at] += count
        ids = batch.column(0).to_pylist()
        score = weight + np.array([luck(i, seed) for i in ids], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n, weight, score, words))], [c.split()[0] for c in SCORED.split(", ")])


@dataclass(frozen=True)
class Key:
    """Ranks in ascending order: the negated score, then the id."""

    low: int
    id: int

    def place(self, low: np.ndarray, ids: np.ndarray, side: str) -> int:
        """Where the key belongs in a sorted block."""
        a, b = np.searchsorted(low, self.low, "left"), np.searchsorted(low, self.low, "right")
        return int(a + np.searchsorted(ids[a:b], self.id, side))


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def block() -> pa.RecordBatch:
        low, ids = (np.concatenate(c) for c in zip(*held))
        held.clear()
        order = np.lexsort((ids, low))
        return pa.RecordBatch.from_arrays(
            [pa.array([low[order].tobytes()], pa.binary()), pa.array([ids[order].tobytes()], pa.binary())], ["low", "ids"]
        )

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(x) for x, _ in held) >= KEYS:
            yield block()
    if held and sum(len(x) for x, _ in held):
        yield block()


def weighted_median(rows: list[tuple[int, int, int]]) -> Key:
    """The key of rows (low, id, weight) below and above which at most half of the weight lies."""
    rows = sorted(rows)
    half, seen = sum(w for _, _, w in rows) / 2, 0
    for low, key, weight in rows:
        seen += weight
        if seen >= half:
            return Key(low, key)
    raise ValueError("no rows")


ROUND = "n bigint, below bigint, upto bigint, low0 bigint, id0 bigint, low1 bigint, id1 bigint"


def _round(batches: Iterator[pa.RecordBatch], after: Key | None, before: Key | None, pivot: Key | None) -> Iterator[pa.RecordBatch]:
    """One task's part of a round over its keys strictly between ``after`` and ``before``: how many there are, how many lie
    below the pivot and up to it, and on either side of it the median of the block medians weighted by what is left in the blocks."""
    n = below = upto = 0
    sides: tuple[list, list] = ([], [])
    for batch in batches:
        for low, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, ids = np.frombuffer(low, np.int64), np.frombuffer(ids, np.int64)
            lo = after.place(low, ids, "right") if after else 0
            hi = before.place(low, ids, "left") if before else len(low)
            a, b = (max(lo, min(hi, pivot.place(low, ids, s))) for s in ("left", "right")) if pivot else (lo, lo)
            n, below, upto = n + max(0, hi - lo), below + a - lo, upto + b - lo
            for side, s, e in ((sides[0], lo, a), (sides[1], b, hi)):
                if e > s:
                    m = (s + e - 1) // 2
                    side.append((int(low[m]), int(ids[m]), e - s))
    medians = [weighted_median(s) if s else None for s in sides]
    cells = [n, below, upto, *(x for m in medians for x in ((m.low, m.id) if m else (None, None)))]
    yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()) for c in cells], [c.split()[0] for c in ROUND.split(", ")])


def cutoff(keys: DataFrame, k: int, rest: int = REST) -> Key | None:
    """The ``k``-th smallest of keys(low, id), exactly, or None if there are fewer.

    Keys are written once as sorted blocks. Each round takes the median of the tasks' medians, weighted by what
    is left in them, as pivot: at least an eighth of the keys lie on either side of it, and the side without the k-th is dropped. A
    task sends one row a round. Once three quarters are gone the rest is written anew, so all rounds
    together read a small multiple of the keys. The last ``rest`` keys are ordered at once.
    """
    blocks = staged(keys.select("low", "id").mapInArrow(_sorted_blocks, "low binary, ids binary"), "keys")
    after = before = pivot = None
    written = left = None
    while True:
        rows = blocks.mapInArrow(partial(_round, after=after, before=before, pivot=pivot), ROUND).filter("n > 0").collect()
        total = sum(r["n"] for r in rows)
        if pivot is None:
            if k < 1 or total < k:
                return None
            written = total
            side = 1
        else:
            below, upto = sum(r["below"] for r in rows), sum(r["upto"] for r in rows)
            if below < k <= upto:
                return pivot
            side = 0 if k <= below else 1
            if side:
                k, after = k - upto, pivot
            else:
                before = pivot
        weigh = "below" if side == 0 else None
        medians = [
            (r[f"low{side}"], r[f"id{side}"], r["below"] if weigh else r["n"] - r["upto"]) for r in rows if r[f"low{side}"] is not None
        ]
        left = sum(w for *_, w in medians)
        pivot = weighted_median(medians)
        if left <= rest:
            some = blocks.mapInArrow(partial(_between, after=after, before=before), "low bigint, id bigint")
            row = some.orderBy("low", "id").offset(k - 1).limit(1).collect()[0]
            return Key(row["low"], row["id"])
        if left <= written / 4:
            kept = blocks.mapInArrow(partial(_between, after=after, before=before), "low bigint, id bigint")
            blocks = staged(kept.mapInArrow(_sorted_blocks, "low binary, ids binary"), "keys")
            written = left


def _between(batches: Iterator[pa.RecordBatch], after: Key | None, before: Key | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            low, ids = np.frombuffer(low, np.int64), np.frombuffer(ids, np.int64)
            lo = after.place(low, ids, "right") if after else 0
            hi = before.place(low, ids, "left") if before else len(low)
            if hi > lo:
                yield pa.RecordBatch.from_arrays([pa.array(low[lo:hi]), pa.array(ids[lo:hi])], ["low", "id"])


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``rows`` numbered from 1 in ``order``: sorted by ranges, each range numbered by itself and moved by the rows before it."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = staged(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.orderBy("part")) - F.col("size"))  # one row per range
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    out = ranges.withColumn("own", number).join(F.broadcast(before.select("part", "before")), "part")
    return out.withColumn(name, (F.col("before") + F.col("own")).cast("bigint")).drop("part", "own", "before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row: the ``percent`` best of the rows with ``min_words`` words are
    drawn and ranked by score, ties to the smaller id; other ranks are null.

    Features are runs of one to three words, hashed into buckets; all texts of both tables are counted, and a document's weight is
    looked up in one array of ``BUCKETS`` gains. Adding each id's Gumbel noise makes the highest scores a sample without
    replacement in proportion to the weights. Null and empty texts have no features and weight 0. Long texts are worked on in slices of
    a megabyte. Rows that repeat an id are documents of their own (the same luck; full ties in any order). Rows without an id are
    counted and weighted, and are never drawn. An empty target or source is all smoothing. Other columns are ignored.
    """
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    gains = bucket_gains(bucket_counts(rows), bucket_counts(target, target_text))
    scored = staged(rows.mapInArrow(partial(_score, gains=gains, seed=seed), SCORED), "scored")
    able = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    n = scored.filter(able).count()
    wanted = percent * n // 100
    last = cutoff(scored.filter(able).select((-F.col("score")).alias("low"), F.col("doc_id").alias("id")), wanted)
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if last is None:
        return scored.select(*out, none)
    drawn = able & ((F.col("score") > -last.low) | ((F.col("score") == -last.low) & (F.col("doc_id") <= last.id)))
    best = ranked(scored.filter(drawn).select(*out), [F.desc("score"), F.asc("doc_id"), F.asc("n_features")])
    best = best.select(*out, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return best.unionAll(scored.filter(~F.coalesce(drawn, F.lit(False))).select(*out, none))
