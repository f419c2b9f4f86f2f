"""Exact top-k inner products by MaxScore over blocks of vectors."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.llm.common import staged

BLOCK = 2048  # vectors in a block
STEP = 8  # terms looked up between two prunings
FIRST = 512  # vectors of a block scored in full for a first floor
HELD = 256  # blocks of queries whose floors a task keeps
BLOCK_SCHEMA = "size int, ids binary, vectors binary"


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Vectors of one size, as (n x size) int64, ``rows`` at most to a block."""
    held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

    def block(size: int) -> pa.RecordBatch:
        ids, vectors = held.pop(size)
        parts = [np.array(ids, np.int64).tobytes(), np.stack(vectors).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([size], pa.int32()), pa.array(parts[:1], pa.binary()), pa.array(parts[1:], pa.binary())], ["size", "ids", "vectors"]
        )

    for batch in batches:
        ids, lists = batch.column(0).to_pylist(), batch.column(1)
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i, s, e in zip(ids, ends[:-1], ends[1:]):
            own = held.setdefault(e - s, ([], []))
            own[0].append(i)
            own[1].append(flat[s:e])
            if len(own[0]) == rows:
                yield block(e - s)
    for size in list(held):
        yield block(size)


def max_score(
    query: np.ndarray, postings: np.ndarray, high: np.ndarray, low: np.ndarray, k: int, floor: float
) -> tuple[np.ndarray, np.ndarray]:
    """Columns of ``postings`` (terms x vectors) that can be among the k best of ``query`` above or at
    ``floor``, with their exact scores.

    A term adds at least min(q * high, q * low) and at most max(q * high, q * low). Terms are taken by the width between. A vector
    with the least of the essential terms can't reach the floor whatever the others add: essential terms are traversed
    for all vectors, the others are looked up, STEP at a time, only for vectors that can still reach it. After the
    essential ones the k best so far are scored in full, which raises the floor.
    """
    most, least = np.maximum(query * high, query * low), np.minimum(query * high, query * low)
    order = np.argsort(least - most, kind="stable")
    rest = np.concatenate((np.cumsum(most[order][::-1])[::-1], [0]))
    reach = np.concatenate(([0], np.cumsum(least[order]))) + rest
    at = min(int(np.searchsorted(-reach, -floor, side="right")), len(order))
    if at == 0:  # no vector of the block reaches the floor
        return np.zeros(0, np.int64), np.zeros(0)
    alive = np.arange(postings.shape[1])
    score = query[order[:at]] @ postings[order[:at]] if at < len(order) else query @ postings
    if at < len(order) and len(alive) > k:
        best = np.argpartition(-score, k - 1)[:k]
        floor = max(floor, np.min(query @ postings[:, best]))
    while True:
        keep = score + rest[at] >= floor
        if not keep.all():
            alive, score = alive[keep], score[keep]
        if at >= len(order) or not len(alive):
            return alive, score
        terms = order[at : at + STEP]
        score = score + query[terms] @ postings[np.ix_(terms, alive)]
        at += len(terms)


class Floors:
    """The k best scores found so far for the queries of the blocks seen last; a block let go only costs work."""

    def __init__(self, k: int) -> None:
        self.k, self.best = k, OrderedDict()

    def of(self, queries: bytes, n: int) -> np.ndarray:
        best = self.best.pop(queries, None)
        if best is None:
            best = np.full((n, self.k), -np.inf)
        self.best[queries] = best
        if len(self.best) > HELD:
            self.best.popitem(last=False)
        return best


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    floors = Floors(k)
    for batch in batches:
        for row in batch.to_pylist():
            size = row["size"]
            ids, queries = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["query_ids"], np.int64)
            vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), size)
            asked = np.frombuffer(row["queries"], np.int64).reshape(len(queries), size)
            # float products are exact, and fast, while every sum stays below 2**53
            peak = float(np.abs(vectors).max(initial=0)) * float(np.abs(asked).max(initial=0)) * max(size, 1)
            exact = peak < 2**53
            kind = np.float64 if exact else np.int64
            by_id = np.argsort(ids, kind="stable")
            ids, postings = ids[by_id], np.ascontiguousarray(vectors[by_id].T.astype(kind))
            high, low = postings.max(axis=1), postings.min(axis=1)
            asked = asked.astype(kind)
            best_scores = floors.of(row["query_ids"], len(queries))
            start = best_scores.min(axis=1)
            if exact and len(ids) > k and np.isneginf(start).any():
                # a first floor from some vectors; the query's own row may be one of them
                first = asked @ postings[:, :FIRST]
                if first.shape[1] > k:
                    start = np.maximum(start, -np.partition(-first, k, axis=1)[:, k])
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for at, (q, query) in enumerate(zip(queries, asked)):
                if exact:  # the query's own row may take a place
                    alive, score = max_score(query, postings, high, low, k + 1, start[at])
                else:  # bounds of such sums may wrap
                    alive, score = np.arange(len(ids)), query @ postings
                other = ids[alive] != q
                alive, score = alive[other], score[other]
                best = np.lexsort((ids[alive], -score))[:k]
                out.append((np.full(len(best), q), ids[alive[best]], score[best].astype(np.int64)))
                if exact and len(best):
                    best_scores[at] = np.sort(np.concatenate((best_scores[at], score[best])))[-k:]
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): per query row the k other rows with the largest inner product of
    the vectors floor(scale * x); ties go to the smaller id.

    Blocks of queries meet every block of vectors once, so the work is queries times vectors, and no task holds
    more than the blocks it is reading; each pair of blocks leaves at most k rows per query. A query's k-th best score so
    far goes from block to block of a task as its floor. Vectors that are
    null or empty or hold null or non-finite components, and rows without an id, take no part; vectors
    of different sizes aren't compared. Rows that repeat an id are one vector (the largest). Scores beyond
    64 bits wrap. Other columns are ignored.
    """
    x = F.transform(vector_col, lambda v: v.cast("double"))
    sound = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), x.alias("v"), is_query.alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("v") > 0) & sound).select(
        "id", F.transform("v", lambda v: F.floor(v * scale)).alias("v"), "asked"
    ).groupBy("id").agg(F.max("v").alias("v"), F.max("asked").alias("asked"))
    rows = staged(rows, "vectors")
    make = partial(_blocks, rows=BLOCK)
    slots = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = staged(rows.select("id", "v").mapInArrow(make, BLOCK_SCHEMA), "blocks").withColumn(
        "slot", (F.xxhash64("ids") % slots + slots) % slots
    )
    asked = rows.filter("asked").select("id", "v").mapInArrow(make, BLOCK_SCHEMA)
    asked = asked.withColumnsRenamed({"ids": "query_ids", "vectors": "queries"}).withColumn(
        "slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint")))
    )
    found = blocks.join(asked, ["slot", "size"]).select("size", "ids", "vectors", "query_ids", "queries").mapInArrow(
        partial(_search, k=k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
