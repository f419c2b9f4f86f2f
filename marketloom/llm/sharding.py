"""Shards of bounded size by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.llm.common import staged

LIMIT = 64 << 20  # bytes a shard may hold
BITS = 60  # of the hash


def key_hash(key: str | Column) -> Column:
    """60 hash bits of a key, the first 15 hexadecimal digits of its MD5."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")


def prefix(hash_col: str, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", F.col(hash_col), (F.lit(BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(depth, cell, n_bytes, n_rows): the buckets of a table (hash, n_bytes).

    A bucket is split on its next hash bit while it holds more than ``limit`` bytes. The sizes are summed
    once to cells fine enough for evenly spread keys; a bucket's depth is the first at which its prefix
    fits. Only cells that are still too large are summed again, eight bits finer each round, so the work
    that is repeated is what the oversized buckets hold. At 60 bits the rows of a bucket share their
    whole hash, and it stays whole.
    """
    total = sizes.agg(F.sum("n_bytes").alias("n")).first()["n"] or 0
    depth = min(BITS, max(0, ceil(log2(total / limit))) + 6 if total > limit else 0)
    low, out, open_rows = 0, None, sizes
    while True:
        cells = staged(
            open_rows.groupBy(prefix("hash", depth).alias("cell")).agg(
                F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")
            ),
            "cells",
        )
        levels = F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("depth")
        sums = cells.select(levels, "cell", "n_bytes", "n_rows").select(
            "depth", F.call_function("shiftright", "cell", (F.lit(depth) - F.col("depth")).cast("int")).alias("cell"), "n_bytes", "n_rows"
        ).groupBy("depth", "cell").agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows"))
        last = depth == BITS
        fits = F.col("n_bytes") <= limit
        # a bucket stands where it fits and its parent doesn't; at the root of a round there is no parent left to ask
        parents = sums.select(
            (F.col("depth") + 1).alias("depth"), F.col("cell").alias("above"), (F.col("n_bytes") > limit).alias("split")
        )
        asked = sums.withColumn("above", F.call_function("shiftright", "cell", F.lit(1))).join(parents, ["depth", "above"], "left")
        stands = asked.filter(F.coalesce("split", F.col("depth") == low) & (fits | (F.col("depth") == BITS)))
        stands = stands.select("depth", "cell", "n_bytes", "n_rows")
        out = stands if out is None else out.unionAll(stands)
        if last:
            break
        large = cells.filter(F.col("n_bytes") > limit).select("cell")
        if large.isEmpty():
            break
        open_rows = open_rows.join(large, prefix("hash", depth) == F.col("cell"), "left_semi")
        low, depth = depth + 1, min(BITS, depth + 8)
    return staged(out, "directory")


def assign(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``rows`` (hash, n_bytes, ..) with depth, cell and the bucket's n_rows and bytes. Columns added: depth,
    cell, shard_bytes, shard_rows.

    A row looks for its bucket at the directory's depths, which are few; the join is on (depth, cell).
    A bucket of rows that share their whole hash stays whole, also above ``limit``.
    """
    buckets = directory(rows.select("hash", "n_bytes"), limit)
    depths = sorted(r["depth"] for r in buckets.select("depth").distinct().collect())  # at most 61
    tried = rows.withColumn("depth", F.explode(F.array([F.lit(d) for d in depths] or [F.lit(0)])))
    return tried.withColumn("cell", prefix("hash", F.col("depth"))).join(
        buckets.withColumnsRenamed({"n_bytes": "shard_bytes", "n_rows": "shard_rows"}), ["depth", "cell"]
    )


def shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(doc_id, n_bytes, depth, shard, shard_bytes, shard_rows) for every row; ``shard`` names the bucket by
    its hash bits ("" when all rows fit one).

    The key is the document's id, so a hot source or many copies of a text spread like other rows. Null texts
    have no bytes. Null ids hash as the empty text. Rows that repeat an id stay together; when more than
    ``limit`` bytes share one id their bucket exceeds the limit, as does the bucket of a single longer text.
    Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint").alias("n_bytes"),
    ).withColumn("hash", key_hash("doc_id"))
    bits = F.when(F.col("depth") == 0, "").otherwise(
        F.lpad(F.conv(F.col("cell").cast("string"), 10, 2), F.col("depth").cast("int"), F.lit("0"))
    )
    return assign(rows, limit).select(
        "doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), bits.alias("shard"), "shard_bytes", "shard_rows"
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` under ``path`` with one folder per shard."""
    plan = shards(docs, id_col, text_col, limit).select(F.col("doc_id").alias("__id"), "shard").distinct()
    placed = docs.join(plan, docs[id_col].cast("bigint").eqNullSafe(plan["__id"])).drop("__id")
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
