"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import as_bytes, chunks, mix, seeds, staged
from marketloom.llm.components import components
from marketloom.llm.shingles import shingle_sets

WORDS, PERCENT = 5, 75
BANDS, ROWS = 48, 5  # a pair at similarity 0.75 shares no band with a chance of (1 - 0.75**5)**48 = 2.3e-6


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Fast similarity sketches (one row per set). In round i < size every element is hashed to a
    random place with a value in [i, i+1); in round size + j every element goes to place j. A place
    keeps its smallest value, and a set stops after the round that fills its last place, so every
    place of a non-empty set fills, after about size * ln(size) hashes or one round of a large set."""
    out = np.full((len(sets), size), np.iinfo(np.uint64).max, np.uint64)
    flat, empty = out.reshape(-1), np.iinfo(np.uint64).max
    rounds = seeds(2 * size, 31)
    active = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    owners, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(active):
        owners = np.repeat(active, [len(sets[i]) for i in active])
        values = np.concatenate([sets[i] for i in active])
    low = np.uint64((1 << 48) - 1)
    for i in range(2 * size):
        if not len(values):
            break
        hashed = mix(values ^ rounds[i])
        if i < size:
            place = (((hashed >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        else:
            place = i - size
        np.minimum.at(flat, owners * size + place, (hashed & low) | np.uint64(i << 48))
        open_rows = (out == empty).any(axis=1)
        keep = open_rows[owners]
        if not keep.all():
            owners, values = owners[keep], values[keep]
    return out


def _band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(seeds(bands, 41), (len(sketch), bands)).copy()
    for r in range(rows):
        key = mix(key ^ parts[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for lo, hi in chunks(texts):
                sets = shingle_sets(texts[lo:hi], words)
                keys = _band_keys(sketches(sets, bands * rows), bands, rows)
                filled = np.array([len(s) > 0 for s in sets])
                ends = np.concatenate(([0], np.cumsum(filled * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[filled].reshape(-1))),
                    ],
                    ["doc_id", "n_shingles", "print", "bands"],
                )


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, print, bands) of docs (doc_id, text); ``print`` identifies the set."""
    return docs.mapInArrow(
        partial(_sign, words=words, bands=bands, rows=rows),
        "doc_id bigint, n_shingles bigint, print binary, bands array<bigint>",
    )


def _compare(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b"))
        wanted = batch.column("extras").to_pylist()
        for lo, hi in chunks([x + y for x, y in zip(left, right)]):
            one, two = shingle_sets(left[lo:hi], words), shingle_sets(right[lo:hi], words)
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(one, two)]
            extra = [np.setdiff1d(y, x, assume_unique=True).view(np.int64) if w else [] for x, y, w in zip(one, two, wanted[lo:hi])]
            columns = [pa.array(c, pa.int64()) for c in ([len(x) for x in one], [len(y) for y in two], common)]
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), *columns, pa.array(extra, pa.list_(pa.int64()))],
                ["a", "b", "n_a", "n_b", "common", "extra"],
            )


def compared(pairs: DataFrame, docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(a, b, n_a, n_b, common, extra) for pairs (a, b, extras): sizes of the full shingle sets and of their
    intersection; where ``extras`` is set, b's shingles that a lacks."""
    text = docs.select("doc_id", "text")
    joined = pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        text.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return joined.select("a", "b", "extras", "text_a", "text_b").mapInArrow(
        partial(_compare, words=words), "a bigint, b bigint, n_a bigint, n_b bigint, common bigint, extra array<bigint>"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document id.

    Texts with equal shingle sets form one class from the start, whatever its size; its smallest id
    stands for it. In each band's bucket one member is the centre, the one with the most company in all its
    buckets, and the others are compared with it alone. Two members are compared with each other only if
    they could still be similar though one of them isn't similar to the centre c. With i shingles shared with c
    and n in all, similar x and y need

        min(i_x, i_y) + |(x & y) - c| >= percent / (100 + percent) * (n_x + n_y)

    so either they share shingles that c lacks, which an equi-join on those finds and counts, or
    min(i_x, i_y) alone reaches the right side, which takes a y smaller than c. Both are necessary conditions, so
    no pair that shares a band is lost, and a large group of near copies doesn't turn into all its pairs.

    Null and empty texts have an empty set and link with nothing. Rows without an id are left out;
    rows that repeat an id count as one document with the links of all of them. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.filter("doc_id is not null")
    signed = staged(signatures(docs, words, bands, rows), "signed")

    filled = signed.filter("n_shingles > 0")
    classes = filled.groupBy("print").agg(F.min("doc_id").alias("rep"))
    reps = signed.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    banded = reps.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = staged(banded.join(shared, "key").select("key", "doc_id", "n_shingles", "size"), "members")
    company = members.groupBy("doc_id").agg(F.sum("size").alias("company"))
    ranked = members.join(company, "doc_id")
    lead = F.struct(F.col("company"), (-F.col("doc_id")).alias("minus_id"))
    centres = ranked.groupBy("key").agg((-F.max(lead)["minus_id"]).alias("a"))
    stars = members.join(centres, "key").filter("doc_id <> a").groupBy("a", F.col("doc_id").alias("b")).agg(
        F.max(F.col("size") > 2).alias("extras")
    )
    star = staged(compared(stars, docs, words), "star").withColumn(
        "linked", F.expr(f"100 * common >= {percent} * (n_a + n_b - common)")
    )
    links = star.filter("linked").select("a", "b")
    found = components(links)

    # members that aren't similar to their centre, against the other members of the centre's buckets
    loose = staged(
        star.join(stars.filter("extras").select("a", "b"), ["a", "b"])
        .join(found.withColumnRenamed("node", "b"), "b", "left")
        .select(F.col("a").alias("c"), F.col("b").alias("x"), "n_a", F.col("n_b").alias("n"), "common", "linked", "extra",
                F.coalesce("component", "b").alias("component")),
        "loose",
    )
    apart = loose.filter("not linked").select("c").distinct()
    loose = loose.join(apart, "c", "left_semi")
    left = loose.filter("not linked")
    right = loose.select("c", F.col("x").alias("y"), F.col("n").alias("n_y"), F.col("common").alias("common_y"),
                         F.col("linked").alias("linked_y"), F.col("component").alias("component_y"))
    # shingles that the same members have count as one with a weight; those of one member alone, or
    # only of members similar to the centre, tell nothing
    token = loose.select("c", "x", "linked", F.explode("extra").alias("token"))
    held = token.groupBy("c", "token").agg(
        F.count("*").alias("holders"), F.bit_xor(F.xxhash64("x")).alias("s1"), F.bit_xor(F.xxhash64("x", F.lit(7))).alias("s2"),
        F.max(~F.col("linked")).alias("loose"),
    ).filter("holders > 1 and loose").drop("loose")
    weights = held.groupBy("c", "holders", "s1", "s2").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    # ``rest``: the weight of a member's shingles from this one on, the rarest first. The first shingle that two
    # members share has all they share behind it, so only there need the two be found
    onward = Window.partitionBy("c", "x").orderBy(F.desc("holders"), F.desc("token")).rowsBetween(Window.unboundedPreceding, 0)
    held_by = staged(
        token.join(weights.select("c", "token", "weight", "holders"), ["c", "token"])
        .withColumn("rest", F.sum("weight").over(onward)).select("c", "token", "weight", "rest", "x"),
        "held",
    )
    once = "component <> component_y and (linked_y or x < y)"
    least = f"{percent} * (n + n_y)"  # a hundred and percent times what the two must share
    # the most two members can share
    reach = f"{100 + percent} * (least(common, common_y) + least(rest, rest_y))"
    sizes_fit = f"100 * least(n, n_y) >= {percent} * greatest(n, n_y)"
    ahead = f"100 * (common + rest) >= {percent} * n"  # what it must share with a member of the smallest size that fits
    met = (
        held_by.drop("weight").join(left.select("c", "x", "n", "common", "component"), ["c", "x"]).filter(ahead)
        .join(
            held_by.drop("weight").withColumnsRenamed({"x": "y", "rest": "rest_y"}).join(right, ["c", "y"])
            .filter(f"100 * (common_y + rest_y) >= {percent} * n_y"),
            ["c", "token"],
        )
        .filter(f"{once} and {sizes_fit} and {reach} >= {least}")
        .select("c", "x", "y", "n", "n_y", "common", "common_y").distinct()
    )
    holdings = held_by.groupBy("c", "x").agg(F.collect_list(F.struct("token", "weight")).alias("own"))
    shared_weight = F.aggregate(F.array_intersect("own", "own_y"), F.lit(0).cast("bigint"), lambda total, t: total + t["weight"])
    by_extra = (
        met.join(holdings, ["c", "x"])
        .join(holdings.withColumnsRenamed({"x": "y", "own": "own_y"}), ["c", "y"])
        .withColumn("shared", shared_weight)
        .filter(f"{100 + percent} * (least(common, common_y) + shared) >= {least}")
    )
    smaller = right.filter(f"100 * common_y >= {percent} * n_y")
    by_size = (
        left.filter(f"100 * common >= {percent} * n").drop("extra")
        .join(smaller, "c")
        .filter(f"n_y < n_a and {once} and {sizes_fit} and {100 + percent} * least(common, common_y) >= {least}")
    )
    pairs = by_extra.select("x", "y").unionAll(by_size.select("x", "y")).select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(False).alias("extras")
    ).distinct()
    rest = staged(compared(staged(pairs, "pairs"), docs, words), "rest")
    links = links.unionAll(rest.filter(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b"))
    found = staged(components(links), "components")

    by_rep = classes.join(found.withColumnsRenamed({"node": "rep"}), "rep", "left").select(
        "print", F.coalesce("component", "rep").alias("component")
    )
    rows_out = signed.drop("bands").join(by_rep, "print", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    )
    return (
        rows_out.groupBy("doc_id")
        .agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
