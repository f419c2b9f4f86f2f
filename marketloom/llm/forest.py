"""Near-duplicate vectors: a forest of random-projection trees with spill, verification, components."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketloom.llm.common import mix, staged
from marketloom.llm.components import components

TREES, LEAF = 12, 256
SAMPLE = 20_000  # most vectors of a cell its tree is fitted on
LEAST_SAMPLE = 2048  # and the fewest, where the cell has them
ROUNDS = 16  # rounds of splits; a cell still large after them is compared whole, like one that can't be split
MEMBERS = 8192  # about so many members of a cell are moved to their leaves at a time
SPILL = 0.5  # half-width of what goes both ways at a split, in standard deviations of a barely linked pair's difference
SAVING = 0.85  # a split is made if its two sides need at most this share of the node's comparisons
CUTS = np.arange(0.05, 0.951, 0.025)  # quantiles tried as thresholds
DEPTH = 60  # node numbers are bigints
COSINE = 0.95
PART = 2048  # vectors of a leaf compared with so many at a time


@dataclass
class Tree:
    """Splits by node number (children 2n and 2n + 1 of node n): the threshold; ``spill`` on either side of it
    goes both ways. Directions come from the tree's seed and the node's number."""

    seed: int
    size: int
    spill: float
    cuts: dict[int, float]

    def direction(self, node: int) -> np.ndarray:
        d = np.random.default_rng((self.seed, node)).standard_normal(self.size)
        return d / np.linalg.norm(d)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf each unit vector falls into."""
        out_rows, out_leaves = [], []
        todo = [(1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node not in self.cuts:
                out_rows.append(rows)
                out_leaves.append(np.full(len(rows), node, np.int64))
                continue
            cut = self.cuts[node]
            p = x[rows] @ self.direction(node)
            todo += [(2 * node, rows[p <= cut + self.spill]), (2 * node + 1, rows[p > cut - self.spill])]
        return np.concatenate(out_rows or [np.zeros(0, np.int64)]), np.concatenate(out_leaves or [np.zeros(0, np.int64)])


def spill(size: int, cosine: float) -> float:
    return SPILL * sqrt(max(0.0, 2 - 2 * cosine) / size)


def fit_tree(sample: np.ndarray, seed: int, leaf: float, cosine: float) -> Tree:
    """Recursive random splits of the sample, each where its two sides, spill included, need the fewest comparisons:
    beside a dense group and not through it. A node with at most ``leaf`` of the sample is a leaf, and so is one
    that no threshold divides with enough saved, which holds for a group as narrow as the linked pairs themselves."""
    size = sample.shape[1]
    tree = Tree(seed, size, spill(size, cosine), {})
    todo = [(1, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop()
        if node >> DEPTH or len(rows) < 16 or len(rows) <= leaf:
            continue
        p = sample[rows] @ tree.direction(node)
        ordered = np.sort(p)
        cuts = np.quantile(ordered, CUTS)
        left = np.searchsorted(ordered, cuts + tree.spill, side="right")
        right = len(rows) - np.searchsorted(ordered, cuts - tree.spill, side="right")
        cost = left.astype(float) ** 2 + right.astype(float) ** 2
        best = int(cost.argmin())
        if cost[best] > SAVING * len(rows) ** 2:
            continue
        cut = tree.cuts[node] = float(cuts[best])
        todo += [(2 * node, rows[p <= cut]), (2 * node + 1, rows[p > cut])]
    return tree


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _seed(cell: int) -> int:
    return cell & (2**63 - 1)


def _fit(group: pa.Table, leaf: int, cosine: float) -> pa.Table:
    """The splits of one cell's tree, from the cell's sample; no row where it can't be split."""
    group = group.sort_by("id")
    size, cell, n = (group[c][0].as_py() for c in ("size", "cell", "n"))
    tree = fit_tree(_unit(_matrix(group["v"])), _seed(cell), leaf * len(group) / n, cosine)
    rows = [(size, cell, list(tree.cuts), list(tree.cuts.values()))] if tree.cuts else []
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
    return pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(zip(("size", "cell", "nodes", "cuts"), kinds))})


def _move(members: pa.Table, splits: pa.Table, cosine: float) -> pa.Table:
    """Some members of one cell, each in every leaf of the cell's tree it falls into. Leaves are cells of the next
    round (``open``); a cell without splits keeps its members for good."""
    ids = members["id"].to_numpy()
    if not len(splits) or not len(ids):
        cells, rows = members["cell"].to_numpy(), np.arange(len(ids))
        size = members["size"].to_numpy()
    else:
        width, cell = members["size"][0].as_py(), members["cell"][0].as_py()
        cuts = dict(zip(splits["nodes"][0].as_py(), splits["cuts"][0].as_py()))
        rows, leaves = Tree(_seed(cell), width, spill(width, cosine), cuts).leaves(_unit(_matrix(members["v"])))
        with np.errstate(over="ignore"):
            cells = mix(np.int64(cell).astype(np.uint64) + leaves.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        size = np.full(len(rows), width)
    return pa.table({
        "size": pa.array(size, pa.int32()), "cell": pa.array(cells, pa.int64()), "id": pa.array(ids[rows], pa.int64()),
        "open": pa.array(np.full(len(rows), len(splits) > 0)),
    })


def plant(points: DataFrame, cosine: float, trees: int, leaf: int, sample_rows: int) -> DataFrame:
    """(size, cell, id): the leaves of every tree that each vector falls into.

    Trees grow in rounds. A cell (at first all vectors of one size, once per tree) with more than ``leaf`` members, or four times
    that from the second round on, is split by a tree fitted on a sample of its own members: a quarter of them, within
    LEAST_SAMPLE and ``sample_rows``. So leaves stay small however many vectors there are. A cell whose
    sample no threshold divides stays whole. Splits are fitted and applied in tasks; nothing comes to the driver.
    """
    key = ["size", "cell"]
    vectors = points.select("id", "v")
    tree = F.explode(F.sequence(F.lit(1), F.lit(trees)))
    rows = points.select(F.size("v").alias("size"), tree.alias("tree"), "id")
    rows = staged(rows.select("size", F.xxhash64("size", "tree").alias("cell"), "id"), "open")
    settled = []
    for turn in range(ROUNDS):
        over = rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > (4 * leaf if turn else leaf))
        over = staged(over, "over")
        if over.isEmpty():
            break
        named = rows.join(over, key)
        want = F.least(F.lit(sample_rows), F.greatest(F.lit(LEAST_SAMPLE), F.col("n") / 4)) / F.col("n")
        drawn = named.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < want * (1 << 30))
        cuts = drawn.join(vectors, "id").groupBy(*key).applyInArrow(
            lambda group: _fit(group, leaf, cosine), "size int, cell bigint, nodes array<bigint>, cuts array<double>"
        )
        cuts = staged(cuts, "cuts")
        parts = F.ceil(F.col("n") / MEMBERS).cast("int")
        members = named.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).join(vectors, "id")
        splits = cuts.join(over, key).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        moved = (
            members.select(*key, "part", "id", "v").groupBy(*key, "part")
            .cogroup(splits.select(*key, "part", "nodes", "cuts").groupBy(*key, "part"))
            .applyInArrow(lambda one, two: _move(one, two, cosine), "size int, cell bigint, id bigint, open boolean")
        )
        moved = staged(moved, "moved")
        settled += [rows.join(over, key, "left_anti").select(*key, "id"), moved.filter("not open").select(*key, "id")]
        rows = moved.filter("open").select(*key, "id")
    return staged(reduce(DataFrame.unionAll, settled, rows.select(*key, "id")), "cells")


def _met_before(codes: np.ndarray, i: np.ndarray, j: np.ndarray, here: int) -> np.ndarray:
    """Whether rows i and j share a cell before ``here``; ``codes`` are the rows' cells in order."""
    met = np.zeros(len(i), bool)
    for c in range(codes.shape[1]):
        todo = np.flatnonzero(~met & (codes[i, c] < here))
        if not len(todo):
            break
        met[todo] = (codes[j[todo]] == codes[i[todo], c][:, None]).any(axis=1)
    return met


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first row that each of n rows is connected with by the links i-j."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(group: pa.Table, cosine: float) -> pa.Table:
    """(id, root, linked) from the links inside one part of a cell, or across two: a row that each linked one
    is connected with here, and how many vectors it links with. A pair that shares an earlier cell is left to that cell."""
    group = group.sort_by("id")
    ids, copies, side = (group[c].to_numpy() for c in ("id", "copies", "side"))
    lists = group["cells"].combine_chunks()
    known, flat = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    here = int(np.searchsorted(known, group["cell"][0].as_py()))
    lengths = np.diff(lists.offsets.to_numpy())
    codes = np.full((len(ids), lengths.max()), len(known), np.int32)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = flat
    a, b = [], []
    if not (np.bincount(flat, minlength=len(known))[:here] == len(ids)).any():  # else all pairs met before
        x = _unit(_matrix(group["v"]))
        one, two = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(ids)),) * 2
        for lo in range(0, len(one), 128):
            i, j = np.nonzero(x[one[lo : lo + 128]] @ x[two].T >= cosine)
            i, j = one[lo + i], two[j]
            if not side.any():
                i, j = i[(keep := i < j)], j[keep]
            new = ~_met_before(codes, i, j, here)
            a.append(i[new].astype(np.int32))
            b.append(j[new].astype(np.int32))
    i, j = (np.concatenate(c or [np.zeros(0, np.int32)]) for c in (a, b))
    linked = sum(np.bincount(u, weights=copies[w], minlength=len(ids)) for u, w in ((i, j), (j, i))).astype(np.int64)
    rows = np.flatnonzero(linked)
    columns = ids[rows], ids[_stars(len(ids), i, j)[rows]], linked[rows]
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("id", "root", "linked"), columns)})


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, sample_rows: int = SAMPLE,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every vector id.

    Equal vectors are one class from the start, whatever its size. Every class falls into leaves of each tree (see
    ``plant``). What goes both ways at a split depends on the link distance alone, and a group too narrow to be
    split stays one leaf. A leaf with more than ``PART`` members is compared part by part, each pair of parts a group of its
    own, so no task holds a whole large leaf, and nothing is left out. Every pair is counted in the first leaf it
    shares, so that groups leave a row per linked vector and not one per link. All links are verified in double
    precision; pairs that never share a leaf are missed (see README for the measured recall).

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing; vectors of
    different sizes don't either. Rows without an id are left out; rows that repeat an id are one vector
    (the largest). Other columns are ignored.
    """
    x = F.transform(vector_col, lambda v: v.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    sound = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("v", lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), x.alias("v")).filter("id is not null")
    rows = rows.groupBy("id").agg(F.max("v").alias("v"))
    rows = staged(rows.withColumn("v", F.when(F.col("v").isNotNull() & sound, F.col("v"))), "vectors")
    classes = staged(
        rows.filter("v is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    points = classes.select("id", "v", "copies")
    cells = plant(points, cosine, trees, leaf, sample_rows)
    own = cells.groupBy("id").agg(F.array_sort(F.collect_set("cell")).alias("cells"))
    full = points.join(own, "id")
    sizes = cells.groupBy("size", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / PART).cast("int")
    dealt = cells.join(sizes.withColumn("parts", parts).drop("n"), ["size", "cell"]).join(full, "id")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("other", other).select(
        "size", "cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "v", "copies", "cells",
    )

    def compare(group: pa.Table) -> pa.Table:
        return _compare(group, cosine)

    links = dealt.groupBy("size", "cell", "one", "two").applyInArrow(compare, "id bigint, root bigint, linked bigint")
    links = staged(links, "links")
    degree = links.groupBy("id").agg(F.sum("linked").alias("linked"))
    found = components(links, "id", "root")
    known_classes = (
        classes.join(degree, "id", "left")
        .join(found.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "v", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component")
        )
    )
    joined = rows.join(known_classes, "v", "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
