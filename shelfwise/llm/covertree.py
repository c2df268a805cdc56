"""Embedding near-dedup: all pairs within a cosine threshold, by dual traversal of cover trees.

On unit vectors cos >= t means distance <= eps = sqrt(2 - 2t), so threshold pairs are a metric join. A cover tree
has nested levels with halving radii: every node covers its points within the level's radius. Two trees are traversed
together; a pair of nodes is dropped if the centres are further apart than eps plus both covering radii, counted
whole if even the farthest points are within eps, and split otherwise, down to leaves that are compared in double
precision. So exactly the pairs with cos >= t are found.

Across tasks, the top level is a set of centres from a bounded sample (``SAMPLE`` rows, at most ``CELLS`` centres).
Each vector lives in the cell of its nearest centre and visits those other cells that the plane between the two
centres does not rule out. A pair is compared in the smaller-numbered cell of the two. Cells are cut into blocks of
bounded size, and visitors too. Identical vectors are one representative with a count. A task returns
link counts and a spanning set of links per vector, not pairs, so dense groups stay linear in rows moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written
from .graph import components

SAMPLE = 4096
CELLS = 64
CELL_ROWS = 4096
BLOCK_ROWS = 4096
LEAF_ROWS = 64
BRANCHES = 64


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, rows: np.ndarray, radius: float, rng: np.random.Generator) -> Node:
    """Nested levels with halving radii. Where ``BRANCHES`` balls of the next radius cover less than half
    of a node's points the level cannot group them, and the node stays a leaf."""
    own = x[rows]
    centre = own[0]
    node = Node(centre, float(np.sqrt(((own - centre) ** 2).sum(1).max())), rows)
    radius = min(radius, node.radius) / 2
    if len(rows) <= LEAF_ROWS or node.radius == 0:
        return node
    left = rng.permutation(len(rows))
    parts = []
    while len(left) and len(parts) < BRANCHES:
        near = ((own[left] - own[left[0]]) ** 2).sum(1) <= radius * radius
        parts.append(left[near])
        left = left[~near]
    if 2 * len(left) > len(rows):
        return node
    node.children = [cover_tree(x, rows[p], radius, rng) for p in parts]
    if len(left):
        rest = rows[left]
        node.children.append(Node(x[rest[0]], float(np.sqrt(((x[rest] - x[rest[0]]) ** 2).sum(1).max())), rest))
    return node


class Linker:
    """Link counts and merged groups of the points of one task."""

    def __init__(self, x: np.ndarray, weights: np.ndarray, cosine: float):
        self.x, self.weights, self.cosine = x, weights, cosine
        self.eps = float(np.sqrt(2 - 2 * cosine))
        self.links = np.zeros(len(x), np.int64)
        self.group = np.arange(len(x))

    def root(self, rows: np.ndarray) -> np.ndarray:
        r = self.group[rows]
        while True:
            up = self.group[r]
            if (up == r).all():
                self.group[rows] = r
                return r
            r = up

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root(a), self.root(b)
            differ = ra != rb
            if not differ.any():
                return
            a, b = ra[differ], rb[differ]
            np.minimum.at(self.group, np.maximum(a, b), np.minimum(a, b))

    def whole(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        if same:
            self.links[a] += self.weights[a].sum() - self.weights[a]
        else:
            self.links[a] += self.weights[b].sum()
            self.links[b] += self.weights[a].sum()
        first = np.full(len(a) + len(b), min(a[0], b[0]))
        self.merge(np.concatenate([a, b]), first)

    def compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        for lo in range(0, len(a), 1024):
            part = a[lo:lo + 1024]
            i, j = np.nonzero(self.x[part] @ self.x[b].T >= self.cosine)
            i, j = part[i], b[j]
            if same:
                i, j = i[i < j], j[i < j]
            np.add.at(self.links, i, self.weights[j])
            np.add.at(self.links, j, self.weights[i])
            self.merge(i, j)

    def traverse(self, top_a: Node, top_b: Node) -> None:
        """All links between the points of two trees (of one tree if both are the same)."""
        todo = [(top_a, top_b)]
        while todo:
            a, b = todo.pop()
            same = a is b
            apart = 0.0 if same else float(np.sqrt(((a.centre - b.centre) ** 2).sum()))
            if apart - a.radius - b.radius > self.eps + 1e-9:
                continue
            if apart + a.radius + b.radius < self.eps - 1e-9:
                self.whole(a.rows, b.rows, same)
            elif not a.children and not b.children:
                self.compare(a.rows, b.rows, same)
            elif same:
                kids = a.children
                todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            elif b.children and (not a.children or b.radius >= a.radius):
                todo += [(a, child) for child in b.children]
            else:
                todo += [(child, b) for child in a.children]


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _centres(reps: DataFrame, dim: int) -> np.ndarray:
    """At most CELLS far-apart unit vectors of a sample of at most SAMPLE rows (by hash); more for larger tables."""
    n = reps.count()
    want = int(min(CELLS, max(1, -(-n // CELL_ROWS))))
    sample = reps.orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toArrow()
    if not n:
        return np.zeros((0, dim))
    x = _unit(sample.column("v").combine_chunks(), dim)
    chosen, away = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < want and away.max() > 1e-12:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def links_of(reps: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(id, links, other): link counts and spanning links of representatives (id, copies, v) of one length."""
    centres = _centres(reps, dim)
    eps = float(np.sqrt(2 - 2 * cosine))
    gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch.column("v"), dim)
            d2 = np.maximum(2 - 2 * x @ centres.T, 0)
            home = d2.argmin(1)
            beyond = d2 - d2[np.arange(len(x)), home][:, None]
            # Distance to the plane between the home centre and another one.
            plane = beyond / np.maximum(2 * gaps[home], 1e-12)
            visits = (plane <= eps + 1e-9) & (np.arange(len(centres)) < home[:, None])
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "copies": batch.column("copies"), "v": batch.column("v"),
                "home": home.astype(np.int32), "visits": pa.array([np.flatnonzero(r).astype(np.int32) for r in visits], pa.list_(pa.int32()))})

    placed = written(reps.select("id", "copies", "v").mapInArrow(
        place, "id long, copies long, v array<double>, home int, visits array<int>"), "placed")
    # One row per cell: its blocks, and the blocks of its visitors.
    homes = {r["home"]: r["n"] for r in placed.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    callers = {r["cell"]: r["n"] for r in placed.select(F.explode("visits").alias("cell")).groupBy("cell")
               .agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = range(len(centres))
    blocks = F.array(*[F.lit(-(-homes.get(c, 0) // BLOCK_ROWS) or 1) for c in cells])
    waves = F.array(*[F.lit(-(-callers.get(c, 0) // BLOCK_ROWS)) for c in cells])
    of = lambda a, c: F.element_at(a, c + 1)
    h = F.xxhash64("id")
    own = F.pmod(h, of(blocks, F.col("home"))).cast("int")
    # Groups (cell, block, caller): caller -1 is the block with itself, 0.. a wave of visitors, and -2 - j the cell's later block j.
    member = placed.withColumns({"cell": F.col("home"), "block": own}) \
        .withColumn("caller", F.explode(F.concat(
            F.array(F.lit(-1)),
            F.when(of(waves, F.col("cell")) > 0, F.sequence(F.lit(0), of(waves, F.col("cell")) - 1)).otherwise(F.array().cast("array<int>")),
            F.when(of(blocks, F.col("cell")) > F.col("block") + 1, F.transform(
                F.sequence(F.col("block") + 1, of(blocks, F.col("cell")) - 1), lambda j: -2 - j)).otherwise(F.array().cast("array<int>")))))
    later = placed.withColumns({"cell": F.col("home"), "caller": -2 - own, "mine": own}).filter("mine > 0") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("mine") - 1))).drop("mine")
    visitor = placed.withColumn("cell", F.explode("visits")) \
        .withColumn("caller", F.pmod(F.xxhash64("id", F.lit(1)), of(waves, F.col("cell"))).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), of(blocks, F.col("cell")) - 1)))
    columns = ["cell", "block", "caller", "id", "copies", "v"]
    work = member.select(*columns, F.lit(0).alias("side")) \
        .unionByName(later.select(*columns, F.lit(1).alias("side"))) \
        .unionByName(visitor.select(*columns, F.lit(1).alias("side")))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "id"], kind="stable")
        x = np.stack(group["v"].to_numpy())
        x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
        linker = Linker(x, group["copies"].to_numpy(), cosine)
        rng = np.random.Generator(np.random.PCG64(1))
        side = group["side"].to_numpy()
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if len(a):
            tree = cover_tree(x, a, 2.0, rng)
            if group["caller"].iloc[0] == -1:
                linker.traverse(tree, tree)
            elif len(b):
                linker.traverse(tree, cover_tree(x, b, 2.0, rng))
        hit = np.flatnonzero(linker.links)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"id": ids[hit], "links": linker.links[hit], "other": ids[linker.root(hit)]})

    return work.groupBy("cell", "block", "caller").applyInPandas(join, "id long, links long, other long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id reachable. Vectors that
    are null, empty, zero or hold null or non-finite components, and rows without id, link with nothing (a null id has a
    null component and is kept); vectors of different lengths never link; repeated rows link with each other
    as copies; an empty table gives no rows. Other columns are ignored.
    """
    x = F.col("embedding")
    usable = F.coalesce(F.col("vec_id").isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
                        & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), usable.alias("usable"),
                                  F.transform(x, lambda c: c.cast("double") + F.lit(0.0)).alias("v")), "vectors")
    reps = rows.filter("usable").groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    reps = written(reps.withColumn("dim", F.size("v")), "reps")
    found = None
    for r in reps.select("dim").distinct().orderBy("dim").collect():  # one per vector length, as a rule one
        part = links_of(reps.filter(F.col("dim") == r["dim"]), r["dim"], cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "found")
    comp = components(found.select("id", "other"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    of_rep = reps.join(counts, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left") \
        .select(F.col("v"), F.lit(True).alias("usable"), "id",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    return rows.join(of_rep, ["v", "usable"], "left") \
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
