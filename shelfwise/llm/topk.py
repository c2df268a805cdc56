"""Exact top-k search by inner product: a ball tree per shard, branch and bound.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows, each indexed by a ball tree. For a query q a ball with centre c
and radius r holds no score above q.c + |q| r; nodes are visited in falling order of that bound, and the search
of a shard ends when the best bound left is below the query's current kth score.

Queries (a stated set) meet all shards; those of a shard are read in its task block by block of about ``QUERY_ROWS``, so
that they are never held together. They first search one shard, which gives every
query a kth score to start from; that score travels with the query to all other shards, whose searches therefore
prune from the beginning. Only the best k rows per query and shard are moved.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import written

SHARD_ROWS = 4096
QUERY_ROWS = 512
LEAF_ROWS = 96
# Whole-number products and sums up to this size are exact in double precision.
EXACT = float(1 << 53)
LONG_MAX = (1 << 63) - 1


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: tuple[Node, Node] | None


def ball_tree(x: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Ball tree over the rows of x; a node is split between two far points, halves of equal size."""
    rows = np.arange(len(x)) if rows is None else rows
    own = x[rows]
    centre = own.mean(0)
    away = np.sqrt(((own - centre) ** 2).sum(1))
    radius = float(away.max()) * (1 + 1e-9)
    if len(rows) <= LEAF_ROWS or radius == 0:
        return Node(centre, radius, rows, None)
    far = own[away.argmax()]
    other = own[((own - far) ** 2).sum(1).argmax()]
    order = np.argsort(own @ (other - far), kind="stable")
    half = len(rows) // 2
    return Node(centre, radius, rows, (ball_tree(x, rows[order[:half]]), ball_tree(x, rows[order[half:]])))


def search(x: np.ndarray, ids: np.ndarray, keys: np.ndarray, tree: Node, q: np.ndarray, q_key: int, k: int,
           floor: float) -> list[tuple[float, int]]:
    """The rows (score, index) of the shard that can be among the k best of q, given that k rows score ``floor`` or more.

    Ties are kept in favour of smaller ids; the row with the query's own key is left out.
    """
    norm = float(np.sqrt(q @ q))

    def bound(node: Node) -> float:
        # The rounding of q.c and of |q| r grows with their factors, not with the bound, which may be near zero.
        reach = norm * node.radius
        return float(q @ node.centre) + reach + 1e-9 * (reach + norm * float(np.sqrt(node.centre @ node.centre))) + 1e-6

    best: list[tuple[float, int, int]] = []  # heap of (score, -id, index): the worst first
    heap = [(-bound(tree), 0, tree)]
    made = 1
    while heap:
        b, _, node = heapq.heappop(heap)
        limit = max(floor, best[0][0]) if len(best) == k else floor
        if -b < limit:
            break
        if node.children:
            for child in node.children:
                heapq.heappush(heap, (-bound(child), made, child))
                made += 1
            continue
        scores = x[node.rows] @ q
        for i in np.flatnonzero(scores >= limit):
            row = int(node.rows[i])
            if keys[row] == q_key:
                continue
            entry = (float(scores[i]), -int(ids[row]), row)
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return [(s, row) for s, _, row in best]


def _exact_scores(x: np.ndarray, q: np.ndarray) -> list[int]:
    """Scores beyond the exact range of doubles, by whole numbers, held within a long."""
    return [max(-LONG_MAX - 1, min(LONG_MAX, sum(int(a) * int(b) for a, b in zip(r, q, strict=True)))) for r in x]


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(row, vec_id, dim, v): floor(scale * x) of every component, as doubles; unusable vectors are left out."""
    x = F.col("embedding")
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    usable = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(usable & F.col("vec_id").isNotNull()) \
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                F.size("embedding").alias("dim"),
                whole.alias("v"))


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row where ``is_query`` holds.

    ``vectors`` has vec_id and embedding; other columns are ignored. Scores are inner products of the components
    ``floor(scale * x)``; ties go to the smaller vec_id. Vectors that are null or hold null or non-finite components, and
    rows without id, take no part. Repeated rows are rows of their own (each finds the others); only
    vectors of equal length meet. An empty table gives no rows.
    """
    base = written(quantised(vectors, scale).withColumn("query", is_query), "vectors")
    dims = base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("queries"))
    dims = dims.select("dim", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
                       F.ceil(F.greatest("queries", F.lit(1)) / QUERY_ROWS).cast("int").alias("blocks"))
    base = base.join(dims, "dim")
    shard = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).cast("int")
    rows = base.select("dim", shard.alias("shard"), F.lit(-1).alias("block"), "row", "vec_id", "v",
                       F.lit(None).cast("double").alias("floor"))
    queries = base.filter("query").select("dim", "shards", block.alias("block"), "row", "vec_id", "v")

    def searched(asked: DataFrame) -> DataFrame:
        """Search (dim, shard, block, row, vec_id, v, floor) in its shards; the tree of a shard is built once per task."""
        work = rows.unionByName(asked).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "block", "row")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = _Shard(k)
            for batch in batches:
                yield from state.take(batch)

        return work.mapInArrow(run, "query_row long, query_id long, vec_id long, row long, score double, exact string")

    # A first shard by the query's own place gives every query a kth score.
    home = queries.withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")) \
        .withColumn("floor", F.lit(None).cast("double"))
    first = written(searched(home.select(*rows.columns)), "first")
    kth = first.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")) \
        .select(F.col("query_row").alias("row"), F.when(F.col("n") >= k, F.col("kth")).alias("floor"))
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1),
                      lambda s: s != F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    rest = queries.join(kth, "row", "left").withColumn("shard", F.explode(others))
    found = first.unionByName(searched(rest.select(*rows.columns)))
    exact = F.coalesce(F.col("exact").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)"))
    order = Window.partitionBy("query_row").orderBy(exact.desc(), F.col("vec_id"), F.col("row"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", exact.cast("long").alias("score"))


class _Shard:
    """Reads rows sorted by shard: first the shard's vectors (block -1), then its queries."""

    def __init__(self, k: int):
        self.k, self.key, self.parts, self.tree = k, None, [], None

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims, shards, blocks = (batch.column(c).to_numpy(False) for c in ("dim", "shard", "block"))
        n = batch.num_rows
        new = np.ones(n, bool)
        new[1:] = (dims[1:] != dims[:-1]) | (shards[1:] != shards[:-1]) | ((blocks[1:] < 0) != (blocks[:-1] < 0))
        cuts = np.append(np.flatnonzero(new), n)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if (dims[lo], shards[lo]) != self.key:
                self.key, self.parts, self.tree = (dims[lo], shards[lo]), [], None
            part = batch.slice(lo, hi - lo)
            x = part.column("v").flatten().to_numpy(False).reshape(hi - lo, int(dims[lo]))
            ids, keys = part.column("vec_id").to_numpy(False), part.column("row").to_numpy(False)
            if blocks[lo] < 0:
                self.parts.append((x, ids, keys))
            else:
                yield from self._answer(x, ids, keys, part.column("floor").to_pylist())

    def _answer(self, q: np.ndarray, q_ids: np.ndarray, q_keys: np.ndarray, floors: list) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        if self.tree is None:
            self.x, self.ids, self.keys = (np.concatenate(p) for p in zip(*self.parts, strict=True))
            self.tree = ball_tree(self.x)
        out: dict[str, list] = {c: [] for c in ("query_row", "query_id", "vec_id", "row", "score", "exact")}
        with np.errstate(over="ignore", invalid="ignore"):
            size = float(np.abs(self.x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(q.shape[1], 1)
        for i in range(len(q)):
            if size < EXACT:
                hits = search(self.x, self.ids, self.keys, self.tree, q[i], int(q_keys[i]), self.k,
                              -np.inf if floors[i] is None else floors[i])
                exact = [None] * len(hits)
            else:
                # Beyond the exact range bounds cannot be trusted: the whole shard, in whole numbers.
                scores = _exact_scores(self.x, q[i])
                order = sorted((-s, int(self.ids[r]), r) for r, s in enumerate(scores) if self.keys[r] != q_keys[i])
                hits = [(float(-s), r) for s, _, r in order[:self.k]]
                exact = [str(-s) for s, _, _ in order[:self.k]]
            out["query_row"] += [q_keys[i]] * len(hits)
            out["query_id"] += [q_ids[i]] * len(hits)
            out["vec_id"] += [self.ids[r] for _, r in hits]
            out["row"] += [self.keys[r] for _, r in hits]
            out["score"] += [s for s, _ in hits]
            out["exact"] += exact
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.float64() if c == "score" else pa.string() if c == "exact" else pa.int64())
                                          for c, v in out.items()})
