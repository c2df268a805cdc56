"""Top-k search and embedding near-dedup against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import covertree, topk

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string, id int, n_links string, dim string"


def _table(spark, pairs):
    return spark.createDataFrame([(i, e, 0, 1, "x", 2, "y", "z") for i, e in pairs], SCHEMA)


def _vectors(seed=0, n=300, dim=8):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[100:160] = x[100] + 0.02 * rng.normal(size=(60, dim))  # one dense group
    for i in range(160, 200):  # chains of near copies
        x[i] = x[i - 1] + 0.09 * rng.normal(size=dim)
    x[200:210] = x[5]  # exact copies
    pairs = [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(x)]
    pairs += [(900, None), (901, []), (902, [0.0] * dim), (903, [math.nan] + [1.0] * (dim - 1)), (904, [math.inf] + [1.0] * (dim - 1)),
              (905, [None] + [1.0] * (dim - 1)), (906, [1.0, 2.0]), (907, [1.0, 2.0]), (None, pairs[3][1]), pairs[7], (1000, pairs[9][1])]
    return pairs


def _usable(e):
    return e is not None and all(c is not None and math.isfinite(c) for c in e)


@pytest.mark.parametrize("shard_rows,leaf", [(4096, 96), (40, 4)])
def test_top_k_is_exact(spark, monkeypatch, shard_rows, leaf):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "LEAF_ROWS", leaf)
    pairs = _vectors()
    got = topk.top_k(_table(spark, pairs), F.col("vec_id") % 50 == 0, k=10).collect()
    rows = [(k, i, [math.floor(1024 * c) for c in e]) for k, (i, e) in enumerate(pairs) if i is not None and _usable(e)]
    want = []
    for k, i, q in rows:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in rows if m != k and len(v) == len(q))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:10])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_top_k_of_extreme_and_missing_rows(spark):
    big = [(0, [1e12, 1.0]), (1, [1e12, 2.0]), (2, [-3e38, 0.0]), (3, [1.0, 1.0])]
    got = topk.top_k(_table(spark, big), F.col("vec_id") == 0, k=2).collect()
    assert [(r.vec_id, r["rank"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (3, 2)]
    assert topk.top_k(_table(spark, []), F.col("vec_id") == 0).count() == 0


def _brute(pairs, cosine):
    rows = [(i, np.array(e, float)) for i, e in pairs if i is not None and e and _usable(e) and any(e)]
    n = {i: 0 for i, _ in pairs}
    up = {i: i for i, _ in pairs if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in range(len(rows)):
        for b in range(len(rows)):
            (i, x), (j, y) = rows[a], rows[b]
            if a != b and len(x) == len(y) and (x @ y) / np.sqrt((x @ x) * (y @ y)) >= cosine:
                n[i] += a < len(rows)
                ri, rj = root(i), root(j)
                up[max(ri, rj)] = min(ri, rj)
    return n, {i: root(i) for i in up}


@pytest.mark.parametrize("cell,block", [(4096, 4096), (30, 17)])
def test_near_duplicate_vectors_are_exact(spark, monkeypatch, cell, block):
    monkeypatch.setattr(covertree, "CELL_ROWS", cell)
    monkeypatch.setattr(covertree, "BLOCK_ROWS", block)
    pairs = [p for k, p in enumerate(_vectors(3)) if p not in _vectors(3)[:k]]
    n, comp = _brute(pairs, 0.95)
    got = covertree.near_duplicates(_table(spark, pairs)).collect()
    assert len(got) == len(pairs)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], comp[r.vec_id], comp[r.vec_id] == r.vec_id)


def test_near_duplicate_vectors_repeated_and_empty(spark):
    got = covertree.near_duplicates(_table(spark, [(1, [1.0, 0.0])] * 3 + [(2, [0.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 2, 1)] * 3 + [(2, 0, 2)]
    assert covertree.near_duplicates(_table(spark, [])).count() == 0
    assert covertree.near_duplicates(_table(spark, [(1, None), (2, [0.0])])).count() == 2


def test_cover_tree_groups_a_dense_cluster():
    rng = np.random.Generator(np.random.PCG64(0))
    x = rng.normal(size=(500, 16))
    x[:250] = x[0] + 1e-3 * rng.normal(size=(250, 16))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    linker = covertree.Linker(x, np.ones(500, np.int64), 0.95)
    tree = covertree.cover_tree(x, np.arange(500), 2.0, rng)
    linker.traverse(tree, tree)
    want = (x @ x.T >= 0.95).sum(1) - 1
    assert (linker.links == want).all()


def test_ball_bounds_hold_where_products_cancel():
    """Nearly parallel vectors with components near 2**25 and a query across them: q.c cancels to a few units."""
    rng = np.random.Generator(np.random.PCG64(3))
    base = np.repeat([[1 << 25, -(1 << 25)]], 400, 0).astype(float)
    x = base + rng.integers(-3, 4, base.shape)
    tree = topk.ball_tree(x)
    ids = np.arange(len(x))
    for q in (np.array([1 << 25, 1 << 25], float), np.array([(1 << 25) - 1, 1 << 25], float), np.array([-5.0, -5.0])):
        got = sorted((-s, ids[r]) for s, r in topk.search(x, ids, ids, tree, q, -1, 10, -np.inf))
        assert got == sorted((-float(a @ q), i) for i, a in enumerate(x))[:10]
