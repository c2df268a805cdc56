"""Mixing and sharding against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import SCHEMA, awkward, empty, rows
from pyspark.sql import functions as F

from shelfwise.llm import _common, mixing, sharding


def _words(text):
    return len((text or "").encode().split())


def _hash(*parts):
    return int(hashlib.md5("|".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16)


def _water_fill(sizes, weights, cap):
    """Targets by the plain procedure: share by weight, cut at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    free, left = set(order), float(sum(sizes.values()))
    while free and left > 1e-9:
        total = sum(w[s] for s in free)
        share = {s: target[s] + left * w[s] / total for s in free}
        left = sum(max(0.0, share[s] - cap * sizes[s]) for s in free)
        for s in list(free):
            target[s] = min(share[s], cap * sizes[s])
            if share[s] >= cap * sizes[s]:
                free.discard(s)
    return target, order


@pytest.mark.parametrize("bucket", [20_000, 7])
def test_mix_is_a_fair_queue(spark, monkeypatch, bucket):
    for m in (mixing, _common):
        monkeypatch.setattr(m, "ROWS_PER_BUCKET", bucket)
    docs = spark.createDataFrame([r for r in awkward(spark).collect() if r.doc_id is not None], SCHEMA).dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in mixing.mix_documents(docs).collect()}
    src = {r.doc_id: r.source for r in docs.collect()}
    size = {r.doc_id: _words(r.text) for r in docs.collect()}
    total = defaultdict(int)
    for d, s in src.items():
        total[s] += size[d]
    target, order = _water_fill(total, (5, 2, 1), 3)
    queue = []
    for s in order:
        run = 0
        for e in range(3):
            for h, d in sorted((_hash(mixing.SEED, e, d), d) for d in src if src[d] == s and size[d]):
                run += size[d]
                queue.append((run / target[s], order.index(s), e, h, d))
    budget, served, taken = sum(size.values()), 0, Counter()
    for f in sorted(queue):
        served += size[f[-1]]
        if served > budget:
            break
        taken[f[-1]] += size[f[-1]]
    for d, r in got.items():
        assert (r.size, r.source_size, r.taken) == (size[d], total[src[d]], taken[d])
        assert math.isclose(r.target, target[src[d]], rel_tol=1e-9)
        assert r.taken <= 3 * r.size


def test_mix_takes_awkward_rows(spark):
    docs = awkward(spark)
    got = mixing.mix_documents(docs).collect()
    assert len(got) == docs.count()
    assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in got)
    assert mixing.mix_documents(empty(spark)).count() == 0
    again = mixing.mix_documents(docs).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows_repeat_documents(spark):
    docs = awkward(spark)
    plan = Counter()
    for r in mixing.mix_documents(docs).collect():
        plan[r.doc_id, r.size] += r.copies
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert Counter({k: v for k, v in plan.items() if v}) == Counter((r.doc_id, _words(r.text)) for r in out.collect())
    assert mixing.mixed_rows(empty(spark)).count() == 0


@pytest.mark.parametrize("bucket", [20_000, 5])
def test_shards_match_the_mixture(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", bucket)
    docs = spark.createDataFrame([(i, f"t{i}", "en", "abc"[min(i % 5, 2)], 2) for i in range(400)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sharding.shard_documents(docs, 16).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert set(by) == set(range(16))
    n = Counter(r.source for r in got)
    for rs in by.values():
        assert len(rs) == 25 and sorted(r.slot for r in rs) == list(range(25))
        for s, k in n.items():
            assert abs(sum(r.source == s for r in rs) - k / 16) <= 1
    # The order is by fractional rank in a seeded order of each source.
    want = []
    for s in sorted(n):
        ids = sorted((_hash(sharding.SEED, r.doc_id), r.doc_id) for r in got if r.source == s)
        want += [((i + 0.5) / len(ids), s, d) for i, (_, d) in enumerate(ids)]
    assert [d for _, _, d in sorted(want)] == [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]


def test_shards_take_awkward_rows(spark):
    docs = awkward(spark)
    got = sharding.shard_documents(docs, 16).collect()
    assert len(got) == docs.count()
    count = Counter(r.shard for r in got)
    assert max(count.values()) - min(count.get(s, 0) for s in range(16)) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(count[s])) for s in count)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert sharding.shard_documents(empty(spark), 16).count() == 0


def test_written_shards_hold_the_documents(spark, tmp_path):
    docs = spark.createDataFrame(rows([f"text {i}" for i in range(40)], ["a", "b"] * 20), SCHEMA)
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r.shard for r in back.collect()) == {0: 10, 1: 10, 2: 10, 3: 10}
    assert {r.text for r in back.collect()} == {f"text {i}" for i in range(40)}


def _hot(spark, seed, parts):
    """A third of the rows under one id with texts of their own, some of them equal; the order and files change with the seed."""
    texts = [" ".join(["w"] * (1 + i % 9)) + f" {i % 150}" for i in range(600)]
    out = [((7 if i < 200 else 1000 + i), t, "ab"[i % 3 > 1]) for i, t in enumerate(texts)]
    random.Random(seed).shuffle(out)
    return spark.createDataFrame(out, "doc_id long, text string, source string").repartition(parts)


def test_reruns_agree_on_rows_of_one_id(spark):
    mixes = [Counter((r.doc_id, r.text, r.source) for r in mixing.mixed_rows(_hot(spark, i, p)).collect()) for i, p in enumerate((1, 3, 8))]
    assert mixes[0] == mixes[1] == mixes[2] and max(mixes[0].values()) > 1
    plans = [Counter((r.doc_id, r.size, r.source, r.taken) for r in mixing.mix_documents(_hot(spark, i, p)).collect()) for i, p in enumerate((1, 5))]
    assert plans[0] == plans[1]
    shards = [Counter((r.doc_id, r.text_crc32, r.shard, r.slot) for r in sharding.shard_documents(_hot(spark, i, p), 16).collect())
              for i, p in enumerate((1, 3, 8))]
    # Equal documents of two ids never trade places; equal rows of one id are one content.
    assert shards[0] == shards[1] == shards[2]


def test_one_id_fills_several_ranges(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = _hot(spark, 1, 4).select("doc_id", "text", F.lit(5).alias("h"), F.monotonically_increasing_id().alias("row"))
        got = _common.in_ranges(rows, ["h", "doc_id", "text", "row"], "b", "ranges").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    n = Counter(r.b for r in got)
    assert len(n) >= 4 and max(n.values()) <= 600 / 2
    assert len({r.b for r in got if r.doc_id == 7}) >= 2
    order = [r.b for r in sorted(got, key=lambda r: (r.h, r.doc_id, r.text, r.row))]
    assert order == sorted(order)


def test_mixed_rows_keep_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 5, "x", 9, 2), (2, "c", None, 6, "y", 8, 3)],
                                 "doc_id long, text string, source string, row long, _mix_row string, copies int, tie int")
    got = mixing.mixed_rows(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in docs.collect()}
