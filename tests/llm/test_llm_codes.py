"""Vector codes, hard negatives and language identification against brute force."""

import hashlib
import math
import random
import unicodedata
import zlib

import numpy as np
import pytest
from llm_fixtures import awkward, empty
from pyspark.sql import functions as F

from shelfwise.llm import codebooks, langid, negatives

SCHEMA = ("vec_id long, embedding array<double>, label int, dim string, v string, row int, entry int, sums string, code string, "
          "error int, cell string, kind int, t int, e int, anchor int, wanted string, block int")


def _table(spark, triples):
    return spark.createDataFrame([(i, e, x, "d", "v", 1, 2, "s", "c", 3, "z", 4, 5, 6, 7, "w", 8) for i, e, x in triples], SCHEMA)


def _triples(seed=0, n=240, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[60:120] = x[60] + 0.05 * rng.normal(size=(60, dim))  # a dense group
    x[120:150] = x[3]  # exact copies: ties
    out = [(i, [float(np.float32(c)) for c in r], None if i % 41 == 5 else int(rng.integers(0, 4))) for i, r in enumerate(x)]
    out += [(900, None, 1), (901, [math.nan] * dim, 1), (902, [None] + [1.0] * (dim - 1), 1), (903, [math.inf] * dim, 1),
            (904, [0.0] * dim, None), (905, [], 2), (906, [], 2), (907, [1.0, -2.0, 0.5], 2), (908, [1.0, -2.5, 0.5], 1),
            (909, [-1.0, 2.0, 0.5], 3), out[7], out[7], (None, out[9][1], 1), (1000, out[11][1], out[11][2])]
    return out


def _usable(e):
    return e is not None and all(c is not None and math.isfinite(c) for c in e)


def _lloyd(triples, parts, entries, rounds, scale):
    """(codes and errors by row, codebooks by length) of the plain method in Python's whole numbers."""
    kept = [(i, [math.floor(scale * c) for c in e], x) for i, e, x in triples if _usable(e)]
    out, books = [], {}
    for dim in {len(v) for _, v, _ in kept}:
        own = [r for r in kept if len(r[1]) == dim]
        borders = codebooks.cuts(dim, parts)
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
        found = [([], 0) for _ in own]
        books[dim] = []
        for lo, hi in zip(borders[:-1], borders[1:]):
            book = [r[1][lo:hi] for r in first]

            def nearest(v):
                return min((sum((a - b) ** 2 for a, b in zip(v[lo:hi], c)), k) for k, c in enumerate(book))

            for _ in range(rounds):
                of = [nearest(r[1])[1] for r in own]
                for k in range(len(book)):
                    mine = [r[1][lo:hi] for r, z in zip(own, of) if z == k]
                    if mine:
                        book[k] = [sum(c) // len(mine) for c in zip(*mine)]
            for j, r in enumerate(own):
                d, k = nearest(r[1])
                found[j] = (found[j][0] + [k], found[j][1] + d)
            books[dim].append(book)
        out += [(r[0], r[2], dim, code, error) for r, (code, error) in zip(own, found)]
    return out, books


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (3, 5, 4), (4, 1, 2)])
def test_codes_equal_plain_lloyd(spark, parts, entries, rounds):
    triples = _triples()
    got = codebooks.compress(_table(spark, triples), parts, entries, rounds, 4096)
    want, books = _lloyd(triples, parts, entries, rounds, 4096)
    assert sorted(map(repr, want)) == sorted(repr((r.vec_id, r.label, r.dim, list(r.code), r.error)) for r in got.rows.collect())
    assert got.books == books
    numbers = ",".join(str(c) for book in books[16] for e in book for c in e)
    assert got.digest(16) == hashlib.sha256(numbers.encode()).hexdigest()


def test_codes_of_extreme_and_missing_rows(spark):
    big = [(1, [1e12, 1.0], 0), (2, [1e12, 2.0], 0), (3, [-3e30, 5.0], 0), (4, [1e300, 7.0], 0)]
    got = codebooks.compress(_table(spark, big), parts=1, entries=2, rounds=3)
    want, books = _lloyd(big, 1, 2, 3, 4096)
    assert got.books == books
    assert sorted((r.vec_id, list(r.code), r.error) for r in got.rows.collect()) == \
        sorted((i, code, min(error, codebooks.LONG_MAX)) for i, _, _, code, error in want)
    assert codebooks.compress(_table(spark, [])).rows.count() == 0
    assert codebooks.compress(_table(spark, [(1, None, 0)])).rows.count() == 0


@pytest.mark.parametrize("b", [1, 2, 5, 8])
def test_bounds_never_keep_a_wrong_entry(b):
    rng = np.random.default_rng(b)
    x = np.floor(1000 * rng.normal(size=(400, 4)))
    x[:50] = np.round(x[:50], -3)  # ties
    entries = [[int(c) for c in r] for r in x[:12]]
    bounds = codebooks.Bounds.fresh(codebooks.Codebook(entries), x, b)
    compared = 0
    for step in (500, 200, 50, 10, 0, 0):
        moved = [[c + int(rng.integers(-step, step + 1)) for c in e] for e in entries]
        bounds.book, entries = codebooks.Codebook(moved, entries), moved
        bounds.needed[:] = 0
        bounds.moved()
        bounds.assign()
        d = bounds.book.distances(x)
        assert (bounds.entry == d.argmin(1)).all()
        real = np.sqrt(d)
        own = real[np.arange(400), bounds.entry]
        assert (bounds.upper >= own).all()
        assert (bounds.lower[:, :-1] <= np.take_along_axis(real, bounds.near, 1)).all()
        others = real.copy()
        np.put_along_axis(others, np.column_stack([bounds.entry, bounds.near]), np.inf, 1)
        assert (bounds.lower[:, -1] <= others.min(1)).all() and (np.diff(bounds.lower, axis=1) >= 0).all()
        compared += int((bounds.needed > 0).sum())
    assert compared < 6 * 400 / 2  # most parts are decided by their bounds


def test_fewer_bounds_where_few_are_needed():
    assert codebooks.next_width(np.array([1000, 5, 1, 0, 0, 0, 0, 0, 0, 0]), 8, 16) == 2
    assert codebooks.next_width(np.array([100] * 8 + [0, 0]), 8, 16) == 7
    assert codebooks.next_width(np.zeros(10), 8, 16) == 2


def _mined(triples, anchor, k, m, share, scale):
    usable = [(j, i, x, [math.floor(scale * c) for c in e]) for j, (i, e, x) in enumerate(triples)
              if _usable(e) and i is not None and x is not None]
    out = []
    for j, i, x, q in usable:
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), n, r, y) for r, n, y, v in usable if r != j and len(v) == len(q))
        for p, n, _, _ in [s for s in scored if s[3] == x][:k]:
            fits = [s for s in scored if s[3] != x and share[0] * -p <= share[1] * -s[0] and -s[0] <= -p]
            out += [(i, n, rank + 1, s[1], -p, -s[0]) for rank, s in enumerate(fits[:m])]
    return sorted(out)


@pytest.mark.parametrize("block,sample,anchors", [(8192, 1024, 256), (17, 9, 5)])
def test_hard_negatives_are_exact(spark, monkeypatch, block, sample, anchors):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "SAMPLE_ROWS_A_CENTRE", sample)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", anchors)
    triples = _triples(2)
    got = negatives.mine(_table(spark, triples), F.col("vec_id") % 7 == 0)
    want = _mined(triples, lambda i: i % 7 == 0, 5, 5, (80, 100), 256)
    assert len(want) > 100
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got.collect()) == want


def test_hard_negatives_of_extreme_and_missing_rows(spark):
    big = [(0, [1e7, 1.0], 0), (1, [1e7, 2.0], 0), (2, [9e6, 5.0], 1), (3, [1e7, 1.5], 1), (4, [1.0, 1.0], 1)]
    got = negatives.mine(_table(spark, big), F.col("vec_id") == 0).collect()
    want = _mined(big, lambda i: i == 0, 5, 5, (80, 100), 256)
    assert [tuple(r) for r in sorted(got, key=lambda r: r["rank"])] == want and len(want) == 2
    assert negatives.mine(_table(spark, []), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(_table(spark, [(0, [1.0], 1)]), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("dim", [1, 3, 64, 100])
def test_intervals_hold_the_product(dim):
    rng = np.random.default_rng(dim)
    x, q = np.floor(256 * rng.normal(size=(300, dim))), np.floor(256 * rng.normal(size=(40, dim)))
    x[:20] = q[:20]
    x[20] = 0
    centre = x[5:9].mean(0)
    turn = negatives.rotation(dim)
    assert np.allclose(turn @ turn.T, np.eye(dim))
    codes = negatives.Codes(x - centre, turn)
    norm = np.sqrt((q * q).sum(1))
    estimate, error = negatives.popcount_products(codes.words, q @ turn.T)
    signs = np.where((x - centre) @ turn.T >= 0, 1, -1) / np.sqrt(dim)
    assert (np.abs(estimate - signs @ (q @ turn.T).T) <= error + 1e-6).all()
    low, high = negatives.intervals(codes, (centre @ q.T)[None], estimate, error, norm, float(np.sqrt(centre @ centre)))
    real = x @ q.T
    assert (low <= real).all() and (real <= high).all()


def _symbols(text):
    out = [0]
    for c in text:
        low = c.lower()
        s = 0 if unicodedata.category(c)[0] != "L" else ord(low) if len(low) == 1 else ord(c)
        if s or out[-1]:
            out.append(s)
    return out + [0] if out[-1] else out


def _grams(text, bins):
    s = _symbols(text or "")
    for n in langid.ORDERS:
        for i in range(len(s) - n + 1):
            if n > 1 or s[i]:
                h = n
                for c in s[i:i + n]:
                    h = (h ^ c) * 0x9E3779B1 & 0xFFFFFFFF
                    h ^= h >> 15
                yield h % bins


def _bayes(triples, bins, smoothing):
    """{row: (language, score)} by plain counting."""
    train = [(t, x) for i, t, x in triples if x is not None and zlib.crc32(str("" if i is None else i).encode()) % 3 != 1]
    langs = sorted({x for _, x in train})
    count = {x: [0] * bins for x in langs}
    for t, x in train:
        for g in _grams(t, bins):
            count[x][g] += 1
    out = []
    for _, t, _ in triples:
        if not langs or not t or not any(unicodedata.category(c)[0] == "L" for c in t):
            out.append(("und", 0.0))
            continue
        logs = []
        for x in langs:
            total = sum(count[x]) + smoothing * bins
            logs.append(math.log(sum(y == x for _, y in train) / len(train))
                        + math.fsum(math.log((count[x][g] + smoothing) / total) for g in _grams(t, bins)))
        top = max(logs)
        out.append((langs[logs.index(top)], 1 / sum(math.exp(v - top) for v in logs)))
    return out


def test_language_equals_plain_counting(spark):
    rng = random.Random(3)
    words = {"en": "the of and quick brown", "fr": "le la été où naïve", "zh": "漢字 中文 文字", None: "Ø ß 42"}
    triples = []
    for i in range(80):
        x = rng.choice(list(words))
        t = " ".join(rng.choice((words[x] + " İstanbul ÉTÉ 7 -- 😀").split()) for _ in range(rng.randint(0, 4)))
        triples.append((i if i % 19 else None, rng.choice([t, t, t, None, "12 34", "", "a"]), x))
    triples += triples[:5]
    docs = spark.createDataFrame([(i, t, x, "s", 1, "lang_pred", 2.0) for i, t, x in triples],
                                 "doc_id long, text string, lang string, source string, n int, lang_pred string, score double")
    got = langid.identify(docs, smoothing=0.5, bins=512).collect()
    want = [(i, zlib.crc32(str("" if i is None else i).encode()) % 3 == 1, x, round(s, 9))
            for (i, _, _), (x, s) in zip(triples, _bayes(triples, 512, 0.5))]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9))) for r in got)


def test_language_of_awkward_and_empty_tables(spark):
    assert langid.identify(empty(spark)).count() == 0
    docs = awkward(spark)
    got = langid.identify(docs)
    assert got.count() == docs.count() and got.filter("lang_pred <> 'und' or score <> 0").count() == 0
    mixed = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "xx").otherwise("yy"))
    assert langid.identify(mixed).filter("lang_pred = 'und'").count() == 3
    with pytest.raises(ValueError):
        langid.fit(spark.range(langid.MAX_LANGUAGES + 1).select(F.col("id").cast("string").alias("lang"), F.lit("a").alias("text")))


def test_windows_of_a_long_text_give_the_same_grams():
    rng = random.Random(5)
    text = "".join(rng.choice("abcdé漢 .😀  XYZ") for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    whole, cuts, _ = langid.symbols(data, np.array([0, len(data)]))
    assert whole.tolist() == _symbols(text)
    for width in (1, 2, 7, 100, 5000):
        counts = np.zeros(997, np.int64)
        for part, carried in langid.windows(data, width):
            for entries, _ in langid.gram_bins(part, np.array([0, len(part)]), 997, carried):
                counts += np.bincount(entries, minlength=997)
        assert (counts == np.bincount(list(_grams(text, 997)), minlength=997)).all()


def test_long_texts_are_counted_and_scored_in_windows(spark, monkeypatch):
    texts = ["le chat " * 3000, "the cat " * 3000, "le chien est là", "the dog is here"]
    docs = spark.createDataFrame([(i, t, "fr" if "le" in t.split() else "en") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string")
    known = docs.filter("lang is not null")
    small, whole = langid.fit(known, step=100), langid.fit(known)
    assert small.languages == whole.languages and (small.table == whole.table).all()
    a, b = (sorted(map(tuple, langid.predict(docs, whole, step=s).collect())) for s in (100, 1 << 20))
    assert a == b


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    joined = langid.identify(docs).join(docs.select("doc_id", F.col("lang").alias("real")), "doc_id").filter("held_out")
    right, n = joined.agg(F.avg((F.col("lang_pred") == F.col("real")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_ill_formed_bytes_do_not_fail():
    data = np.frombuffer(b"ab\xff\xfe\x80\x80c\xc3", np.uint8)
    got, cuts, lettered = langid.symbols(data, np.array([0, 2, 5, 8]))
    assert len(cuts) == 4 and lettered.tolist() == [True, False, True]
