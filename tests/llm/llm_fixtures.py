"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, row long, id string, key int, "
          "n long, target double, sig binary, score double, stats string, h long, shard int, component_id long")


def rows(texts, sources=None):
    """(doc_id, text, source) triples as full rows; the extra columns clash with names used inside operators."""
    sources = sources or ["a"] * len(texts)
    return [(i, t, None, s, None, 1, 2, "x", 3, 4, 5.0, b"6", 7.0, "8", 9, 10, 11) for i, (t, s) in enumerate(zip(texts, sources))]


def awkward(spark, seed=1, n=60):
    """Null and empty texts, a null id and source, repeated rows, ties, one very long text, many short ones."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta,", "epsilon.", "zeta", "eta", "théta", "漢字", "k9", "it's", " ", "😀"]
    texts = [None, "", " \t\n ", "one", "One", "cc by", "All rights reserved.", "x" * 5000, "word " * 60_000]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(n)]
    texts += texts[9:19]
    out = rows(texts, [rng.choice(["a", "a", "b", "é", None]) for _ in texts])
    out.append((None,) + out[12][1:])
    out.append(out[13])
    out.append(out[13])
    return spark.createDataFrame(out, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
