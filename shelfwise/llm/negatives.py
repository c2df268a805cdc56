"""Hard-negative mining: rotated one-bit codes with stored alignment, Cauchy-Schwarz intervals, integer scores.

Every vector x of whole numbers belongs to the cell of its nearest centre c (:data:`CENTRES` at most, from a bounded sample). Its
remainder y = x - c is turned by a random rotation; the code is one sign bit per component, s the unit vector
of those signs. Stored with it are the alignment t = y.s and the length e of what s leaves, so that y = t s + r with
|r| = e and r at right angles to s. For an anchor q:

    q.x = q.c + t (q.s) + q.r      with   |q.r| <= e sqrt(|q|^2 - (q.s)^2)

q.s comes from popcounts: the rotated anchor is cut into ``PLANES`` bit planes of one step size, whose rounding moves q.s by
a known length at most. The two give an interval that holds q.x for certain. Rows whose interval
cannot reach what an anchor still looks for are left out; all others are scored in whole numbers.

Anchors (a stated set) meet blocks of at most about ``BLOCK_ROWS`` rows of a cell, and only cells whose bound
q.c + |q| radius reaches what they look for: first the cell of their own for a kth positive score, then the others; at last
the cells that may hold a negative.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored, removed, written
from .codebooks import EXACT, LONG_MAX, MAX_NUMBERS, matrix, whole_numbers

CENTRES = 64
SAMPLE_NUMBERS = 1 << 22
SAMPLE_ROWS_A_CENTRE = 1024
BLOCK_ROWS = 8192
ANCHOR_ROWS = 256
PLANES = 6
SEED = 29
#: Vector lengths that hold an anchor.
MAX_LENGTHS = 64


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    n, dim = bits.shape
    wide = np.zeros((n, -(-dim // 64) * 64), bool)
    wide[:, :dim] = bits
    return np.packbits(wide, axis=1).view(np.uint64).reshape(n, -1)


def slack(size: np.ndarray | float) -> np.ndarray | float:
    """Room for rounding in a bound whose terms are at most ``size``."""
    return 1e-9 * size + 1e-6


class Codes:
    """One-bit codes of remainders y: words, alignment t, length e of the rest and length of y."""

    def __init__(self, y: np.ndarray, turn: np.ndarray):
        z = y @ turn.T
        self.words = packed(z >= 0)
        dim = max(z.shape[1], 1)
        self.t = np.abs(z).sum(1) / np.sqrt(dim)
        square = (z * z).sum(1)
        self.size = np.sqrt(square) * (1 + 1e-9)
        self.e = np.sqrt(np.maximum(square - self.t ** 2, 0) + 1e-9 * square)


def popcount_products(words: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimates of q.s for every code and rotated anchor, bound of their error by anchor), from popcounts of bit planes."""
    dim = q.shape[1]
    low = q.min(1, initial=0)
    step = np.maximum((q.max(1, initial=0) - low) / ((1 << PLANES) - 1), 1e-300)
    whole = np.rint((q - low[:, None]) / step[:, None]).astype(np.int64)
    error = np.sqrt(((q - low[:, None] - whole * step[:, None]) ** 2).sum(1))
    ones = np.bitwise_count(words).sum(1, dtype=np.int64)
    met = np.zeros((len(words), len(q)), np.int64)
    for plane in range(PLANES):
        bits = packed((whole >> plane & 1).astype(bool))
        for w in range(words.shape[1]):
            met += np.bitwise_count(words[:, w, None] & bits[None, :, w]).astype(np.int64) << plane
    # The sum over set bits counts +, the rest of the anchor's sum counts -.
    plus = low * ones[:, None] + step * met
    total = low * dim + step * whole.sum(1)
    return (2 * plus - total) / np.sqrt(max(dim, 1)), error


def intervals(codes: Codes, from_centre: np.ndarray, estimate: np.ndarray, error: np.ndarray, norm: np.ndarray,
              centre_size: float) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) possible product of every row and anchor."""
    along = np.maximum(np.abs(estimate) - error, 0)
    across = codes.e[:, None] * np.sqrt(np.maximum(norm ** 2 - along ** 2, 0))
    half = across + codes.t[:, None] * error + slack(norm * (centre_size + codes.size[:, None]))
    middle = from_centre + codes.t[:, None] * estimate
    return middle - half, middle + half


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers, held within a long."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1) < EXACT:
        return (x @ q).astype(np.int64)
    own = [int(c) for c in q]
    return np.array([max(-LONG_MAX - 1, min(LONG_MAX, sum(int(a) * b for a, b in zip(r, own, strict=True)))) for r in x], dtype=np.int64)


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, ~score))[:k]


def kth_low(low: np.ndarray, k: int) -> float:
    """The kth highest of lower ends that are certain to count (none: no floor)."""
    return float(np.partition(low, len(low) - k)[len(low) - k]) if len(low) >= k else -np.inf


class Search:
    """Reads rows sorted by block: first the block's vectors (kind 0), then its anchors (kind 1)."""

    def __init__(self, centres: dict[int, np.ndarray], k: int, share: tuple[int, int] | None):
        self.centres, self.k, self.share = centres, k, share

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, block, turn = None, [], None, {}
        for batch in batches:
            named = [batch.column(c).to_numpy(False) for c in ("dim", "cell", "block", "kind")]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in named], axis=0)
            borders = np.append(np.flatnonzero(new), batch.num_rows)
            for lo, hi in zip(borders[:-1], borders[1:], strict=True):
                dim, cell, own, kind = (int(c[lo]) for c in named)
                if (dim, cell, own) != key:
                    key, parts, block = (dim, cell, own), [], None
                if dim not in turn:
                    turn = {dim: rotation(dim)}
                part = batch.slice(lo, hi - lo)
                if kind == 0:
                    parts.append(part)
                elif parts:
                    if block is None:
                        block = Block(parts, self.centres[dim][cell], turn[dim])
                    for at in range(0, part.num_rows, ANCHOR_ROWS):
                        yield from self.answers(block, part.slice(at, ANCHOR_ROWS), turn[dim])

    def answers(self, block: Block, part: pa.RecordBatch, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
        q = matrix(part, "v")
        norm = np.sqrt((q * q).sum(1)) * (1 + 1e-9)
        estimate, error = popcount_products(block.codes.words, q @ turn.T)
        low, high = intervals(block.codes, block.centre @ q.T, estimate, error, norm, float(np.sqrt(block.centre @ block.centre)))
        rows, labels = part.column("row").to_numpy(False), part.column("label").to_numpy(False)
        ids = part.column("vec_id").to_numpy(False)
        wanted = part.column("wanted").to_pylist()
        out: dict[str, list] = {"anchor_row": [], "anchor_id": [], "row": [], "vec_id": [], "score": []}
        for i in range(len(q)):
            found = self._positives if self.share is None else self._negatives
            at, score = found(block, q[i], low[:, i], high[:, i], int(rows[i]), labels[i], wanted[i] or [])
            out["anchor_row"].append(np.full(len(at), rows[i]))
            out["anchor_id"].append(np.full(len(at), ids[i]))
            out["row"].append(block.rows[at])
            out["vec_id"].append(block.ids[at])
            out["score"].append(score)
        yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate(v).astype(np.int64)) for c, v in out.items()})

    def _positives(self, block, q, low, high, row, label, wanted):
        """The k best other rows of the label, none below the floor ``wanted[0]``."""
        own = np.flatnonzero((block.labels == label) & (block.rows != row))
        floor = max(float(wanted[0]) if wanted else -np.inf, kth_low(low[own], self.k))
        at = own[high[own] >= floor]
        score = exact_scores(block.x[at], q)
        best = _best(score, block.ids[at], block.rows[at], self.k)
        return at[best], score[best]

    def _negatives(self, block, q, low, high, row, label, wanted):
        """For each positive score in ``wanted`` the k best rows of other labels within its share."""
        least, most = self.share
        wanted = sorted({p for p in wanted if p >= 0}, reverse=True)
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        own = np.flatnonzero((block.labels != label) & (high >= wanted[-1] * (least / most) * (1 - 1e-12)) & (low <= wanted[0]))
        need = np.zeros(len(own), bool)
        for p in wanted:
            inside = (high[own] >= p * (least / most) * (1 - 1e-12)) & (low[own] <= p)
            sure = own[inside & (high[own] <= p)]
            need |= inside & (high[own] >= kth_low(low[sure], self.k))
        at = own[need]
        score = exact_scores(block.x[at], q)
        chosen = []
        for p in wanted:
            # Whole numbers of any size: the products may pass a long.
            fits = np.flatnonzero((score <= p) & (score >= -(-least * p // most)))
            chosen.append(fits[_best(score[fits], block.ids[at[fits]], block.rows[at[fits]], self.k)])
        kept = np.unique(np.concatenate(chosen))
        return at[kept], score[kept]


class Block:
    def __init__(self, parts: list[pa.RecordBatch], centre: np.ndarray, turn: np.ndarray):
        self.x = np.concatenate([matrix(p, "v") for p in parts])
        self.ids, self.rows, self.labels = (np.concatenate([p.column(c).to_numpy(False) for p in parts]) for c in ("vec_id", "row", "label"))
        self.centre = centre
        self.codes = Codes.__new__(Codes)
        self.codes.words = np.concatenate([np.frombuffer(b"".join(p.column("words").to_pylist()), np.uint64) for p in parts]).reshape(len(self.x), -1)
        self.codes.t, self.codes.e, self.codes.size = (np.concatenate([p.column(c).to_numpy(False) for p in parts]) for c in ("t", "e", "size"))


def fitted_centres(base: DataFrame, dim: int) -> np.ndarray:
    """Cell centres: four Lloyd rounds over a sample of at most ``SAMPLE_NUMBERS`` numbers, chosen by a hash of the vectors.

    They only decide how near a code's centre is; every row is indexed and results do not depend on them.
    """
    sample = base.filter(F.col("dim") == dim).select("v", F.xxhash64("v").alias("h")) \
        .orderBy("h").limit(max(1, SAMPLE_NUMBERS // max(dim, 1))).select("v").toArrow()
    x = sample.column("v").combine_chunks().flatten().to_numpy(False).reshape(sample.num_rows, dim)
    x = np.unique(x, axis=0) if dim else x[:1]
    k = max(1, min(CENTRES, len(x) // SAMPLE_ROWS_A_CENTRE))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(4):
        own = nearest(x, centres)
        centres = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(k)])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return ((centres ** 2).sum(1) - 2 * x @ centres.T).argmin(1)


def encoded(base: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``base`` with the cell of every row and the code of its remainder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part, "v")
                cell = nearest(x, centres[dim])
                codes = Codes(x - centres[dim][cell], rotation(dim))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell, pa.int32()), pa.array([w.tobytes() for w in codes.words], pa.binary()),
                     pa.array(codes.t), pa.array(codes.e), pa.array(codes.size)],
                    names=[*part.schema.names, "cell", "words", "t", "e", "size"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(run, f"{kept}, cell int, words binary, t double, e double, size double")


def sent(anchors: DataFrame, cells: dict[int, dict[int, tuple[int, float]]], centres: dict[int, np.ndarray],
         home: bool | None = None) -> DataFrame:
    """Anchors copied to the blocks where a row may reach ``least`` (null: anything); ``home``: only their own block, or all but it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                q = matrix(part, "v")
                norm = np.sqrt((q * q).sum(1)) * (1 + 1e-9)
                least = np.array([-np.inf if x is None else x for x in part.column("least").to_pylist()], float)
                own_cell, own_block = (part.column(c).to_numpy(False) for c in ("cell", "block"))
                for cell, (blocks, radius) in cells[dim].items():
                    c = centres[dim][cell]
                    size = float(np.sqrt(c @ c))
                    reach = q @ c + norm * radius + slack(norm * (size + radius)) >= least - slack(np.abs(np.where(np.isfinite(least), least, 0)))
                    for block in range(blocks):
                        at_home = (own_cell == cell) & (own_block == block)
                        some = part.filter(pa.array(reach if home is None else at_home if home else reach & ~at_home))
                        if some.num_rows:
                            n = some.num_rows
                            yield pa.RecordBatch.from_arrays(
                                [*(some.column(x) for x in ("dim", "row", "vec_id", "label", "v", "wanted")),
                                 pa.array(np.full(n, cell, np.int32)), pa.array(np.full(n, block, np.int32))],
                                names=["dim", "row", "vec_id", "label", "v", "wanted", "cell", "block"])

    return anchors.mapInArrow(run, "dim int, row long, vec_id long, label long, v array<double>, wanted array<long>, cell int, block int")


def mine(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
         scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor.

    ``vectors`` has vec_id, embedding and label; other columns are ignored. Anchors are the rows where ``is_anchor`` (over
    vec_id and label) holds. Scores are inner products of the components ``floor(scale * x)``, held within a long; higher
    scores come first, ties go to the smaller vec_id. An anchor's positives are its first other rows of the same label; a
    positive's negatives are the first rows of other labels whose score is within ``share`` of the positive's and not above it;
    a negative positive score has none. Rows with a null id or label, or a vector that is null or holds null or non-finite
    components, take no part; repeated rows are rows of their own; only vectors of equal length meet. An empty table gives
    no rows.
    """
    spark = vectors.sparkSession
    tables = []

    def kept(df: DataFrame, tag: str) -> DataFrame:
        out, path = stored(df, tag)
        tables.append(path)
        return out

    base = whole_numbers(vectors, scale).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()) \
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                F.col("label").cast("long").alias("label"), "dim", "v", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    base = kept(base, "whole")
    # Vectors of a length without anchors meet nobody.
    dims = [r["dim"] for r in base.filter("anchor").select("dim").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(dims) > MAX_LENGTHS or sum(dims) * CENTRES > MAX_NUMBERS:
        raise ValueError("the cell centres of so many vector lengths are too large to send to every task")
    centres = {dim: fitted_centres(base, dim) for dim in dims}
    coded = kept(encoded(base.filter(F.col("dim").isin(dims)), centres), "coded")
    cells: dict[int, dict[int, tuple[int, float]]] = {dim: {} for dim in dims}
    for r in coded.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("radius")).collect():
        cells[r["dim"]][r["cell"]] = (-(-r["n"] // BLOCK_ROWS), r["radius"])
    blocks = F.lit(1)
    for dim in dims:
        for cell, (n, _) in cells[dim].items():
            if n > 1:
                blocks = F.when((F.col("dim") == dim) & (F.col("cell") == cell), n).otherwise(blocks)
    block = F.pmod(F.xxhash64("row"), blocks).cast("int")
    none = F.lit(None).cast("array<long>")
    rows = coded.select("dim", "cell", block.alias("block"), F.lit(0).alias("kind"), "row", "vec_id", "label", "v", "words", "t", "e",
                        "size", none.alias("wanted"))
    anchors = coded.filter("anchor").select("dim", "cell", block.alias("block"), "row", "vec_id", "label", "v")

    def searched(asked: DataFrame, k: int, within: tuple[int, int] | None) -> DataFrame:
        asked = asked.withColumn("kind", F.lit(1))
        work = rows.unionByName(asked, allowMissingColumns=True).repartition("dim", "cell", "block") \
            .sortWithinPartitions("dim", "cell", "block", "kind", "row")
        return work.mapInArrow(Search(centres, k, within), "anchor_row long, anchor_id long, row long, vec_id long, score long")

    first = kept(searched(sent(anchors.withColumn("wanted", none).withColumn("least", F.lit(None).cast("double")), cells, centres,
                               home=True), positives, None), "first")
    kth = first.groupBy(F.col("anchor_row").alias("row")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")) \
        .filter(F.col("n") >= positives).select("row", F.array("kth").alias("wanted"), F.col("kth").cast("double").alias("least"))
    others = searched(sent(anchors.join(kth, "row", "left"), cells, centres, home=False), positives, None)
    order = Window.partitionBy("anchor_row").orderBy(F.col("score").desc(), "vec_id", "row")
    found = kept(first.unionByName(others).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
                 .select("anchor_row", "anchor_id", F.col("row").alias("positive_row"), F.col("vec_id").alias("positive_id"),
                         F.col("score").alias("positive_score")), "positives")
    least, most = share
    wanted = found.filter(F.col("positive_score") >= 0).groupBy(F.col("anchor_row").alias("row")) \
        .agg(F.collect_set("positive_score").alias("wanted"), (F.min("positive_score") * (least / most)).alias("least"))
    candidates = searched(sent(anchors.join(wanted, "row"), cells, centres), negatives, share).select("anchor_row", F.col("row").alias("negative_row"),
                                                         F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    wide = {c: F.col(f"{c}_score").cast("decimal(38,0)") for c in ("positive", "negative")}
    fits = (wide["positive"] * least <= wide["negative"] * most) & (F.col("negative_score") <= F.col("positive_score"))
    order = Window.partitionBy("anchor_row", "positive_row").orderBy(F.col("negative_score").desc(), "negative_id", "negative_row")
    mined = found.join(candidates, "anchor_row").filter(fits).withColumn("rank", F.row_number().over(order)) \
        .filter(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    result = written(mined, "mined")
    for path in tables:
        removed(spark, path)
    return result
