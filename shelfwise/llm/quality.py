"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

A document becomes a short vector of statistics of its whole text (:data:`STATISTICS`). Random Fourier
features approximate a Gaussian kernel over the standardised vectors. Ridge weights come from the normal
equations, summed per partition in numpy and then over a few tasks, so the driver receives
``SUMMING_TASKS`` matrices whatever the input's size. The raw score is made a probability by isotonic
regression over its values on the training rows, counted on a fixed grid.

Training uses all labelled training rows up to ``max_fit_rows`` (chosen by a hash beyond that).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import BLANK_WORD, HASH_STEP_BYTES, arrow_text, byte_class, byte_values, mixed, span_hashes, steps, word_spans, written

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "upper", "lower", "digit", "blank", "newline", "period", "comma", "shout",
    "symbol", "pipe", "beyond_ascii", "control", "word_length", "words_capital", "words_marked", "words_repeated",
    "words_distinct", "lines_repeated", "words_a_line", "periods_a_word",
)
_SETS = {
    "upper": byte_class((65, 90)), "lower": byte_class((97, 122)), "digit": byte_class((48, 57)),
    "blank": byte_class((32, 32), (9, 9)), "newline": byte_class((10, 10), (13, 13)), "period": byte_class((46, 46)),
    "comma": byte_class((44, 44), (58, 59)), "shout": byte_class((33, 33), (63, 63)),
    "symbol": byte_class((35, 38), (42, 43), (60, 62), (64, 64), (92, 92), (94, 96), (126, 126)),
    "pipe": byte_class((123, 125)), "beyond_ascii": byte_class((128, 255)), "control": byte_class((0, 8), (11, 12), (14, 31), (127, 127)),
}
_MARK = _SETS["symbol"] | _SETS["shout"] | _SETS["pipe"]
_NOT_NEWLINE = ~byte_class((10, 10))
SUMMING_TASKS = 4
GRID = 2000


def statistics(text: pa.Array) -> np.ndarray:
    """One row of :data:`STATISTICS` per text; null and empty texts give zeros."""
    data, offsets = arrow_text(text)
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    # Capital letters of two bytes (U+00C0 to U+00DE) count as capitals too.
    wide_capital = np.zeros(len(data), bool)
    wide_capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    count = {k: total(t[data]) for k, t in _SETS.items()}
    count["upper"] += total(wide_capital)
    starts, ends, row = word_spans(BLANK_WORD[data], offsets)
    words = np.bincount(row, minlength=n).astype(float)
    capital = (_SETS["upper"][data] | wide_capital)
    h = span_hashes(byte_values(data, lower=False), starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    last = data[ends - 1] if len(ends) else data[:0]
    second = starts + 1
    shouted = capital[np.minimum(second, max(len(data) - 1, 0))] & (ends - starts > 2) if len(starts) else again
    line_starts, line_ends, line_row = word_spans(_NOT_NEWLINE[data], offsets)
    lines = np.bincount(line_row, minlength=n).astype(float)
    line_hash = span_hashes(byte_values(data, lower=False), line_starts, line_ends)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        keyed = np.sort(mixed(hashes ^ (of.astype(np.uint64) << np.uint64(40))) >> np.uint64(20)
                        | (of.astype(np.uint64) << np.uint64(44)))
        new = np.ones(len(keyed), bool)
        new[1:] = keyed[1:] != keyed[:-1]
        return np.bincount((keyed[new] >> np.uint64(44)).astype(np.int64), minlength=n).astype(float)

    share = lambda a, b: a / np.maximum(b, 1)
    per_word = lambda flags: share(np.bincount(row[flags], minlength=n).astype(float), words)
    out = {k: share(v, size) for k, v in count.items()}
    out |= {
        "log_bytes": np.log1p(size), "log_words": np.log1p(words), "log_lines": np.log1p(lines),
        "word_length": share(np.bincount(row, ends - starts, minlength=n), words),
        "words_capital": per_word(shouted), "words_marked": per_word(_MARK[last]), "words_repeated": per_word(again),
        "words_distinct": share(distinct(h, row), words) * (words > 0),
        "lines_repeated": share(lines - distinct(line_hash, line_row), lines),
        "words_a_line": np.log1p(share(words, lines)), "periods_a_word": share(count["period"], words),
    }
    return np.column_stack([out[k] for k in STATISTICS]) if n else np.zeros((0, len(STATISTICS)))


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats array<double>) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", HASH_STEP_BYTES):
                x = statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(x)], names=["doc_id", "stats"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(False).reshape(-1, len(STATISTICS))


@dataclass
class Model:
    """Everything a task needs to score; its size depends on the feature count only."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit (pool adjacent violators)."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(values, weights, strict=True):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, k2 = blocks.pop()
            v1, w1, k1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2])
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks]) if blocks else np.zeros(0)


def is_held_out(doc_id: str = "doc_id"):
    """Rows whose crc32 of the id as text is divisible by 5 (a null id counts as empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def fit(stats: DataFrame, labels: DataFrame, max_fit_rows: int = 400_000, waves: int = 384, ridge: float = 1e-6,
        bandwidth: float = 0.1, seed: int = 11) -> Model:
    """Train on the rows of ``stats`` that are not held out and have a label 0 or 1.

    ``max_fit_rows`` bounds the training rows; beyond it a hash of the id chooses them. Without any label the score
    of every document is 0.5.
    """
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("double").alias("y"))
    train = stats.filter(~is_held_out()).join(known, "doc_id").select("doc_id", "stats", "y")
    train = written(train, "train")
    n = train.count()
    if n > max_fit_rows:
        span = 1 << 40
        train = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(span * max_fit_rows / n))
    k = len(STATISTICS)
    moments = stats.select(*[f(F.col("stats")[i]).alias(f"{name}{i}") for i in range(k)
                             for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(k)])
    rng = np.random.Generator(np.random.PCG64(seed))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0.0, bandwidth, (k, waves)),
                  rng.uniform(0.0, 2 * np.pi, waves), np.zeros(waves + 1), np.array([0.0]), np.array([0.5]))
    d = waves + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 2))
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                z = model.features(_matrix(part.column("stats")))
                y = part.column("y").to_numpy(False)
                total[:, :d] += z.T @ z
                total[:, d] += z.T @ y
                total[0, d + 1] += len(y)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d * (d + 2))
        for batch in batches:
            for value in batch.column("sums"):
                total += np.frombuffer(value.as_buffer())
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = train.mapInArrow(partial, "sums binary").repartition(SUMMING_TASKS).mapInArrow(summed, "sums binary")
    total = sum((np.frombuffer(r["sums"]).reshape(d, d + 2) for r in parts.collect()), np.zeros((d, d + 2)))
    rows = total[0, d + 1]
    if not rows:
        return model
    model.weights = np.linalg.solve(total[:, :d] + ridge * rows * np.eye(d), total[:, d])

    def gridded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column("stats"))), -1.0, 2.0)
            cell = np.floor((raw + 1.0) / 3.0 * (GRID - 1)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"cell": cell, "raw": raw, "y": batch.column("y")})

    cells = train.mapInArrow(gridded, "cell long, raw double, y double").groupBy("cell") \
        .agg(F.count(F.lit(1)).alias("n"), F.avg("raw").alias("raw"), F.avg("y").alias("y")).orderBy("cell").collect()
    fitted = isotonic(np.array([c["y"] for c in cells]), np.array([c["n"] for c in cells], float))
    raw = np.array([c["raw"] for c in cells])
    # One knot in the middle of each level, so that scores between levels keep the raw order.
    new = np.flatnonzero(np.diff(fitted, prepend=-1.0))
    upto = np.append(new[1:], len(fitted))
    weight = np.array([c["n"] for c in cells], float)
    model.knots = np.array([np.average(raw[a:b], weights=weight[a:b]) for a, b in zip(new, upto, strict=True)])
    model.levels = fitted[new]
    return model


def score(stats: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of :func:`document_statistics`."""
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": model.score(_matrix(batch.column("stats")))})

    return stats.mapInArrow(run, f"doc_id {id_type}, score double") \
        .select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit_options) -> DataFrame:
    """Quality score of every document row, learnt from labels (doc_id, quality) outside the held-out fold.

    Empty and null texts are scored like any other; repeated rows are scored each; columns other than
    doc_id and text are never read; an empty table gives no rows.
    """
    stats = written(document_statistics(docs), "stats")
    return score(stats, fit(stats, labels, **fit_options), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit_options) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    model = fit(written(document_statistics(docs), "stats"), labels, **fit_options)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", HASH_STEP_BYTES):
                yield part.filter(pa.array(model.score(statistics(part.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
