"""Vector code compression: product codes by Lloyd rounds with Drake-Hamerly adaptive bounds.

A vector of whole numbers is cut into parts; each part position has its own codebook, and every round assigns each
part to its nearest entry and moves the entries to the floor of their parts' means. What a part knows of
its codebook is persisted between rounds (:data:`STATE`): its entry, an upper bound of the distance to it, the ``b``
next entries with ordered lower bounds of their distances, and one outer bound for all others. After a move the bounds
are widened by the distances that the entries moved. A part whose upper bound is below its first lower
bound keeps its entry unseen; otherwise the entries whose bounds are not above it are compared in whole
numbers, and all entries if the outer bound is not above it. The distances found so become the new bounds. ``b`` starts at
half the entries and falls to the number that, by what the parts of a round needed, costs least (:func:`next_width`).

A round is one pass over the written state, without a shuffle of vectors. Each task writes its rows' new state and, in
one more row, its sums; the sums are added up in a few tasks and reach the driver as ``SUMMING_TASKS`` tables.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import removed, stored, written

SUMMING_TASKS = 4
#: Numbers of all codebooks together; they go to every task.
MAX_NUMBERS = 1 << 24
STEP_ROWS = 4096
EXACT = float(1 << 53)
LONG_MAX = (1 << 63) - 1
STATE = "entry array<tinyint>, upper array<float>, near array<tinyint>, lower array<float>"


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, dim, v): floor(scale * x) of every component, as doubles; unusable vectors are left out."""
    x = F.col("embedding")
    usable = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(usable).select("vec_id", "label", F.size(x).alias("dim"), _floors(x, scale).alias("v"))


def _floors(x, scale: int):
    # Doubles from 2^53 on are whole; floor() would take them through a long.
    def whole(c):
        y = c.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return F.transform(x, whole)


def cuts(dim: int, parts: int) -> list[int]:
    """Borders of the parts: equal ones, or the first ones longer by one where the length does not divide."""
    size, more = divmod(dim, parts)
    return [p * size + min(p, more) for p in range(parts + 1)]


def down(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(np.inf))


class Codebook:
    """Entries of one part position, with exact squared distances."""

    def __init__(self, entries: list[list[int]], before: list[list[int]] | None = None):
        self.whole = entries
        self.k = len(entries)
        big = max((abs(c) for e in entries for c in e), default=0)
        self.big = float(min(big, 1 << 1000))
        with np.errstate(over="ignore"):
            self.entries = np.array([[float(c) for c in e] for e in entries]).reshape(self.k, len(entries[0]))
            self.norms = (self.entries ** 2).sum(1)
        moved = [sum((a - b) ** 2 for a, b in zip(e, f, strict=True)) for e, f in zip(entries, before or entries, strict=True)]
        self.moved = np.array([_root(m) for m in moved])

    def distances(self, x: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
        """Exact squared distances of the rows of x to all entries, or to the entries named for each row."""
        size = float(np.abs(x).max(initial=0)) + self.big
        if size * size * max(x.shape[1], 1) * 4 < EXACT:
            if which is None:
                return (x * x).sum(1)[:, None] - 2 * (x @ self.entries.T) + self.norms
            return ((x[:, None, :] - self.entries[which]) ** 2).sum(2)
        # Beyond the exact range of doubles: whole numbers of any size.
        whole = np.array([[int(c) for c in r] for r in x], dtype=object).reshape(x.shape)
        table = np.array(self.whole, dtype=object).reshape(self.entries.shape)
        chosen = table[None] if which is None else table[which]
        out = ((whole[:, None, :] - chosen) ** 2).sum(2) if x.shape[1] else np.zeros(chosen.shape[:2], int)
        return np.broadcast_to(out, (len(x), chosen.shape[1])).astype(object)


def _root(square: int) -> float:
    """Square root of a whole number, not below the true one by more than a rounding of doubles."""
    return math.sqrt(square) if square < 1 << 1000 else float(math.isqrt(square) + 1)


def roots(squares: np.ndarray) -> np.ndarray:
    if squares.dtype == object:
        return np.array([_root(int(s)) for s in squares.ravel()]).reshape(squares.shape)
    return np.sqrt(squares)


def by_distance(d: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Order of each row's entries by distance, ties by the lower index."""
    first = np.argsort(which, axis=1, kind="stable")
    then = np.argsort(np.take_along_axis(d, first, 1), axis=1, kind="stable")
    return np.take_along_axis(first, then, 1)


class Bounds:
    """Persisted knowledge of the parts at one position: entry, upper, near (n x b), lower (n x b + 1, the last outer)."""

    def __init__(self, book: Codebook, x: np.ndarray, entry, upper, near, lower):
        self.book, self.x = book, x
        self.entry, self.upper, self.near, self.lower = entry, upper, near, lower
        self.needed = np.zeros(len(x), np.int64)

    @classmethod
    def fresh(cls, book: Codebook, x: np.ndarray, b: int) -> Bounds:
        n = len(x)
        own = cls(book, x, np.zeros(n, np.int64), np.zeros(n, np.float32), np.zeros((n, b), np.int64),
                  np.zeros((n, b + 1), np.float32))
        own._compare_all(np.arange(n))
        return own

    def moved(self) -> None:
        """Widen the bounds by the entries' moves; keep the lower bounds in order."""
        m = self.book.moved
        self.upper = up(self.upper.astype(float) + m[self.entry])
        lower = self.lower.astype(float)
        lower[:, :-1] -= m[self.near]
        lower[:, -1] -= m.max(initial=0)
        self.lower = down(np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1])

    def assign(self) -> None:
        """Make ``entry`` the nearest entry (ties: the lower index), comparing only what the bounds leave open."""
        open_ = np.flatnonzero(self.upper >= self.lower[:, 0])
        if not len(open_):
            return
        own = self.book.distances(self.x[open_], self.entry[open_][:, None])[:, 0]
        self.upper[open_] = up(roots(own))
        open_ = open_[self.upper[open_] >= self.lower[open_, 0]]
        need = (self.lower[open_] <= self.upper[open_, None]).sum(1)
        self.needed[open_] = need
        b = self.near.shape[1]
        for z in np.unique(need).tolist():
            rows = open_[need == z]
            if z > b:
                self._compare_all(rows)
            else:
                self._compare(rows, z)

    def _compare(self, rows: np.ndarray, z: int) -> None:
        """Compare the own entry and the first z near ones; the rest keep their bounds."""
        which = np.column_stack([self.entry[rows], self.near[rows, :z]])
        d = self.book.distances(self.x[rows], which)
        order = by_distance(d, which)
        which, far = np.take_along_axis(which, order, 1), roots(np.take_along_axis(d, order, 1))
        self.entry[rows], self.upper[rows] = which[:, 0], up(far[:, 0])
        self.near[rows, :z] = which[:, 1:]
        lower = self.lower[rows]
        lower[:, :z] = down(far[:, 1:])
        self.lower[rows] = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]

    def _compare_all(self, rows: np.ndarray) -> None:
        d = self.book.distances(self.x[rows])
        order = by_distance(d, np.broadcast_to(np.arange(self.book.k), d.shape))
        far = roots(np.take_along_axis(d, order, 1))
        b = self.near.shape[1]
        self.entry[rows], self.upper[rows] = order[:, 0], up(far[:, 0])
        self.near[rows] = order[:, 1:b + 1]
        self.lower[rows, :b] = down(far[:, 1:b + 1])
        self.lower[rows, b] = down(far[:, b + 1]) if self.book.k > b + 1 else np.finfo(np.float32).max

    def narrowed(self, b: int) -> None:
        """Keep the b closest near entries; the first bound dropped becomes the outer one."""
        self.near, self.lower = self.near[:, :b], self.lower[:, :b + 1]

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """(count, componentwise sums) by entry, in whole numbers."""
        count = np.bincount(self.entry, minlength=self.book.k)
        if float(np.abs(self.x).max(initial=0)) * max(len(self.x), 1) < EXACT:
            own = (self.entry == np.arange(self.book.k)[:, None]).astype(float)
            return count, (own @ self.x).astype(np.int64).astype(object)
        total = np.zeros(self.book.entries.shape, dtype=object)
        for e, r in zip(self.entry.tolist(), self.x.tolist(), strict=True):
            total[e] += np.array([int(c) for c in r], dtype=object)
        return count, total


def lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    width = x.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * width + 1, width or 1, dtype=np.int32)[:len(x) + 1]
                                             if width else np.zeros(len(x) + 1, np.int32)), pa.array(x.ravel(), kind))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a batch of at most :data:`STEP_ROWS` rows whose vectors have one length."""
    dims = batch.column("dim").to_numpy(False)
    for dim in np.unique(dims).tolist():
        own = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
        for lo in range(0, own.num_rows, STEP_ROWS):
            yield dim, own.slice(lo, STEP_ROWS)


def matrix(part: pa.RecordBatch, name: str, kind=float) -> np.ndarray:
    flat = part.column(name).flatten().to_numpy(False).astype(kind)
    return flat.reshape(part.num_rows, -1) if part.num_rows and len(flat) else np.zeros((part.num_rows, 0), kind)


class Round:
    """One pass over the rows: new state and sums, or (last) codes and errors."""

    def __init__(self, books: dict[int, list[Codebook]], parts: int, b: int, width: int, first: bool, last: bool):
        self.books, self.parts, self.b, self.width, self.first, self.last = books, parts, b, width, first, last

    def bounds(self, part: pa.RecordBatch, x: np.ndarray, dim: int) -> list[Bounds]:
        borders = cuts(dim, self.parts)
        books = self.books[dim]
        k = books[0].k
        xs = [x[:, lo:hi] for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
        if self.first:
            return [Bounds.fresh(book, own, min(self.b, k - 1)) for book, own in zip(books, xs, strict=True)]
        entry, upper = matrix(part, "entry", np.int64), matrix(part, "upper", np.float32)
        near, lower = matrix(part, "near", np.int64), matrix(part, "lower", np.float32)
        held = near.shape[1] // self.parts
        out = []
        for p, (book, own) in enumerate(zip(books, xs, strict=True)):
            bounds = Bounds(book, own, entry[:, p].copy(), upper[:, p].copy(), near[:, p * held:(p + 1) * held].copy(),
                            lower[:, p * (held + 1):(p + 1) * (held + 1)].copy())
            bounds.narrowed(min(self.b, held))
            bounds.moved()
            bounds.assign()
            out.append(bounds)
        return out

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        needed = np.zeros(self.width + 2, np.int64)
        schema = None
        for batch in batches:
            schema = batch.schema
            for dim, part in by_length(batch):
                x = matrix(part, "v")
                found = self.bounds(part, x, dim)
                if self.last:
                    yield self._codes(part, found)
                    continue
                for p, bounds in enumerate(found):
                    needed += np.bincount(np.minimum(bounds.needed, self.width + 1), minlength=self.width + 2)
                    count, total = bounds.sums()
                    key = (dim, p)
                    sums[key] = (sums[key][0] + count, sums[key][1] + total) if key in sums else (count, total)
                yield self._state(part, found)
        if schema is not None and not self.last:
            yield self._sums(schema, sums, needed)

    def _state(self, part: pa.RecordBatch, found: list[Bounds]) -> pa.RecordBatch:
        kept = [part.column(c) for c in ("vec_id", "label", "dim", "v")]
        state = [lists(np.column_stack([f.entry for f in found]), pa.int8()),
                 lists(np.column_stack([f.upper for f in found]), pa.float32()),
                 lists(np.hstack([f.near for f in found]), pa.int8()), lists(np.hstack([f.lower for f in found]), pa.float32())]
        return pa.RecordBatch.from_arrays([*kept, *state, pa.nulls(part.num_rows, pa.binary())], names=STATE_NAMES)

    def _sums(self, schema: pa.Schema, sums: dict, needed: np.ndarray) -> pa.RecordBatch:
        kinds = [schema.field(c).type for c in STATE_NAMES[:4]]
        kinds += [pa.list_(pa.int8()), pa.list_(pa.float32()), pa.list_(pa.int8()), pa.list_(pa.float32())]
        return pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in kinds), pa.array([pickle.dumps((sums, needed))], pa.binary())],
                                          names=STATE_NAMES)

    def _codes(self, part: pa.RecordBatch, found: list[Bounds]) -> pa.RecordBatch:
        error = sum((f.book.distances(f.x, f.entry[:, None])[:, 0].astype(object) for f in found), np.zeros(part.num_rows, object))
        held = pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())
        code = lists(np.column_stack([f.entry for f in found]), pa.int8())
        return pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), part.column("dim"), code, held],
                                          names=["vec_id", "label", "dim", "code", "error"])


STATE_NAMES = ["vec_id", "label", "dim", "v", "entry", "upper", "near", "lower", "sums"]


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict = {}
    needed = 0
    for batch in batches:
        for value in batch.column("sums"):
            more, counts = pickle.loads(value.as_py())
            needed = needed + counts
            for key, (c, t) in more.items():
                sums[key] = (sums[key][0] + c, sums[key][1] + t) if key in sums else (c, t)
    yield pa.RecordBatch.from_pydict({"sums": pa.array([pickle.dumps((sums, needed))], pa.binary())})


class Codes:
    """Result of :func:`compress`: ``rows`` (vec_id, label, dim, code, error) and ``books`` (entries by length and part)."""

    def __init__(self, rows: DataFrame, books: dict[int, list[list[list[int]]]]):
        self.rows, self.books = rows, books

    def digest(self, dim: int) -> str:
        """SHA-256 of all entries' components by part, entry and place, joined by commas."""
        numbers = (str(c) for book in self.books[dim] for entry in book for c in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Codes:
    """Product codes of all usable rows of ``vectors`` (vec_id, embedding, label).

    Components become ``floor(scale * x)``. Codebooks start as the parts of the ``entries`` rows of smallest vec_id (null last,
    repeated ids by their vectors), fewer where there are fewer rows; unused entries stay. Vectors of different lengths have
    codebooks of their own; a length that ``parts`` does not divide is cut into parts that differ by one. Rows whose vector is
    null or holds null or non-finite components are left out; rows with null ids or labels and repeated rows
    are coded each. Errors are held within a long. An empty table gives no rows.
    """
    if not 1 <= entries <= 127:
        raise ValueError("a codebook holds 1 to 127 entries")
    spark = vectors.sparkSession
    base, path = stored(whole_numbers(vectors, scale), "whole")
    dims = [r["dim"] for r in base.select("dim").distinct().limit(MAX_NUMBERS).collect()]
    if sum(dims) * entries > MAX_NUMBERS:
        raise ValueError(f"codebooks of {len(dims)} vector lengths are too large to send to every task")
    books: dict[int, list[list[list[int]]]] = {}
    for dim in dims:
        first = base.filter(F.col("dim") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
        borders = cuts(dim, parts)
        books[dim] = [[[int(c) for c in r["v"][lo:hi]] for r in first] for lo, hi in zip(borders[:-1], borders[1:], strict=True)]
    id_type, label_type = (base.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    kept = f"vec_id {id_type}, label {label_type}, dim int, v array<double>"
    table, before = base, None
    b = width = max(entries // 2, 1)
    for r in range(rounds + 1):
        last = r == rounds
        old = before or books
        task = Round({d: [Codebook(e, o) for e, o in zip(books[d], old[d], strict=True)] for d in books}, parts, b, width,
                     first=r == 0, last=last)
        rows = table if r == 0 else table.filter(F.col("sums").isNull()).drop("sums")
        if last:
            coded = written(rows.mapInArrow(task, f"vec_id {id_type}, label {label_type}, dim int, code array<tinyint>, error long"), "codes")
            removed(spark, path)
            return Codes(coded, books)
        gone, before = path, books
        table, path = stored(rows.mapInArrow(task, f"{kept}, {STATE}, sums binary"), f"round{r + 1}")
        removed(spark, gone)
        tables = table.filter(F.col("sums").isNotNull()).select("sums").repartition(SUMMING_TASKS).mapInArrow(_added, "sums binary")
        total: dict = {}
        needed = np.zeros(width + 2, np.int64)
        for s in tables.collect():
            more, counts = pickle.loads(s["sums"])
            needed = needed + counts
            for key, (c, t) in more.items():
                total[key] = (total[key][0] + c, total[key][1] + t) if key in total else (c, t)
        books = {d: [[[int(s) // int(n) for s in t] if n else e for e, n, t in zip(book, *total[(d, p)], strict=True)]
                     for p, book in enumerate(books[d])] for d in books}
        b = next_width(needed, b, entries) if r else b
    raise AssertionError("unreachable")


def next_width(needed: np.ndarray, b: int, entries: int) -> int:
    """Bounds to keep in the next round, an eighth of the entries at least: those kept plus the entries that the parts
    needing more would compare are fewest."""
    least = min(max(entries // 8, 1), b)
    total = max(int(needed.sum()), 1)
    return min(range(least, b + 1), key=lambda c: c + entries * int(needed[c + 1:].sum()) / total)
