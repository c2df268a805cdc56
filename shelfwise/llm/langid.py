"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text becomes symbols: its letters (Unicode category L) in lower case, every run of other characters one
separator, one separator at each end. The n-grams of 1 to 4 symbols inside a text, other than the lone separator, are hashed
into ``bins``. Training counts n-grams per language over all training rows (summed by Spark per language and bin);
the log-probability matrix, ``languages x bins`` numbers, goes to every task. A batch is scored
as a sparse matrix of (row, bin) entries times that matrix: entries are gathered and added up by row.

Texts longer than one step are read in windows that carry the last symbols over, so memory does not grow with a text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import STEP_BYTES, arrow_text, steps

ORDERS = (1, 2, 3, 4)
BINS = 1 << 16
#: More languages than this raise: the matrix would pass 256 MB.
MAX_LANGUAGES = 500
#: Counts of at most so many languages are held by a task at a time.
HELD_LANGUAGES = 64
SEPARATOR = 0
_UNKNOWN = -2
_OTHER = -1
_MULTIPLIER = 0x9E3779B1


class Alphabet:
    """Lower-cased letter of every code point (:data:`_OTHER` for what is no letter), filled as code points are met."""

    def __init__(self):
        self.of = np.full(0x110000, _UNKNOWN, np.int32)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        letters = self.of[codes]
        new = letters == _UNKNOWN
        if new.any():
            for c in np.unique(codes[new]).tolist():
                char = chr(c)
                low = char.lower()
                self.of[c] = _OTHER if unicodedata.category(char)[0] != "L" else ord(low) if len(low) == 1 else c
            letters = self.of[codes]
        return letters


_alphabet: Alphabet | None = None


def alphabet() -> Alphabet:
    global _alphabet
    if _alphabet is None:
        _alphabet = Alphabet()
    return _alphabet


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets by row) of UTF-8 bytes; ill-formed sequences give some code point that is no letter."""
    lead = (data & 0xC0) != 0x80
    lead[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(lead)
    first = data[at].astype(np.int32)
    size = np.diff(np.append(at, len(data)))
    codes = np.where(first < 0x80, first, 0xFFFF)
    for n, low, high, mask in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0xF8, 0x07)):
        k = np.flatnonzero((first >= low) & (first < high) & (size == n))
        if len(k):
            value = first[k] & mask
            for i in range(1, n):
                value = value << 6 | (data[at[k] + i] & 0x3F)
            codes[k] = np.where(value < 0x110000, value, 0xFFFF)
    return codes, np.searchsorted(at, offsets)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, offsets by row, has a letter by row): letters, runs of anything else as one separator, one at each end."""
    codes, cuts = code_points(data, offsets)
    letters = alphabet()(codes)
    n = len(cuts) - 1
    # Every row gets a separator before it and one behind it; repeated separators inside a row go.
    out = np.full(len(letters) + 2 * n, _OTHER, np.int32)
    shift = np.repeat(np.arange(n) * 2 + 1, np.diff(cuts))
    out[np.arange(len(letters)) + shift] = letters
    bounds = cuts + 2 * np.arange(n + 1)
    first = np.zeros(len(out) + 1, bool)
    first[bounds] = True
    blank = out == _OTHER
    again = np.zeros(len(out), bool)
    again[1:] = blank[1:] & blank[:-1] & ~first[1:-1]
    out[blank] = SEPARATOR
    keep = ~again
    kept = np.concatenate([[0], np.cumsum(keep)])
    rows = kept[bounds]
    lettered = np.zeros(n, bool)
    if n:
        seen = np.concatenate([[0], np.cumsum(~blank)])[bounds]
        lettered = seen[1:] > seen[:-1]
    return out[keep], rows, lettered


def hashed(grams: list[np.ndarray], order: int, bins: int) -> np.ndarray:
    """Bin of each n-gram, given as one array of symbols per position."""
    h = np.full(len(grams[0]), order, np.uint32)
    with np.errstate(over="ignore"):
        for g in grams:
            h = (h ^ g.astype(np.uint32)) * np.uint32(_MULTIPLIER)
            h ^= h >> np.uint32(15)
    return (h % np.uint32(bins)).astype(np.int64)


def gram_bins(text: np.ndarray, rows: np.ndarray, bins: int, carried: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bins, offsets by row) of each order; n-grams that end among the first ``carried`` symbols are left out."""
    size = np.diff(rows)
    for n in ORDERS:
        count = np.maximum(size - n + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(count)])
        at = np.arange(offsets[-1]) + np.repeat(rows[:-1] - offsets[:-1], count)
        if carried:
            at = at[at + n > carried]
            offsets = np.array([0, len(at)])
        if n == 1:
            lone = text[at] == SEPARATOR
            kept = np.concatenate([[0], np.cumsum(~lone)])
            at, offsets = at[~lone], kept[offsets]
        yield hashed([text[at + i] for i in range(n)], n, bins), offsets


def windows(data: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """(symbols, carried) of one long text in windows of about ``width`` bytes."""
    lo, tail = 0, np.zeros(0, np.int32)
    keep = max(ORDERS) - 1
    while lo < len(data):
        hi = min(lo + width, len(data))
        while hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi += 1
        part, _, _ = symbols(data[lo:hi], np.array([0, hi - lo]))
        # A separator at the end of a window belongs to the text only where no letter stands there.
        inner = _window_inner(data[lo:hi], part, first=lo == 0, last=hi == len(data))
        if len(tail) and len(inner) and tail[-1] == SEPARATOR and inner[0] == SEPARATOR:
            inner = inner[1:]
        yield np.concatenate([tail, inner]), len(tail)
        tail = np.concatenate([tail, inner])[-keep:]
        lo = hi


def _window_inner(data: np.ndarray, part: np.ndarray, first: bool, last: bool) -> np.ndarray:
    codes, _ = code_points(data, np.array([0, len(data)]))
    ends = alphabet()(codes[[0, -1]])
    if not first and ends[0] != _OTHER:
        part = part[1:]
    if not last and ends[1] != _OTHER:
        part = part[:-1]
    return part


@dataclass
class Model:
    """Languages in code point order with log priors and the log-probability matrix (languages x bins)."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray

    def scores(self, text: pa.Array, step: int = STEP_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """(log joint probability by row and language, has a letter by row)."""
        data, offsets = arrow_text(text)
        total = np.tile(self.prior, (len(offsets) - 1, 1))
        if len(offsets) == 2 and len(data) > 2 * step:
            lettered = np.zeros(1, bool)
            for part, carried in windows(data, step):
                self._add(total, part, np.array([0, len(part)]), carried)
                lettered |= (part != SEPARATOR).any()
            return total, lettered
        text_symbols, rows, lettered = symbols(data, offsets)
        self._add(total, text_symbols, rows)
        return total, lettered

    def _add(self, total: np.ndarray, text: np.ndarray, rows: np.ndarray, carried: int = 0) -> None:
        bins = self.table.shape[1]
        for entries, offsets in gram_bins(text, rows, bins, carried):
            some = np.flatnonzero(np.diff(offsets))
            if len(some):
                for k, logs in enumerate(self.table):
                    total[some, k] += np.add.reduceat(logs[entries], offsets[some])


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves 1 when divided by 3 (a null id counts as empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def _counted(bins: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()),
                                                  "bin": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})
            held.clear()

        for batch in batches:
            for part in steps(batch, "text", step):
                lang = part.column("lang").dictionary_encode()
                of = lang.indices.to_numpy(False)
                order = np.argsort(of, kind="stable")
                of = of[order]
                data, offsets = arrow_text(part.column("text").take(pa.array(order)))
                long = len(offsets) == 2 and len(data) > 2 * step
                pieces = windows(data, step) if long else [(symbols(data, offsets), 0)]
                for piece, carried in pieces:
                    text, rows = (piece, np.array([0, len(piece)])) if long else piece[:2]
                    for entries, cuts in gram_bins(text, rows, bins, carried):
                        for k, name in enumerate(lang.dictionary.to_pylist()):
                            lo, hi = np.searchsorted(of, [k, k + 1])
                            own = entries[cuts[lo]:cuts[hi]]
                            if name not in held:
                                if len(held) == HELD_LANGUAGES:
                                    yield from flushed()
                                held[name] = np.zeros(bins, np.int64)
                            held[name] += np.bincount(own, minlength=bins)
        yield from flushed()

    return run


def fit(docs: DataFrame, smoothing: float = 0.1, bins: int = BINS, step: int = STEP_BYTES) -> Model:
    """Train on all rows of ``docs`` (text, lang) with a language; every whole text counts.

    Sums are made by Spark; the driver receives one row per language and bin. More than :data:`MAX_LANGUAGES`
    languages raise ValueError.
    """
    known = docs.filter(F.col("lang").isNotNull()).select("lang", "text")
    priors = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(priors) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in priors)
    n = {r["lang"]: r["n"] for r in priors}
    prior = np.log(np.array([n[x] for x in languages], float) / max(sum(n.values()), 1)) if languages else np.zeros(0)
    place = {x: k for k, x in enumerate(languages)}
    counts = np.zeros((len(languages), bins))
    if languages:
        sums = known.mapInArrow(_counted(bins, step), "lang string, bin int, n long") \
            .groupBy("lang", "bin").agg(F.sum("n").alias("n"))
        # One row of sums per language: (bins, counts) as binary, so that the driver gets few, bounded rows.
        packed = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("c")) \
            .select("lang", F.col("c.bin").alias("bin"), F.col("c.n").alias("n"))
        for r in packed.toLocalIterator():
            counts[place[r["lang"]], r["bin"]] = r["n"]
    table = np.log(counts + smoothing) - np.log(counts.sum(1, keepdims=True) + smoothing * bins)
    return Model(languages, prior, table)


def predict(docs: DataFrame, model: Model, undetermined: str = "und", step: int = STEP_BYTES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text).

    ``score`` is the posterior probability of the predicted language; ties go to the smaller code. Texts that are
    null or hold no letter, and all texts of a model without languages, get ``undetermined`` with score 0.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    languages = pa.array([*model.languages, undetermined], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text", step):
                n = part.num_rows
                best, sure = np.full(n, len(model.languages)), np.zeros(n)
                if model.languages:
                    logs, lettered = model.scores(part.column("text"), step)
                    top = logs.argmax(1)
                    shares = 1 / np.exp(logs - logs[np.arange(n), top][:, None]).sum(1)
                    best, sure = np.where(lettered, top, best), np.where(lettered, shares, 0.0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), languages.take(pa.array(best)), pa.array(sure)],
                                                 names=["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, smoothing: float = 0.1, bins: int = BINS) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, lang), learnt from the rows that are not held out.

    Reads doc_id, text and lang only; repeated rows are rows of their own; a null or empty text is ``und``; an
    empty table gives no rows.
    """
    return predict(docs, fit(docs.filter(~is_held_out()), smoothing, bins))
