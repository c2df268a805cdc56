"""Shared helpers: intermediate tables, Arrow text access, word spans and hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

# Bytes of text that one vectorised step holds at a time; a single longer text is one step.
STEP_BYTES = 2 << 20
# The same for steps that hash words or take statistics: their arrays take up to 60 bytes for a byte of text.
HASH_STEP_BYTES = 512 << 10

# Rows that a window of a distributed prefix sum or rank sorts at a time (on average).
ROWS_PER_BUCKET = 20_000


def stored(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written as a Parquet table in the shared folder and read back, with the table's path."""
    spark = df.sparkSession
    ship_package(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Cuts lineage in a form that survives lost executors; the folder is the one the
    session names in ``spark.checkpoint.dir``.
    """
    return stored(df, tag)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`stored` that neither a later step nor a result reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def in_ranges(df: DataFrame, order: list[str], name: str, tag: str) -> DataFrame:
    """``df`` cut into ranges of a whole order, numbered by ``name`` from the lowest, and written.

    The range partitioning samples the whole order, so the ranges are even whatever value a leading column repeats.
    """
    return written(df.repartitionByRange(*order).withColumn(name, F.spark_partition_id()), tag)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_key(*parts: Column | str) -> Column:
    """52-bit seeded hash of the parts as a long; DuckDB can compute the same from md5."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p)
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def arrow_text(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without making Python strings; null is empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        values = values.fill_null("")
    wide = pa.types.is_large_string(values.type)
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[values.offset:values.offset + len(values) + 1].astype(np.int64)
    raw = values.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text_col: str, max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``max_bytes`` of text each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    col = batch.column(batch.schema.get_field_index(text_col))
    size = arrow_text(col)[1]
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + max_bytes, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
    give_back()


def give_back() -> None:
    """Return what a Python worker has freed to the system: an idle worker keeps it while later stages run beside it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(n: int) -> list[np.ndarray]:
    """[base**i, base**-i] modulo 2**64 for i < n (kept between calls)."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """Bit finaliser (a permutation of 64-bit values)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span values[start:end] (spans ascending, disjoint, not empty)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_table(len(values) + 1)
    terms = np.append(values * power[:len(values)], np.uint64(0))
    cuts = np.empty(2 * len(starts), np.int64)
    cuts[0::2], cuts[1::2] = starts, ends
    sums = np.add.reduceat(terms, cuts)[0::2]
    return mixed(sums * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of word bytes inside each row."""
    n = len(is_word)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], is_word[:-1]]) if n else is_word
    after = np.concatenate([is_word[1:], [False]]) if n else is_word
    starts = np.flatnonzero(is_word & (~before | first[:n]))
    ends = np.flatnonzero(is_word & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def byte_values(data: np.ndarray, lower: bool) -> np.ndarray:
    return (_LOWER if lower else _BYTE)[data]


def combined(parts: list[np.ndarray]) -> np.ndarray:
    """Order-sensitive hash of aligned 64-bit hashes."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = mixed(h * np.uint64(0x2545F4914F6CDD1D) + p + np.uint64(0x9E3779B9))
    return h


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags: True inside any of the inclusive byte ranges."""
    t = np.zeros(256, bool)
    for lo, hi in ranges:
        t[lo:hi + 1] = True
    return t


# Words between white space: [^\x20\x09-\x0D]+ over UTF-8 bytes.
BLANK_WORD = ~byte_class((0x20, 0x20), (0x09, 0x0D))
# Letters, digits and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
PLAIN_WORD = ~byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
