"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are put in a seeded random order inside their source; a row's fractional rank is its
rank divided by the source's row count. Sorted by fractional rank, sources interleave in
proportion, and equal cuts of that order give shards that all match the mixture, with row
counts at most one apart.

No source and no shard passes through one task: Spark's range partitioning cuts the sources'
whole order (so that one id with very many rows is cut as well) and the interleaved order is
cut into ranges of the fractional rank of about ``ROWS_PER_BUCKET`` rows; ranges are counted,
and rows are numbered inside their range. Only one row per range meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import ROWS_PER_BUCKET, in_ranges, shuffle_key, written

SEED = "shard-1"


def interleave(rows: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """Add ``shard`` (int, 0 to shards-1), ``slot`` (long, gapless from 0) and ``position`` to rows.

    ``rows`` has row (unique), doc_id, source, tie. A null source is a stratum of its own, rows of one id
    are ordered by ``tie``, a hash of their content (so reruns on other files or cores agree on contents), and equal ones
    by ``row``, with fewer rows than shards some shards stay empty, and an empty
    table gives no rows.
    """
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("source").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    strata = counts.withColumns({"_sr": F.row_number().over(Window.orderBy(F.col("_s").asc_nulls_last())),
                                 "_total": F.sum("_n").over(Window.partitionBy(F.lit(0)))})
    r = rows.join(strata, rows["source"].eqNullSafe(F.col("_s"))).drop("_s") \
        .withColumn("_h", shuffle_key(F.lit(seed), F.col("doc_id")))
    r = in_ranges(r, ["_sr", "_h", "doc_id", "tie", "row"], "_b", "ranges")
    ranges = r.groupBy("_sr", "_b").agg(F.count(F.lit(1)).alias("_c"))
    ranges = ranges.select("_sr", "_b", F.coalesce(F.sum("_c").over(
        before(Window.partitionBy("_sr").orderBy("_b"))), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_sr", "_b").orderBy("_h", "doc_id", "tie", "row")
    rank = F.col("_start") + F.row_number().over(inside) - 1
    r = r.join(ranges, ["_sr", "_b"]).withColumn("_f", (rank + 0.5) / F.col("_n")) \
        .withColumn("_fb", F.floor(F.col("_f") * F.ceil(F.col("_total") / ROWS_PER_BUCKET))).drop("_b", "_start")
    r = written(r, "ranked")
    cuts = r.groupBy("_fb").agg(F.count(F.lit(1)).alias("_c"))
    cuts = cuts.select("_fb", F.coalesce(F.sum("_c").over(before(Window.orderBy("_fb"))), F.lit(0)).alias("_start"))
    order = Window.partitionBy("_fb").orderBy("_f", "_sr")
    r = r.join(cuts, "_fb") \
        .withColumn("position", F.col("_start") + F.row_number().over(order) - 1) \
        .withColumn("shard", F.floor(F.col("position") * shards / F.col("_total")).cast("int"))
    # Whole-number form of the first position of a shard: the least p with p * shards >= shard * total.
    first = F.expr(f"(shard * _total + {shards - 1}L) div {shards}L")
    return r.withColumn("slot", F.col("position") - first) \
        .select(*rows.columns, "shard", "slot", "position")


def shard_documents(docs: DataFrame, shards: int = 16, seed: str = SEED) -> DataFrame:
    """Shard of every document row, by the law ``rows``.

    Returns doc_id, size (UTF-8 bytes + 1; null text has no bytes), text_crc32 (unsigned; 0 for null
    text), law, shard, slot, grown_shard (null) and source.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(body).cast("long") + 1).alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).cast("long").alias("text_crc32"), F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    return interleave(written(rows, "rows"), shards, seed) \
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"), "source")


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: str = SEED) -> None:
    """Write the documents themselves as one folder per shard, in slot order inside it.

    A shard is written by as many tasks as its slot ranges need, so shards may be large. Columns of the
    documents called shard or slot are replaced.
    """
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = written(docs.select(*keep, F.monotonically_increasing_id().alias("_shard_row")), "rows")
    placed = interleave(rows.select(F.col("_shard_row").alias("row"), "doc_id", "source", F.xxhash64("text").alias("tie")), shards, seed) \
        .select(F.col("row").alias("_shard_row"), "shard", "slot")
    rows.join(placed, "_shard_row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .select(*keep, "shard", "slot").write.partitionBy("shard").parquet(path)
