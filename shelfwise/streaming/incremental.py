"""Incremental drop ingestion with late duplicates resolved.

Two Structured Streaming forms:

* ``first_arrivals`` keeps the *first* arrival of a key over all drops. Its state holds the keys
  of the last ``delay`` of event time only (``dropDuplicatesWithinWatermark``), in RocksDB, so that it is bounded by the delay
  and not by executor memory. Copies may come late by up to the delay; a row that comes later than that cannot be told from a new
  one, is left out and counted.
* ``keep_best_incremental`` keeps the *best* row per key (D1 semantics) over all drops.

The keep-best table is bucketed by key. A micro-batch reads, merges and rewrites only the buckets that its keys
fall into, as new files of its own epoch; a manifest then says for every bucket which epoch's files are current.
Writing the manifest is the publication: readers follow the newest complete one. An epoch starts from the newest
manifest *before* it and is skipped if its own manifest is complete, so replaying any epoch, finished or
not, leaves rows and counts as they were. Files that neither of the two newest manifests names are removed.

The stream checkpoint lives inside the table, since its epoch numbers are the table's versions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_best

BUCKETS = 64


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "1 day") -> DataFrame:
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


@dataclass
class Arrivals:
    """What a run of :func:`first_arrivals` leaves: the table's rows, the keys held in state, and the rows that came too late."""

    rows: DataFrame
    keys_held: int
    too_late: int


def first_arrivals(stream: DataFrame, keys: Sequence[str], event_time: str, root: str, delay: str = "1 day") -> Arrivals:
    """Run all files that the stream has not seen yet into the first-arrival table at ``root``.

    Every micro-batch writes its own folder, over what a killed try of it left, so a restart from the checkpoint neither loses nor
    repeats rows. Copies of a key within one micro-batch are equal rights: one of them is kept.
    """
    spark = stream.sparkSession
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKSDB)

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/epoch={epoch}")

    try:
        query = dedup_within_watermark(stream, keys, event_time, delay).writeStream.foreachBatch(publish) \
            .option("checkpointLocation", f"{root}/stream").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    held = states[-1]["numRowsTotal"] if states else 0
    table = spark.read.schema(stream.schema).parquet(f"{root}/rows/epoch=*")
    return Arrivals(table, held, sum(s["numRowsDroppedByWatermark"] for s in states))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _epochs(spark: SparkSession, root: str) -> list[int]:
    """Published epochs, ascending: those with a complete manifest."""
    fs, p = _fs(spark, f"{root}/manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [n for n in names if n.startswith("epoch=") and fs.exists(_fs(spark, f"{root}/manifest/{n}/_SUCCESS")[1])]
    return sorted(int(n.removeprefix("epoch=")) for n in done)


def _manifest(spark: SparkSession, root: str, epoch: int) -> dict[int, int]:
    """Bucket -> epoch whose files hold it (one row per bucket, so bounded by the bucket count)."""
    rows = spark.read.schema("bucket int, written_by long").parquet(f"{root}/manifest/epoch={epoch}").collect()
    return {r["bucket"]: r["written_by"] for r in rows}


def _bucket_paths(root: str, where: dict[int, int]) -> list[str]:
    return [f"{root}/data/epoch={e}/bucket={b}" for b, e in sorted(where.items())]


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The current rows of a keep-best table, or None before its first epoch."""
    epochs = _epochs(spark, root)
    if not epochs:
        return None
    where = _manifest(spark, root, epochs[-1])
    schema = spark.read.parquet(f"{root}/schema").schema
    return spark.read.schema(schema).parquet(*_bucket_paths(root, where)) if where else spark.createDataFrame([], schema)


def merge_epoch(batch: DataFrame, epoch: int, keys: Sequence[str], prefer, root: str, buckets: int = BUCKETS) -> None:
    """Merge one drop into the table as version ``epoch``; replaying a published epoch changes nothing."""
    spark = batch.sparkSession
    epochs = _epochs(spark, root)
    if epoch in epochs:
        return
    before = [e for e in epochs if e < epoch]
    where = _manifest(spark, root, before[-1]) if before else {}
    counted = "dup_group_size"
    incoming = batch.withColumn(counted, F.lit(1).cast("bigint"))
    if not before:
        incoming.limit(0).write.mode("overwrite").parquet(f"{root}/schema")
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias("bucket")
    touched = {r["bucket"] for r in batch.select(bucket).distinct().collect()}
    old = _bucket_paths(root, {b: e for b, e in where.items() if b in touched})
    rows = incoming.unionByName(spark.read.schema(incoming.schema).parquet(*old)) if old else incoming
    sizes = rows.groupBy(*keys).agg(F.sum(counted).alias(counted))
    best = keep_best(rows.drop(counted), keys, prefer, count_col=None)
    on = [best[k].eqNullSafe(sizes[k]) for k in keys]
    out = best.join(sizes, on).select(*[best[c] for c in best.columns], sizes[counted])
    out.select(*incoming.columns, bucket).repartition(len(touched) or 1, "bucket") \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/epoch={epoch}")
    where |= dict.fromkeys(touched, epoch)
    spark.createDataFrame(sorted(where.items()), "bucket int, written_by long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/manifest/epoch={epoch}")
    _remove_unnamed(spark, root, keep=2)


def _remove_unnamed(spark: SparkSession, root: str, keep: int) -> None:
    """Delete bucket files that none of the ``keep`` newest manifests names (older manifests stay as the record)."""
    epochs = _epochs(spark, root)
    named = {p for e in epochs[-keep:] for p in _bucket_paths("", _manifest(spark, root, e))}
    for e in epochs[:-1]:
        fs, p = _fs(spark, f"{root}/data/epoch={e}")
        if not fs.exists(p):
            continue
        for s in fs.listStatus(p):
            name = s.getPath().getName()
            if name.startswith("bucket=") and f"/data/epoch={e}/{name}" not in named:
                fs.delete(s.getPath(), True)


def keep_best_incremental(stream: DataFrame, keys: Sequence[str], prefer, root: str,
                          buckets: int = BUCKETS, available_now: bool = True) -> DataFrame | None:
    """Run the stream into the keep-best table at ``root`` and return the table's rows.

    Raises if the table has versions but its stream checkpoint is gone: a fresh checkpoint would number its epochs
    from 0 again and count all drops twice.
    """
    spark = stream.sparkSession
    checkpoint = f"{root}/stream"
    fs, offsets = _fs(spark, f"{checkpoint}/offsets")
    if _epochs(spark, root) and not fs.exists(offsets):
        raise ValueError(f"{root} has published versions but no stream checkpoint; restore it or start a new table")

    def merge(batch: DataFrame, epoch: int) -> None:
        merge_epoch(batch, epoch, keys, prefer, root, buckets)

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    (w.trigger(availableNow=True) if available_now else w).start().awaitTermination()
    return read_table(spark, root)
