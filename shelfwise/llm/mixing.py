"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a seeded random order, epoch after epoch. A copy's
virtual finish time is the number of its source's tokens up to and including the copy,
divided by the source's target; copies of all sources are served in order of finish time
until the total budget is spent. At finish time 1 each source has its target, so the
served prefix keeps every source near it.

Cumulative sums never gather a source in one task: Spark's range partitioning cuts the
queues by their whole order, so that neither a large source nor one id with very many rows
fills a range; ranges are summed first and rows are then summed inside their range. The
global order is cut into ranges of finish time of about ``ROWS_PER_BUCKET`` rows, and rows
are sorted and summed inside their range. Only one row per range meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import ROWS_PER_BUCKET, in_ranges, shuffle_key, written

SEED = "mix-1"
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: str = "text"):
    """Words between white space; null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """(source, source_rank, n, source_size, target): water-filled shares of the total size.

    ``target = min(max_repeats * source_size, level * weight)`` with the level at which the
    targets add up to the total: the fixed point of cutting targets at their cap and sharing
    the excess by weight. One row per source; all terms of the level are whole numbers.
    """
    s = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    one = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    s = s.withColumn("source_rank", F.row_number().over(one) - 1)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    s = s.withColumns({"w": w, "cap": F.col("source_size") * max_repeats})
    # Sources in the order in which a rising level reaches their caps.
    rising = Window.orderBy(F.col("cap") / F.col("w"), "source_rank")
    upto = rising.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"full": F.coalesce(F.sum("cap").over(upto), F.lit(0)),
                       "gone": F.coalesce(F.sum("w").over(upto), F.lit(0)),
                       "total": F.sum("source_size").over(everything), "all_w": F.sum("w").over(everything)})
    # The level if exactly the sources before this one are at their caps; right where it meets the own cap first.
    s = s.withColumn("own", (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("gone")))
    s = s.withColumn("level", F.min(F.when(F.col("own") * F.col("w") <= F.col("cap"), F.struct(
        F.row_number().over(rising).alias("k"), F.col("own").alias("x")))).over(everything)["x"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")))
    return s.select("source", "source_rank", "n", "source_size", target.alias("target"), "total",
                    F.sum("n").over(everything).alias("all_rows"))


def mix(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: str = SEED) -> DataFrame:
    """Mix rows (row, doc_id, source, size, tie) and say how much of each the mix takes.

    ``row`` identifies a row, so repeated rows and ids are mixed row by row. Rows of one id are queued by ``tie``, a hash of
    their content, so that reruns on other files or cores choose the same contents; only equal contents are told
    apart by ``row``. Returns the rows
    with ``source_size``, ``target`` (double), ``copies`` and ``taken`` (long, copies * size).
    A null source is a source of its own, null ids hash like empty text, rows of size 0 use no
    budget and are taken once, and an empty table gives no rows.
    """
    targets = written(source_targets(sizes, weights, max_repeats), "targets")
    src = targets.withColumnRenamed("source", "t_source")
    rows = sizes.join(src, sizes["source"].eqNullSafe(src["t_source"])).drop("t_source")
    copies = rows.filter("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))) \
        .withColumn("h", shuffle_key(F.lit(seed), F.col("epoch"), F.col("doc_id")))
    # Ranges of the seeded order: a partition holds neighbours of the queues.
    order = ["epoch", "h", "doc_id", "tie", "row"]
    copies = in_ranges(copies.select("source_rank", *order, "size", "target", "total", "all_rows"), ["source_rank", *order], "b", "copies")
    part = ["source_rank", "b"]
    before = Window.partitionBy("source_rank").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = copies.groupBy(*part).agg(F.sum("size").alias("range_size")) \
        .select(*part, F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    finish = F.coalesce((F.col("range_start") + F.sum("size").over(inside)) / F.col("target"), F.lit(0.0))
    # Ranges of finish time over the whole queue; time 1 is where every source has its target.
    ranges_to_one = F.ceil(F.col("all_rows") * max_repeats / ROWS_PER_BUCKET)
    queue = copies.join(starts, part).withColumn("finish", finish).withColumn("t", F.floor(ranges_to_one * F.when(
        F.col("finish") < 1, F.col("finish")).otherwise(1 + F.ln("finish"))))
    queue = written(queue.select("source_rank", *order, "total", "size", "finish", "t"), "queue")
    served = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    ranges = queue.groupBy("t").agg(F.sum("size").alias("t_size")) \
        .select("t", F.coalesce(F.sum("t_size").over(served), F.lit(0)).alias("t_start"))
    in_order = Window.partitionBy("t").orderBy("finish", "source_rank", *order).rowsBetween(Window.unboundedPreceding, 0)
    taken = queue.join(ranges, "t") \
        .withColumn("served", F.col("t_start") + F.sum("size").over(in_order) <= F.col("total")) \
        .groupBy("row").agg(F.count_if("served").alias("served"))
    copies_of = F.when(F.col("size") == 0, 1).otherwise(F.coalesce(F.col("served"), F.lit(0)))
    return rows.join(taken, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", copies_of.cast("long").alias("copies"),
        (copies_of * F.col("size")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: str = SEED) -> DataFrame:
    """The mix decision of every document row (see :func:`mix`); sizes are word counts."""
    sizes = docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("tie"),
                        F.monotonically_increasing_id().alias("row"))
    return mix(written(sizes, "sizes"), weights, max_repeats, seed)


def mixed_rows(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: str = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it.

    Rows are numbered once, in a written table, and the plan meets them by that number: no key of the documents is joined,
    so rows of one id or equal rows never gather. Rows of equal (doc_id, source, text) are interchangeable.
    """
    at = "_mix_row"
    while at in docs.columns:
        at += "_"
    rows = written(docs.withColumn(at, F.monotonically_increasing_id()), "rows")
    sizes = written(rows.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("tie"),
                                F.col(at).alias("row")), "sizes")
    plan = mix(sizes, weights, max_repeats, seed).filter("copies > 0").select("row", "copies")
    kept = rows.join(plan, rows[at] == plan["row"])
    times = F.sequence(F.lit(1), plan["copies"].cast("int"))
    return kept.select(*[rows[c] for c in docs.columns], F.explode(times).alias(at)).drop(at)
