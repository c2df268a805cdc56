"""Ranking and latest-period helpers.

``global_dense_rank`` ranks rows by a value over the *whole* frame without a
``Window.orderBy`` on an unpartitioned window (which moves every row into one
task).  Distinct rank keys are range-partitioned, numbered inside each range
partition, and shifted by the row counts of the preceding partitions (one row
per partition, so the offset table is bounded by the partition count).  The
numbered keys are checkpointed to the shared checkpoint folder so the two
branches read one consistent range partitioning, then joined back on the key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _order(spec: Sequence[tuple[str, str]]) -> list[Column]:
    out = []
    for c, d in spec:
        col = F.col(c)
        out.append(col.desc_nulls_last() if d == "desc" else col.asc_nulls_last())
    return out


def global_dense_rank(df: DataFrame, order: Sequence[tuple[str, str]], out_col: str = "dense_rank",
                      partitions: int | None = None) -> DataFrame:
    """``dense_rank() over (order by …)`` across the whole frame, distributed."""
    keys = [c for c, _ in order]
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = cut_lineage(df)  # ranked values and rows must be one and the same computation, or float keys may not meet
    distinct_keys = df.select(*keys).distinct()
    ranged = (distinct_keys.repartitionByRange(n, *_order(order))
              .withColumn("__pid", F.spark_partition_id()))
    w = Window.partitionBy("__pid").orderBy(*_order(order))
    numbered = cut_lineage(ranged.withColumn("__rn", F.row_number().over(w)))
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # One row per partition: a window over it is a tiny single-task step.
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0)))
    ranks = numbered.join(F.broadcast(offsets.select("__pid", "__off")), "__pid") \
        .select(*keys, (F.col("__off") + F.col("__rn")).cast("int").alias(out_col))
    cond = None
    r = ranks.select(*[F.col(k).alias(f"__r_{k}") for k in keys], out_col)
    for k in keys:
        c = df[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return df.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def latest_n_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the latest ``n`` distinct periods (a limit that is the feature)."""
    periods = df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return df.join(F.broadcast(periods), period, "left_semi")


def latest_row(df: DataFrame, order_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """T4: the latest row (per ``keys``), as ``max_by`` over a struct — no global sort."""
    payload = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in payload])).alias("__b")
    g = df.groupBy(*keys).agg(best) if keys else df.agg(best)
    return g.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in payload])


def distributed_rank(df: DataFrame, group: Sequence[str], order: Sequence[tuple[str, str]],
                     partitions: int | None = None, prefix: str = "") -> DataFrame:
    """``rank``, ``dense_rank``, ``row_number`` and ``percent_rank`` within ``group``
    without gathering a group into one task.

    Rows are range-partitioned on (group, order): a large group is spread over
    several partitions by value range, while identical (group, value) keys stay
    together, so ties never straddle a boundary.  Ranks are computed locally
    per (partition, group) and shifted by the row / distinct-value counts of the
    same group in earlier partitions (a table with at most one row per
    partition and group).  The locally ranked rows are checkpointed so that both
    uses see one range partitioning.  ``row_number`` is deterministic only if
    ``order`` is a total order.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordering = _order(order)
    ranged = df.repartitionByRange(n, *[F.col(g).asc_nulls_last() for g in group], *ordering) \
        .withColumn("__pid", F.spark_partition_id())
    w = Window.partitionBy("__pid", *group).orderBy(*ordering)
    local = cut_lineage(ranged.withColumns({"__rk": F.rank().over(w), "__dr": F.dense_rank().over(w),
                                            "__rn": F.row_number().over(w)}))
    stats = local.groupBy("__pid", *group).agg(F.count(F.lit(1)).alias("__rows"), F.max("__dr").alias("__vals"))
    before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select("__pid", *group,
                         F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
                         F.coalesce(F.sum("__vals").over(before), F.lit(0)).alias("__vals_before"),
                         F.sum("__rows").over(Window.partitionBy(*group)).alias("__n"))
    keys = ["__pid", *group]
    s = stats.select(*[F.col(k).alias(f"__s_{k}") for k in keys],
                                     "__rows_before", "__vals_before", "__n")
    cond = None
    for k in keys:
        c = local[k].eqNullSafe(s[f"__s_{k}"])
        cond = c if cond is None else cond & c
    j = local.join(s, cond, "inner")
    rank = F.col("__rows_before") + F.col("__rk")
    out = j.withColumns({
        f"{prefix}rank": rank.cast("int"),
        f"{prefix}dense_rank": (F.col("__vals_before") + F.col("__dr")).cast("int"),
        f"{prefix}row_number": (F.col("__rows_before") + F.col("__rn")).cast("int"),
        f"{prefix}percent_rank": F.when(F.col("__n") > 1, (rank - 1) / (F.col("__n") - 1)).otherwise(F.lit(0)),
    })
    drop = ["__pid", "__rk", "__dr", "__rn", "__rows_before", "__vals_before", "__n"] + [f"__s_{k}" for k in keys]
    return out.drop(*drop)
