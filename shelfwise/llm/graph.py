"""Connected components of a link table, by alternating large and small stars.

Every round points a node's larger neighbours at its smallest one (large star), then its smaller neighbours and
itself at the smallest (small star). Links shrink to stars around the smallest node of each component, in a number of
rounds that grows with the logarithm of the longest path. Each round is two grouped minima joined back to
the links; a node with very many links is pre-aggregated before the shuffle, and its part of the join can be split.
Links are written to the shared folder after every round; nothing about single nodes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    to_low = links.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return to_low.unionByName(low.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("s")).first()
    return row["n"], row["s"] or 0


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link to a different node.

    ``links`` has two columns of ids, in either direction, possibly repeated; null ends and self-links are ignored.
    """
    a, b = links.columns
    links = links.filter(F.col(a) != F.col(b)) \
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links = written(links, "links")
    state = _state(links)
    for _ in range(max_rounds):
        if not state[0]:
            break
        links = written(_small_star(_large_star(links)).distinct(), "links")
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
