"""Aggregation helpers not covered by plain ``groupBy().agg()``.

Most of §2.6 is native: sums / counts / filtered aggregates are ``F.sum`` /
``F.count_if`` / ``F.sum(F.when(...))`` in one ``agg`` (map-side combined).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_string_agg(df: DataFrame, group: Sequence[str], value: str, sep: str = ", ", out: str = "value_list") -> DataFrame:
    """The distinct values of a column per group, in order, as one string.

    For columns with a small fixed set of values (channels, statuses): the string is bounded by that set, whatever the
    group's size, and ``collect_set`` combines on the map side.
    """
    return df.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), sep).alias(out))


def median(c: str) -> Column:
    """Exact median (``percentile_cont(0.5)``, linear interpolation)."""
    return F.median(c)


def bool_matrix(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Boolean-matrix pivot (``bool_or`` per cell) with a fixed column list."""
    return df.groupBy(row).agg(*[F.coalesce(F.bool_or(F.col(col) == v), F.lit(False)).alias(v) for v in values])
