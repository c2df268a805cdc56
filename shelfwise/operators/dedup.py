"""Dedup and latest-record operators.

``keep_best`` is the workhorse.  Instead of ``row_number() over (partition by
key …)`` — which must hold every row of a key in one task and so collapses a
hot key onto one executor — it is a grouped ``max`` over a struct whose leading
fields are the preferences and whose trailing fields are all remaining columns:

* the struct order is a *total* order, so the winner is deterministic (the
  reference's load-id-only tie-break is ambiguous; see README);
* ``max`` is an algebraic aggregate, so Spark combines partially on the map
  side: a key holding a third of all rows is reduced to one row per map task
  before the shuffle;
* the group size (``count(*)``) rides along in the same aggregate.

Struct comparison puts null fields first, so under ``max`` a null preference
loses — i.e. every preference is "nulls last".  Ascending preferences are
turned into descending ones by negation (numbers, dates, timestamps, booleans).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import hash_key

Pref = tuple  # (column name or Column, "desc" | "asc")


def _desc_form(df: DataFrame, expr: Column, direction: str, dtype: T.DataType) -> Column:
    if direction == "desc":
        return expr
    if isinstance(dtype, T.BooleanType):
        return ~expr
    if isinstance(dtype, T.DateType):
        return -F.unix_date(expr)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(expr.cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return -expr
    raise ValueError(f"ascending preference on {dtype.simpleString()} is not supported; "
                     "map it to a number first")


def keep_best(df: DataFrame, keys: Sequence[str], prefer: Sequence[Pref] = (),
              count_col: str | None = "dup_group_size", tie_break: Sequence[str] | None = None,
              columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys`` chosen by ordered preferences (nulls last).

    ``prefer`` items are ``(column, "desc"|"asc")``; columns may be expressions.
    Ties are broken by ``tie_break`` (default: every other column, descending,
    in frame order).  Output: the frame's columns plus ``count_col``; with ``columns`` only those of the winner.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    tb = payload if tie_break is None else list(tie_break)
    order = [*tb, *[c for c in payload if c not in tb]]
    if columns is not None:
        # What stands behind the last wanted column decides only between rows that agree in all wanted ones.
        order = order[:max((i + 1 for i, c in enumerate(order) if c in columns), default=0)]
        payload = [c for c in payload if c in columns]
    fields = []
    exprs = [F.col(c) if isinstance(c, str) else c for c, _ in prefer]
    # One analysis pass for every preference type (each schema probe re-analyses the plan).
    types = df.select(*[e.alias(f"__x{i}") for i, e in enumerate(exprs)]).schema if exprs else None
    for i, ((_, direction), expr) in enumerate(zip(prefer, exprs)):
        fields.append(_desc_form(df, expr, direction, types[f"__x{i}"].dataType).alias(f"__p{i}"))
    # The row itself, tie-break columns first: each column is in the struct once.
    fields += [F.col(c) for c in order]
    aggs = [F.max(F.struct(*fields)).alias("__best")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys] + [F.col(f"__best.{c}").alias(c) for c in payload]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)


# Lineage columns from the newest load down; those that a frame has take part.
RECENCY = ("ingested_at", "drop_date", "load_id")


def newest_first(df: DataFrame) -> list[Pref]:
    return [(c, "desc") for c in RECENCY if c in df.columns]


def clean_first(df: DataFrame, *flags: str) -> list[Pref]:
    """Rows without the defect flags first (flags that a frame does not have are skipped)."""
    return [(F.coalesce(F.col(f), F.lit(False)), "asc") for f in flags if f in df.columns]


def complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all there."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def distributor_sales(staged: DataFrame, grain: Sequence[str], columns: Sequence[str] | None = None,
                      within: Sequence[str] = ()) -> DataFrame:
    """D1 on distributor sales: complete grain; clean keys, then clean amounts, then the newest load. ``within`` names columns
    that follow from the grain: they stay, and rows dealt by one of them are grouped where they are."""
    return keep_best(complete(staged, grain), [*within, *grain],
                     [*clean_first(staged, "is_missing_key", "is_bad_amount"), *newest_first(staged)], columns=columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], date_expr: Column,
                   count_col: str = "version_count", extra_prefer: Sequence[Pref] = ()) -> DataFrame:
    """Latest version per entity (by ``date_expr`` desc, then the newest load) + version count."""
    return keep_best(df, keys, [(date_expr, "desc"), *extra_prefer, *newest_first(df)], count_col=count_col)


def latest_complete(df: DataFrame, keys: Sequence[str], required: Sequence[str], date_expr: Column,
                    count_col: str = "version_count") -> DataFrame:
    """D3: the newest master row by date; on one date a row with clean keys and then with each required field wins,
    then the newest load."""
    prefer = [(date_expr, "desc"), *clean_first(df, "is_missing_key"),
              *[(F.col(r).isNotNull(), "desc") for r in required], *newest_first(df)]
    return keep_best(df, keys, prefer, count_col=count_col)


def one_per_grain(df: DataFrame, grain: Sequence[str], count_col: str | None = "dup_group_size",
                  columns: Sequence[str] | None = None) -> DataFrame:
    """One row per complete grain: clean keys first, then the newest load."""
    return keep_best(complete(df, grain), grain, [*clean_first(df, "is_missing_key"), *newest_first(df)], count_col=count_col,
                     columns=columns)


def pos_transactions(df: DataFrame, key: str = "txn_id", ts: str = "txn_date", within: Sequence[str] = ()) -> DataFrame:
    """One row per transaction: a readable timestamp, store and SKU first (in this order), then the newest load.

    ``within`` names columns that follow from the key (the order of a transaction): the groups stay the same, and rows
    that a join has dealt by such a column are grouped where they are.
    """
    out = keep_best(complete(df, [key]), [key, *within], [(F.col(c).isNotNull(), "desc") for c in (ts, "store_code", "sku")]
                    + newest_first(df), count_col=None)
    return out.drop(*within)


def dedup_with_id(df: DataFrame, grain: Sequence[str], id_col: str = "record_id",
                  count_col: str = "dup_group_size") -> DataFrame:
    """One row per complete grain (clean rows, then the newest load) plus a stable md5 id of the grain fields."""
    prefer = [*clean_first(df, "is_missing_key", "is_bad_action"), *newest_first(df)]
    return keep_best(complete(df, grain), grain, prefer, count_col=count_col).withColumn(id_col, hash_key(*grain))


def dedup_fallback_key(df: DataFrame, primary: str, fallback: str, other_keys: Sequence[str], quantity: str,
                       key_col: str = "dedup_key") -> DataFrame:
    """The key falls back to another column where the primary id is null; clean rows first, then non-negative
    quantities, then the newest load. Rows without a full key are left out."""
    keyed = df.withColumn(key_col, F.coalesce(F.col(primary).cast("string"), F.col(fallback).cast("string")))
    prefer = [*clean_first(df, "is_missing_key"), (F.coalesce(F.col(quantity) < 0, F.lit(False)), "asc"), *newest_first(df)]
    return keep_best(complete(keyed, [key_col, *other_keys]), [key_col, *other_keys], prefer)


def last_wins(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Pandas-style ``sort_values(order).drop_duplicates(keep='last')``."""
    return keep_best(df, keys, [(order_col, "desc")], count_col=None)


def last_value_per_key(df: DataFrame, keys: Sequence[str], value: str, order_col: str,
                       out_col: str | None = None) -> DataFrame:
    """Value at the latest ``order_col`` per key, ties broken by the value.

    ``max_by`` over a (order, value) struct: map-side partial, deterministic.
    """
    out_col = out_col or f"last_{value}"
    best = F.max(F.struct(F.col(order_col), F.col(value)))
    return df.groupBy(*keys).agg(best[value].alias(out_col))


def duplicate_candidates(df: DataFrame, keys: Sequence[str | Column], flag_col: str = "is_duplicate_candidate",
                         size_col: str | None = None) -> DataFrame:
    """Flag rows whose key group has more than one row.

    Group sizes come from a partial-combined ``groupBy().count()`` joined back
    on the (null-safe) key.  Unlike ``count(*) over (partition by …)`` this does
    not pin a hot key to one task: AQE's skew-join split applies to the join.
    """
    key_exprs = [(F.col(k) if isinstance(k, str) else k) for k in keys]
    names = [f"__k{i}" for i in range(len(key_exprs))]
    keyed = df.withColumns({n: e for n, e in zip(names, key_exprs)})
    sizes = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select(*[F.col(n).alias(n + "_r") for n in names], "__n")
    cond = None
    for n in names:
        c = keyed[n].eqNullSafe(sizes[n + "_r"])
        cond = c if cond is None else cond & c
    joined = keyed.join(sizes, cond, "left")
    out = joined.withColumn(flag_col, F.col("__n") > 1)
    if size_col:
        out = out.withColumn(size_col, F.col("__n"))
    return out.drop("__n", *names, *[n + "_r" for n in names])
