"""Reconciliations and controls (Q9, Q16–Q27, Q36).

Reconciliations compare two independently aggregated sides with a full outer
join on the grain (J3), so rows missing on either side are labelled rather
than dropped.  Both sides are aggregated *before* the join, so the join
shuffles only one row per grain key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import SUM, exact, ratio, sym_rel_diff


def reconcile_totals(left: DataFrame, right: DataFrame, keys: Sequence[str], left_col: str, right_col: str,
                     rel_tol: float = 0.02, abs_tol: float | None = None, run_id: int | None = None,
                     status_col: str = "recon_status") -> DataFrame:
    """Q9: per-key totals of two sources; ``fail`` when the relative gap exceeds ``rel_tol``
    (and, when given, the absolute gap exceeds ``abs_tol``)."""
    l_ = left.groupBy(*keys).agg(F.sum(left_col).alias("source_amount"))
    r_ = right.groupBy(*keys).agg(F.sum(right_col).alias("target_amount"))
    j = l_.join(r_, list(keys), "full")
    s, t = F.coalesce("source_amount", F.lit(0)), F.coalesce("target_amount", F.lit(0))
    diff = s - t
    rel = ratio(F.abs(diff), F.abs(t))  # nothing to compare with is a failure, whatever the source says
    bad = F.coalesce(rel > rel_tol, F.lit(True))
    if abs_tol is not None:
        bad = bad & (F.abs(diff) > abs_tol)
    out = j.select(*keys, "source_amount", "target_amount", diff.alias("difference_amount"),
                   rel.alias("difference_pct"),
                   F.when(bad, F.lit("fail")).otherwise(F.lit("pass")).alias(status_col))
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id).cast("bigint"))
    return out


def recon_distributor_vs_pos(dist: DataFrame, pos: DataFrame, keys: Sequence[str] = ("sale_date", "store_code"),
                             start=None, tolerance_pct: float = 0.01, date_col: str = "sale_date") -> DataFrame:
    """Q21: distributor vs POS at store-day grain: both sides summed (nulls as 0), full outer joined (J3),
    deltas (POS − distributor), symmetric % delta on net sales, Pass / Warning (≤ 2× tol) / Fail.

    ``start`` replaces the reference's ``current_date - 90`` window (None = whole history).
    """
    def side(df, prefix):
        if start is not None:
            df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
        z = F.lit(0)
        return df.groupBy(*keys).agg(F.sum(F.coalesce(F.col("net_sales").cast("double"), z)).alias(f"{prefix}_net_sales"),
                                     F.sum(F.coalesce(F.col("gross_sales").cast("double"), z)).alias(f"{prefix}_gross_sales"),
                                     F.sum(F.coalesce(F.col("units").cast("double"), z)).alias(f"{prefix}_qty"))
    j = side(dist, "dist").join(side(pos, "pos"), list(keys), "full")
    z = F.lit(0)
    out = j.select(*keys, "dist_net_sales", "pos_net_sales",
                   (F.coalesce("pos_net_sales", z) - F.coalesce("dist_net_sales", z)).alias("delta_net_sales"),
                   "dist_gross_sales", "pos_gross_sales",
                   (F.coalesce("pos_gross_sales", z) - F.coalesce("dist_gross_sales", z)).alias("delta_gross_sales"),
                   "dist_qty", "pos_qty", (F.coalesce("pos_qty", z) - F.coalesce("dist_qty", z)).alias("delta_qty"),
                   sym_rel_diff(F.coalesce("dist_net_sales", z), F.coalesce("pos_net_sales", z)).alias("delta_pct_net_sales"),
                   F.lit(tolerance_pct).alias("tolerance_pct"))
    key_null = None
    for k in keys:
        key_null = F.col(k).isNull() if key_null is None else key_null | F.col(k).isNull()
    status = (F.when(key_null, F.lit("Fail")).when(F.col("delta_pct_net_sales") <= tolerance_pct, F.lit("Pass"))
              .when(F.col("delta_pct_net_sales") <= tolerance_pct * 2, F.lit("Warning")).otherwise(F.lit("Fail")))
    return out.withColumn("status", status)


def recon_sales_to_ledger(sales: DataFrame, ledger: DataFrame, period: str = "period_month",
                          abs_tol: float = 500.0, pct_tol: float = 0.02, margin_pct_tol: float = 0.035) -> DataFrame:
    """Q22: monthly mart sales vs ledger actuals per metric.

    ``sales`` rows: (period, net_sales, gross_sales, cogs); ``ledger`` rows:
    (period, kpi_category, actual_amount).  The ledger side is pivoted with
    filtered sums (A4), both sides are melted (A13) after a full outer join on
    the month, and each metric is PASS within $``abs_tol`` or within the
    relative tolerance (3.5 % for margin), else FAIL_* with the missing side named.
    """
    z = F.lit(0)
    m = sales.groupBy(period).agg(
        F.sum(F.coalesce("net_sales", z)).alias("mart_net_sales"), F.sum(F.coalesce("gross_sales", z)).alias("mart_gross_sales"),
        F.sum(F.coalesce("cogs", z)).alias("mart_cogs"),
        F.sum(F.coalesce("net_sales", z) - F.coalesce("cogs", z)).alias("mart_gross_margin"))
    cat = F.col("kpi_category")
    g = ledger.groupBy(period).agg(*[F.sum(F.when(cat == k, F.col("actual_amount"))).alias(f"gl_{k}")
                                     for k in ("net_sales", "gross_sales", "cogs", "gross_margin")])
    rows = m.join(g, period, "full")
    metrics = ("net_sales", "gross_sales", "cogs", "gross_margin")
    stack = ", ".join(f"'{k}', CAST(mart_{k} AS {SUM}), CAST(gl_{k} AS {SUM})" for k in metrics)
    melt = rows.selectExpr(period, f"stack({len(metrics)}, {stack}) AS (metric, mart_amount, gl_amount)")
    ma, ga = F.coalesce("mart_amount", z), F.coalesce("gl_amount", z)
    diff = F.abs(ma - ga)
    big = F.greatest(F.abs(ma), F.abs(ga))
    share = ratio(diff, big)
    pct = F.when(big == 0, z).otherwise(share)
    margin = F.col("metric") == "gross_margin"
    status = (F.when(F.col("mart_amount").isNull(), F.lit("FAIL_missing_mart"))
              .when(F.col("gl_amount").isNull(), F.lit("FAIL_missing_gl"))
              .when(diff <= abs_tol, F.lit("PASS"))
              .when(margin & (big > 0) & (share <= margin_pct_tol), F.lit("PASS"))
              .when(~margin & (big > 0) & (share <= pct_tol), F.lit("PASS"))
              .otherwise(F.lit("FAIL_mismatch")))
    return melt.select(period, "metric", "mart_amount", "gl_amount", (ma - ga).alias("diff_amount"),
                       pct.alias("pct_diff"), status.alias("status"))


@dataclass
class Layer:
    """One layer of a reconciliation: ``build(day)`` gives its rows (of that day only, if it can push the day into its
    scans; all rows for None), ``dates`` a frame that holds at least its dates and is cheaper than the rows."""

    name: str
    date: str
    build: Callable[[dt.date | None], DataFrame]
    measures: dict[str, str | Column]
    dates: Callable[[], DataFrame] | None = None


@dataclass
class LayerPair:
    """A source layer and the layer modeled from it; both name the same measures."""

    check: str
    grain: str
    source: Layer
    modeled: Layer
    tolerance_pct: float = 0.0


def latest_common_dates(pairs: Sequence[LayerPair]) -> dict[str, dt.date | None]:
    """Check -> latest date that both of its layers have reached: the lesser of their latest dates (of a layer without
    dates, the other's). One job for all layers; the driver receives one date per check."""
    out = None
    for p in pairs:
        for layer in (p.source, p.modeled):
            frame = layer.dates() if layer.dates else layer.build(None)
            latest = frame.agg(F.max(F.col(layer.date).cast("date")).alias("latest")).withColumn("check", F.lit(p.check))
            out = latest if out is None else out.unionByName(latest)
    return {r["check"]: r["common"] for r in out.groupBy("check").agg(F.min("latest").alias("common")).collect()}


def _layer_totals(layer: Layer, day: dt.date | None, prefix: str) -> DataFrame:
    """One row: the sums of all measures on the day, null where the layer has no row of it."""
    rows = layer.build(day).filter(F.col(layer.date).cast("date") == F.lit(day).cast("date"))
    value = lambda m: F.col(m) if isinstance(m, str) else m
    return rows.agg(*[exact(F.sum(F.coalesce(value(m), F.lit(0))), SUM).alias(f"{prefix}_{k}") for k, m in layer.measures.items()]) \
        .withColumn("__k", F.lit(1))


def layer_reconciliation(pairs: Sequence[LayerPair]) -> DataFrame:
    """Q23: totals of each layer against the layer modeled from it, on the latest date that both have.

    The common dates are resolved first, for all layers in one job, and reach the scans as literals; then every layer is read
    once and all its measures are summed in that pass. Exact amounts are compared: equal totals pass (with a tolerance, totals
    whose relative gap is within it); a layer without rows on the date fails as missing.
    """
    days = latest_common_dates(pairs)
    out = None
    for p in pairs:
        if p.source.measures.keys() != p.modeled.measures.keys():
            raise ValueError(f"{p.check}: both layers must name the same measures")
        day = days[p.check]
        stack = ", ".join(f"'{k}', s_{k}, m_{k}" for k in p.source.measures)
        both = _layer_totals(p.source, day, "s").join(_layer_totals(p.modeled, day, "m"), "__k")
        rows = both.selectExpr(f"stack({len(p.source.measures)}, {stack}) AS (measure, source_total, modeled_total)")
        s, m = F.coalesce("source_total", F.lit(0)), F.coalesce("modeled_total", F.lit(0))
        pct = F.coalesce(ratio(F.abs(m - s), F.greatest(F.abs(s), F.abs(m))), F.lit(0.0))
        detail = (F.when(F.col("source_total").isNull(), F.lit("FAIL_missing_source"))
                  .when(F.col("modeled_total").isNull(), F.lit("FAIL_missing_modeled"))
                  .when((m == s) | (pct <= p.tolerance_pct), F.lit("PASS")).otherwise(F.lit("FAIL_mismatch")))
        rows = rows.select(
            F.lit("recon").alias("check_group"), F.concat(F.lit(f"{p.check}:"), F.col("measure")).alias("check_name"),
            F.lit(p.grain).alias("grain"), F.lit(day).cast("date").alias("check_date"),
            F.lit(p.source.name).alias("source_object"), F.lit(p.modeled.name).alias("modeled_object"),
            "source_total", "modeled_total", (m - s).alias("delta_amount"), pct.alias("delta_pct"),
            F.lit(p.tolerance_pct).cast("double").alias("tolerance_pct"),
            F.when(detail == "PASS", F.lit("Pass")).otherwise(F.lit("Fail")).alias("status"), detail.alias("status_detail"))
        out = rows if out is None else out.unionByName(rows)
    return out


def unified_controls(controls: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Heterogeneous control outputs → one contract (check, key, status)."""
    out = None
    for name, (df, status_col, key_cols) in controls.items():
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols]) if key_cols else F.lit(None).cast("string")
        d = df.select(F.lit(name).alias("check_name"), key.alias("check_key"), F.col(status_col).alias("status"))
        out = d if out is None else out.unionByName(d)
    return out


def confidence(controls: DataFrame, grain: Sequence[str], passing: str, status_col: str = "status") -> DataFrame:
    """Share of the control rows of each group that pass (a row without status does not)."""
    return controls.groupBy(*grain).agg(
        ratio(F.count_if(F.col(status_col) == passing), F.count(F.lit(1))).alias("data_confidence_score"))


def bridge_tieout(bridge: DataFrame, tol: float = 0.01) -> DataFrame:
    """Q36: forecast + volume + price + residual must equal actual within rounding."""
    explained = (F.col("forecast_net_sales") + F.col("volume_effect") + F.col("price_effect")
                 + F.col("mix_or_residual_effect"))
    return bridge.withColumns({"explained_actual": explained,
                               "tieout_gap": F.col("actual_net_sales") - explained,
                               "ties_out": F.abs(F.col("actual_net_sales") - explained) <= tol})


def dim_join_coverage(facts: dict[str, tuple[DataFrame, dict[str, Column]]], dims: Sequence[str]) -> DataFrame:
    """Q17: one row per fact model: rows, rows without each dimension, rows without any, and their shares.

    ``facts``: model -> (frame, dimension -> flag of a missing partner). A dimension that a model does not use
    counts 0 and has a null share. One pass over each fact.
    """
    out = None
    for model, (df, missing) in facts.items():
        any_missing = None
        for flag in missing.values():
            any_missing = flag if any_missing is None else any_missing | flag
        r = df.agg(F.count(F.lit(1)).alias("n_fact_rows"),
                   *[(F.count_if(missing[d]) if d in missing else F.lit(0).cast("bigint")).alias(f"n_missing_{d}") for d in dims],
                   F.count_if(any_missing).alias("n_missing_any_dim"))
        r = r.select(F.lit(model).alias("fact_model"), "*",
                     *[(ratio(f"n_missing_{d}", "n_fact_rows") if d in missing else F.lit(None).cast("double"))
                       .alias(f"pct_missing_{d}") for d in dims],
                     ratio("n_missing_any_dim", "n_fact_rows").alias("pct_missing_any_dim"))
        out = r if out is None else out.unionByName(r)
    return out


# Fixed limit: a share of missing partners up to this is a low warning.
LOW_MISSING_SHARE = 0.001


def missing_dim_control(facts: Sequence[tuple[str, DataFrame, str, str, Column]], start=None) -> DataFrame:
    """Q16: one row per fact model, dimension and day with the rows that find no partner.

    ``facts``: (model, frame, date column, dimension, flag of a missing partner).
    """
    out = None
    for model, df, date_col, dim, missing in facts:
        f = df if start is None else df.filter(F.col(date_col) >= F.lit(start).cast("date"))
        g = f.groupBy(F.col(date_col).cast("date").alias("grain_date")).agg(
            F.count(F.lit(1)).alias("fact_rows"), F.count_if(missing).alias("missing_dim_rows"))
        g = g.select(F.lit(model).alias("model_name"), "grain_date", F.lit(dim).alias("dim_name"), "fact_rows", "missing_dim_rows")
        out = g if out is None else out.unionByName(g)
    share = F.when(F.col("fact_rows") == 0, F.lit(0)).otherwise(F.col("missing_dim_rows") / F.col("fact_rows"))
    status = (F.when(F.col("fact_rows") == 0, F.lit("WARN_no_rows")).when(F.col("missing_dim_rows") == 0, F.lit("PASS"))
              .when(share <= LOW_MISSING_SHARE, F.lit("WARN_low")).otherwise(F.lit("FAIL")))
    return out.withColumns({"missing_pct": share, "status": status})


def freshness(latest: DataFrame, as_of, model_col: str = "model_name", date_col: str = "latest_date",
              pass_days: int = 2, warn_days: int = 7, limits: dict[str, tuple[int, int]] | None = None,
              domain_col: str | None = None) -> DataFrame:
    """Q18 / Q19: lag of each model's latest date; Pass ≤ pass_days, Warning ≤ warn_days, else Fail.

    ``limits`` optionally overrides (pass, warn) days per domain (finance 40 / 60).
    """
    as_of_c = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of
    lag = F.datediff(as_of_c, F.col(date_col))
    p, w = F.lit(pass_days), F.lit(warn_days)
    if limits and domain_col:
        for dom, (pd_, wd) in limits.items():
            p = F.when(F.col(domain_col) == dom, F.lit(pd_)).otherwise(p)
            w = F.when(F.col(domain_col) == dom, F.lit(wd)).otherwise(w)
    status = (F.when(F.col(date_col).isNull(), F.lit("Fail")).when(lag <= p, F.lit("Pass"))
              .when(lag <= w, F.lit("Warning")).otherwise(F.lit("Fail")))
    return latest.withColumns({"lag_days": lag, "freshness_status": status})


def latest_date_of(df: DataFrame, candidates: Sequence[str], model_name: str) -> DataFrame:
    """latest date of the first candidate column present in the frame (schema walk on the driver)."""
    col = next((c for c in candidates if c in df.columns), None)
    if col is None:
        return df.sparkSession.createDataFrame([(model_name, None, None)],
                                               "model_name string, date_column string, latest_date date")
    return df.agg(F.max(F.col(col).cast("date")).alias("latest_date")).select(
        F.lit(model_name).alias("model_name"), F.lit(col).alias("date_column"), "latest_date")


def rowcounts_daily(facts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per day per model stacked into one control table."""
    out = None
    for name, (df, date_col) in facts.items():
        g = df.groupBy(F.col(date_col).cast("date").alias("activity_date")).agg(F.count(F.lit(1)).alias("row_count"))
        g = g.select(F.lit(name).alias("model_name"), "activity_date", "row_count")
        out = g if out is None else out.unionByName(g)
    return out


def layer_tieout(a: DataFrame, b: DataFrame, measure: str, name: str, b_rows_col: str | None = None) -> DataFrame:
    """Q25: row count and measure total of two layers, exact match flags.

    ``b_rows_col``: when the later layer is aggregated, the column holding the
    number of source rows per output row (summed instead of counted).
    """
    sa = a.agg(F.count(F.lit(1)).alias("a_rows"), F.sum(measure).alias("a_total"))
    b_rows = F.sum(b_rows_col) if b_rows_col else F.count(F.lit(1))
    sb = b.agg(b_rows.cast("bigint").alias("b_rows"), F.sum(measure).alias("b_total"))
    j = sa.withColumn("__k", F.lit(1)).join(sb.withColumn("__k", F.lit(1)), "__k").drop("__k")
    return j.select(F.lit(name).alias("check_name"), "*",
                    (F.col("a_rows") == F.col("b_rows")).alias("rows_match"),
                    (F.abs(F.col("a_total") - F.col("b_total")) < 0.005).alias("totals_match"))


def grain_sanity(df: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """Q27 / A3: rows vs distinct grain tuples (a tuple containing null still counts)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(F.struct(*grain)).alias("distinct_grain_rows")) \
        .select(F.lit(name).alias("fact_name"), "row_count", "distinct_grain_rows",
                (F.col("row_count") == F.col("distinct_grain_rows")).alias("grain_is_unique"))


def summary_by_status(controls: DataFrame, check_col: str = "check_name", status_col: str = "status") -> DataFrame:
    """Q24: count of control rows per check and status."""
    return controls.groupBy(check_col, status_col).agg(F.count(F.lit(1)).alias("row_count"))


def control_tieout(checks: dict[str, tuple[DataFrame, str, DataFrame, Column]]) -> DataFrame:
    """Q31: each control's reported count must equal the count recomputed from the fact flags.

    ``checks``: name → (control frame, count column summed over the control, fact frame, flag).
    Both sides are one-row aggregates joined on a constant key.
    """
    out = None
    for name, (ctrl, col, fact, flag) in checks.items():
        a = ctrl.agg(F.sum(col).cast("bigint").alias("control_count")).withColumn("__k", F.lit(1))
        b = fact.agg(F.count_if(flag).alias("fact_count")).withColumn("__k", F.lit(1))
        r = a.join(b, "__k").select(F.lit(name).alias("check_name"), "control_count", "fact_count",
                                    (F.col("control_count") == F.col("fact_count")).alias("ties_out"))
        out = r if out is None else out.unionByName(r)
    return out


def lineage_matrix(layers: dict[str, DataFrame]) -> DataFrame:
    """Q26: column presence across layers (raw → stg → int → mart) as a boolean matrix.

    A schema walk on the driver (F1-style): the result has one row per column
    name and one boolean per layer; its size depends on schemas, not data, so
    it is a library helper rather than a registered query.
    """
    spark = next(iter(layers.values())).sparkSession
    rows = [(c, name) for name, df in layers.items() for c in df.columns]
    long = spark.createDataFrame(rows, "column_name string, layer string")
    from .aggregates import bool_matrix
    m = bool_matrix(long, "column_name", "layer", list(layers))
    first, last = list(layers)[0], list(layers)[-1]
    return m.withColumn("reaches_last_layer", F.col(last)).withColumn("dropped_after_first", F.col(first) & ~F.col(last))
