"""Variance operators: price / volume / mix decompositions and forecast variance.

Four decompositions exist and are kept apart on purpose (each ties to its own
residual):

* K10 ``price_volume_mix_mom``: month over month; price at *prior* units,
  volume at *prior* price, mix = residual.
* K20 ``forecast_price_volume``: actual vs forecast; volume at *forecast*
  price, price at *actual* units.
* K23 ``revenue_root_cause``: current vs prior 28 days; volume at prior (or
  current) price, price at *current* units.
* X13 (semantic layer) uses K10's definitions over any period pair.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import latest_date
from ..functions.clean import ratio, round_to
from .ranking import global_dense_rank


def price_volume_mix_mom(sales: DataFrame, product: str = "sku", period: str = "month_start") -> DataFrame:
    """Month-over-month revenue variance split into price, volume and mix.

    The prior month is found by an equi join on ``add_months(period, -1)``
    (J6) — both sides are already aggregated to (period, product).
    """
    m = sales.groupBy(period, product).agg(F.sum("units").alias("units"), F.sum("net_sales").alias("net_sales"))
    m = m.withColumn("net_price", ratio("net_sales", "units"))
    prev = m.select(F.add_months(F.col(period), 1).alias(period), F.col(product),
                    F.col("units").alias("prev_units"), F.col("net_sales").alias("prev_sales"),
                    F.col("net_price").alias("prev_price"))
    cp = m.join(prev, [period, product], "left")
    z = F.lit(0)
    d = cp.select(
        period, product,
        (F.coalesce("net_sales", z) - F.coalesce("prev_sales", z)).alias("revenue_variance"),
        (F.coalesce("prev_units", z) * (F.coalesce("net_price", z) - F.coalesce("prev_price", z))).alias("price_effect"),
        (F.coalesce("prev_price", z) * (F.coalesce("units", z) - F.coalesce("prev_units", z))).alias("volume_effect"))
    g = d.groupBy(period).agg(F.sum("revenue_variance").alias("revenue_variance"),
                              F.sum("price_effect").alias("price_effect"),
                              F.sum("volume_effect").alias("volume_effect"))
    return g.withColumn("mix_effect", F.col("revenue_variance") - F.col("price_effect") - F.col("volume_effect"))


def variance_by(rows: DataFrame, key: str) -> DataFrame:
    """Q36: variance and its three effects by a label (business event), over rows with actuals."""
    return rows.filter(F.col("actual_net_sales").isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(c).alias(c) for c in ("total_sales_variance", "volume_effect", "price_effect", "mix_or_residual_effect")])


def forecast_vs_actual(staged: DataFrame) -> DataFrame:
    """Per-row variance, APE, performance status, missing-actual flag."""
    a, f = F.col("actual_net_sales"), F.col("forecast_net_sales")
    status = (F.when(a.isNull(), F.lit("partial_actual")).when(a > f, F.lit("above_forecast"))
              .when(a < f, F.lit("below_forecast")).otherwise(F.lit("on_forecast")))
    return staged.withColumns({
        "unit_variance": F.col("actual_units") - F.col("forecast_units"),
        "sales_variance": a - f,
        "sales_variance_pct": ratio(a - f, f),
        "absolute_sales_error": F.abs(a - f),
        "absolute_percent_error": ratio(F.abs(a - f), a),
        "is_missing_actual": a.isNull(),
        "forecast_performance_status": status,
    })


def forecast_price_volume(fva: DataFrame) -> DataFrame:
    """Volume at forecast price, price at actual units, residual, primary driver."""
    a = F.col("actual_net_sales")
    au, fu = F.col("actual_units"), F.col("forecast_units")
    ap, fp = F.col("actual_unit_price"), F.col("forecast_unit_price")
    vol = (au - fu) * fp
    price = (ap - fp) * au
    driver = (F.when(a.isNull(), F.lit("partial_actual"))
              .when(F.col("stockout_flag") == True, F.lit("stockout"))  # noqa: E712
              .when(F.col("promo_flag") == True, F.lit("promo"))  # noqa: E712
              .when((au > fu) & (ap >= fp), F.lit("volume_up"))
              .when((au < fu) & (ap <= fp), F.lit("volume_down"))
              .when(ap > fp, F.lit("price_up"))
              .when(ap < fp, F.lit("price_down"))
              .otherwise(F.lit("base_business")))
    return fva.withColumns({
        "total_sales_variance": F.col("sales_variance"),
        "volume_effect": F.when(a.isNotNull(), vol),
        "price_effect": F.when(a.isNotNull(), price),
        "mix_or_residual_effect": F.when(a.isNotNull(), F.col("sales_variance") - vol - price),
        "primary_variance_driver": driver,
    })


def variance_bridge(pvm: DataFrame, by: Sequence[str] = ("week_start_date", "channel", "plan_version")) -> DataFrame:
    """Weekly bridge forecast → volume → price → residual → actual."""
    p = pvm.filter(F.col("actual_net_sales").isNotNull())
    return p.groupBy(*by).agg(
        F.sum("forecast_net_sales").alias("forecast_net_sales"), F.sum("volume_effect").alias("volume_effect"),
        F.sum("price_effect").alias("price_effect"), F.sum("mix_or_residual_effect").alias("mix_or_residual_effect"),
        F.sum("actual_net_sales").alias("actual_net_sales"), F.sum("total_sales_variance").alias("total_sales_variance"),
        F.count(F.lit(1)).alias("row_count"), F.count("actual_net_sales").alias("rows_with_actuals"),
        (F.count(F.lit(1)) - F.count("actual_net_sales")).alias("rows_missing_actuals"))


def forecast_kpi(fva: DataFrame, by: Sequence[str] = ("week_start_date", "channel", "plan_version")) -> DataFrame:
    """WAPE, bias % and missing-actual rows per week / channel / plan."""
    p = fva.filter(F.col("actual_net_sales").isNotNull())
    a, f = F.col("actual_net_sales"), F.col("forecast_net_sales")
    g = p.groupBy(*by).agg(
        F.sum(f).alias("forecast_net_sales"), F.sum(a).alias("actual_net_sales"),
        F.sum(a - f).alias("forecast_bias_amount"), F.sum(F.abs(a - f)).alias("absolute_sales_error"),
        F.count(F.lit(1)).alias("row_count"), F.count(a).alias("rows_with_actuals"),
        (F.count(F.lit(1)) - F.count(a)).alias("rows_missing_actuals"))
    return g.withColumns({"wape": ratio("absolute_sales_error", "actual_net_sales"),
                          "bias_pct": ratio("forecast_bias_amount", "forecast_net_sales")})


# Fixed driver labels and actions.
ROOT_CAUSE_LABELS = (
    ("new", "New / growing business",
     "Review what changed and consider expanding distribution or support."),
    ("lost", "Lost / declining business",
     "Investigate lost sales, distribution gaps, account issues, or discontinued demand."),
    ("vol_down", "Volume-driven decline",
     "Investigate demand decline, inventory availability, account performance, or lost distribution."),
    ("price_down", "Price-driven decline",
     "Review pricing, discounting, promo activity, or channel price pressure."),
    ("vol_up", "Volume-driven growth",
     "Protect supply and consider expanding high-performing store/SKU/channel combinations."),
    ("price_up", "Price-driven growth",
     "Review whether price improvement is sustainable without hurting demand."),
    ("stable", "Stable / low movement", "Monitor; no immediate action required."),
)


def revenue_root_cause(daily: DataFrame, keys: Sequence[str] = ("store_code", "sku", "channel"),
                       date: str = "sale_date", window_days: int = 28, as_of=None) -> DataFrame:
    """Current vs prior ``window_days``, volume / price effects, driver label, action, impact rank.

    ``as_of`` defaults to the latest date in ``daily``, resolved once. As a literal it bounds the scan: only the two
    windows are read.
    The pivot of the two periods is one conditional ``groupBy`` (A11).
    """
    end = F.lit(as_of or latest_date(daily, date)).cast("date")
    cur_start = F.date_sub(end, window_days - 1)
    x = daily.filter((F.col(date) >= F.date_sub(end, 2 * window_days - 1)) & (F.col(date) <= end))
    is_cur = F.col(date) >= cur_start
    units = F.coalesce("units_sold", F.lit(0))
    net = F.coalesce("net_sales", F.lit(0))
    p = x.groupBy(*keys).agg(
        F.sum(F.when(is_cur, units).otherwise(0.0)).alias("current_units_sold"),
        F.sum(F.when(~is_cur, units).otherwise(0.0)).alias("prior_units_sold"),
        F.sum(F.when(is_cur, net).otherwise(0.0)).alias("current_net_sales"),
        F.sum(F.when(~is_cur, net).otherwise(0.0)).alias("prior_net_sales"))
    cu, pu = F.col("current_units_sold"), F.col("prior_units_sold")
    cn, pn = F.col("current_net_sales"), F.col("prior_net_sales")
    v = p.withColumns({
        "net_sales_variance": cn - pn,
        "net_sales_variance_pct": ratio(cn - pn, pn),
        "current_avg_net_price": ratio(cn, cu),
        "prior_avg_net_price": ratio(pn, pu),
    })
    v = v.withColumns({
        "estimated_volume_effect": (cu - pu) * F.coalesce("prior_avg_net_price", "current_avg_net_price", F.lit(0)),
        "estimated_price_effect": (F.coalesce("current_avg_net_price", F.lit(0))
                                   - F.coalesce("prior_avg_net_price", F.lit(0))) * cu,
    })
    var = F.col("net_sales_variance")
    av, ap = F.abs("estimated_volume_effect"), F.abs("estimated_price_effect")
    conds = {
        "new": (pn == 0) & (cn > 0),
        "lost": (pn > 0) & (cn == 0),
        "vol_down": (var < 0) & (av >= ap),
        "price_down": (var < 0) & (ap > av),
        "vol_up": (var > 0) & (av >= ap),
        "price_up": (var > 0) & (ap > av),
    }
    label = action = None
    for key, lab, act in ROOT_CAUSE_LABELS:
        if key == "stable":
            label, action = label.otherwise(F.lit(lab)), action.otherwise(F.lit(act))
            continue
        label = F.when(conds[key], F.lit(lab)) if label is None else label.when(conds[key], F.lit(lab))
        action = F.when(conds[key], F.lit(act)) if action is None else action.when(conds[key], F.lit(act))
    v = v.withColumns({"primary_revenue_driver": label, "recommended_action": action,
                       # Ranked on cents-level precision so equal variances tie exactly.
                       "__abs_var": round_to(F.abs(var), 4)})
    return global_dense_rank(v, [("__abs_var", "desc")], "variance_impact_rank").drop("__abs_var")
