"""KPI operators (K1–K18, K26–K31): grouped sums, then ratios via ``ratio``.

All take a sales frame with the canonical column names produced by the
staging / conformed layers (``month_start``, ``units``, ``gross_sales``,
``discount_amount``, ``net_sales``, ``cogs`` …) and return lazy DataFrames.
Aggregations are hash aggregates with map-side partial combine, so a hot
group key is pre-reduced on every executor before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import ratio, round_to

SALES_MEASURES = ("units", "gross_sales", "net_sales", "cogs")


def _brand(df: DataFrame, brand: str | None, brand_col: str = "brand") -> DataFrame:
    return df if brand is None else df.filter(F.col(brand_col) == F.lit(brand))


def sales_sums(df: DataFrame, by: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    aggs = [F.sum(m).alias(m if m != "units" else "units_sold") for m in SALES_MEASURES]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return df.groupBy(*by).agg(*aggs)


def exec_summary(sales: DataFrame, by: Sequence[str] = ("month_start", "state", "channel"),
                 brand: str | None = None) -> DataFrame:
    """K1: margin, gross / net VWAP and discount rate per (month, state, channel)."""
    s = sales_sums(_brand(sales, brand), list(by))
    return s.select(
        *by, "units_sold", "gross_sales", "net_sales", "cogs",
        (F.col("net_sales") - F.col("cogs")).alias("gross_margin_dollars"),
        ratio(F.col("net_sales") - F.col("cogs"), "net_sales").alias("gross_margin_pct"),
        ratio("gross_sales", "units_sold").alias("gross_vwap"),
        ratio("net_sales", "units_sold").alias("net_vwap"),
        ratio(F.col("gross_sales") - F.col("net_sales"), "gross_sales").alias("discount_rate"),
    )


def product_mix(sales: DataFrame, group: Sequence[str] = ("category", "brand"), period: str = "month_start",
                brand: str | None = None) -> DataFrame:
    """K2: unit / revenue / margin share of the period total.

    Period totals are re-aggregated from the mix rows (partial-combined, one
    row per period) and joined back — no second scan of the fact, and no
    window gathering a whole period into one task.
    """
    mix = _brand(sales, brand).groupBy(period, *group).agg(
        F.sum("units").alias("units_sold"), F.sum("net_sales").alias("net_sales"),
        F.sum(F.col("net_sales") - F.col("cogs")).alias("gross_margin_dollars"))
    tot = mix.groupBy(period).agg(F.sum("units_sold").alias("__tu"), F.sum("net_sales").alias("__tn"),
                                  F.sum("gross_margin_dollars").alias("__tm"))
    return mix.join(tot, period, "left").select(
        period, *group, "units_sold", "net_sales", "gross_margin_dollars",
        round_to(ratio("units_sold", "__tu"), 4).alias("unit_mix_pct"),
        round_to(ratio("net_sales", "__tn"), 4).alias("revenue_mix_pct"),
        round_to(ratio("gross_margin_dollars", "__tm"), 4).alias("margin_mix_pct"))


def price_pack(sales: DataFrame, by: Sequence[str] = ("month_start", "state", "category", "pack_size"),
               mg_col: str = "pack_size", brand: str | None = None) -> DataFrame:
    """K3: net price per pack, revenue and margin per mg."""
    s = _brand(sales, brand)
    mg_units = F.col("units") * F.coalesce(F.col(mg_col), F.lit(0))
    agg = s.groupBy(*by).agg(
        F.sum("units").alias("units_sold"), F.sum("net_sales").alias("net_sales"),
        F.sum(F.col("net_sales") - F.col("cogs")).alias("gross_margin_dollars"),
        F.sum(mg_units).alias("__mg"))
    return agg.select(*by, "units_sold", "net_sales", "gross_margin_dollars",
                      ratio("net_sales", "units_sold").alias("net_price_per_pack"),
                      ratio("net_sales", "__mg").alias("net_revenue_per_mg"),
                      ratio("gross_margin_dollars", "__mg").alias("margin_per_mg"))


def promo_performance(sales: DataFrame, week: str = "week_start", location: str = "store_id",
                      state: str = "state", product: str = "category", promo: str = "promo_flag",
                      brand: str | None = None) -> DataFrame:
    """K4: promo penetration, promo vs non-promo rate of sale per store, lift."""
    sw = _brand(sales, brand).groupBy(week, location, state, product).agg(
        F.max(F.when(F.col(promo), 1).otherwise(0)).alias("any_promo"), F.sum("units").alias("units_sold"))
    promo_ = F.col("any_promo") == 1
    s = sw.groupBy(week, state, product).agg(
        F.sum(F.when(promo_, F.col("units_sold")).otherwise(0)).alias("promo_units"),
        F.sum(F.when(~promo_, F.col("units_sold")).otherwise(0)).alias("nonpromo_units"),
        F.count_distinct(F.when(promo_, F.col(location))).alias("promo_locations"),
        F.count_distinct(F.when(~promo_, F.col(location))).alias("nonpromo_locations"))
    p_ros = ratio("promo_units", "promo_locations")
    n_ros = ratio("nonpromo_units", "nonpromo_locations")
    return s.select(week, state, product, "promo_units", "nonpromo_units",
                    round_to(ratio("promo_units", F.col("promo_units") + F.col("nonpromo_units")), 4).alias("promo_penetration_pct"),
                    round_to(p_ros, 2).alias("promo_ros_units_per_store"),
                    round_to(n_ros, 2).alias("nonpromo_ros_units_per_store"),
                    round_to(ratio(p_ros - n_ros, n_ros), 4).alias("promo_lift_pct"))


def distribution_ros(sales: DataFrame, week: str = "week_start", state: str = "state",
                     product: str = "category", location: str = "store_id", brand: str | None = None) -> DataFrame:
    """K5: active doors (distinct selling locations) and units per active door."""
    r = _brand(sales, brand).groupBy(week, state, product).agg(
        F.count_distinct(F.when(F.col("units") > 0, F.col(location))).alias("active_doors"),
        F.sum("units").alias("units_sold"))
    return r.withColumn("rate_of_sale_units_per_active_door", round_to(ratio("units_sold", "active_doors"), 2))


def inventory_health(inv: DataFrame, sales: DataFrame, product: str = "sku", location: str = "site_id",
                     labels: Sequence[str] = ("state", "category"), period: str = "month_start",
                     tasks: int | None = None) -> DataFrame:
    """K6: average on hand, in-stock %, stockout rate, days on hand, turnover.

    ``inv`` rows: (period, product, location, on_hand_units, in_stock_flag, *labels);
    ``sales`` rows: (period, product, location, units).
    With ``tasks`` both sides are dealt once, by the key that they are grouped and joined on, to so many tasks: hardly two rows
    share a key, so nothing is gained by grouping before the shuffle, and coalesced partitions would hold all groups of 64 MB.
    """
    if tasks:
        key = [period, product, location]
        inv = inv.select(*key, *labels, "on_hand_units", "in_stock_flag").repartition(tasks, *key)
        sales = sales.select(*key, "units").repartition(tasks, *key)
    in_stock = (F.when(F.col("in_stock_flag").isNotNull(), F.col("in_stock_flag").cast("double"))
                .when(F.col("on_hand_units") > 0, F.lit(1.0)).otherwise(F.lit(0)))
    i = inv.groupBy(period, product, location, *labels).agg(
        F.avg("on_hand_units").alias("avg_on_hand_units"), F.avg(in_stock).alias("in_stock_pct"))
    s = sales.groupBy(period, product, location).agg(F.sum("units").alias("units_sold"))
    j = i.join(s, [period, product, location], "left")
    g = j.groupBy(period, *labels).agg(
        F.avg("avg_on_hand_units").alias("avg_on_hand_units"),
        F.sum(F.coalesce("units_sold", F.lit(0))).alias("units_sold"),
        F.sum("units_sold").alias("__units_raw"),
        F.avg("in_stock_pct").alias("in_stock_pct"))
    dim = F.dayofmonth(F.last_day(F.col(period)))
    return g.select(
        period, *labels, "avg_on_hand_units", "units_sold", "in_stock_pct",
        (F.lit(1.0) - F.col("in_stock_pct")).alias("stockout_rate"),
        F.when(F.col("units_sold") != 0,
               ratio("avg_on_hand_units", ratio("__units_raw", dim))).alias("approx_days_on_hand"),
        ratio("units_sold", "avg_on_hand_units").alias("inventory_turnover_units"))


def date_location_grid(locations: DataFrame, location_cols: Sequence[str], start, end,
                       date_col: str = "full_date") -> DataFrame:
    """Dense date × location scaffold, generated per location (no join).

    ``start`` / ``end`` are date Columns or literals; each location row explodes
    into its own date sequence, so the grid is produced in parallel where the
    location rows live.
    """
    return locations.select(*location_cols, F.explode(F.sequence(F.lit(start).cast("date") if not isinstance(start, Column) else start,
                                                                  F.lit(end).cast("date") if not isinstance(end, Column) else end)).alias(date_col))


def sales_labor_productivity(sales_day: DataFrame, labor_day: DataFrame, locations: DataFrame,
                             as_of, days: int = 90, location: str = "store_code",
                             labels: Sequence[str] = ()) -> DataFrame:
    """K7: sales vs labor on a dense (date × location) grid for the trailing ``days``.

    ``sales_day``: (sale_date, location, net_sales, units, gross_margin_dollars);
    ``labor_day``: (work_date, location, labor_hours, headcount, labor_cost).
    ``as_of`` replaces the reference's ``current_date``.
    """
    as_of_c = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of
    grid = date_location_grid(locations.select(location, *labels).distinct(), [location, *labels],
                              F.date_sub(as_of_c, days), as_of_c)
    s = sales_day.groupBy(F.col("sale_date").alias("full_date"), location).agg(
        F.sum("net_sales").alias("net_sales"), F.sum("units").alias("units_sold"),
        F.sum("gross_margin_dollars").alias("gross_margin_dollars"))
    lb = labor_day.groupBy(F.col("work_date").alias("full_date"), location).agg(
        F.sum("labor_hours").alias("labor_hours"), F.sum(F.coalesce("headcount", F.lit(0))).alias("headcount"),
        F.sum(F.coalesce("labor_cost", F.lit(0))).alias("labor_cost"))
    j = grid.join(s, ["full_date", location], "left").join(lb, ["full_date", location], "left")
    hours = F.coalesce("labor_hours", F.lit(0))
    cost = F.coalesce("labor_cost", F.lit(0))
    return j.select(
        "full_date", location, *labels,
        F.coalesce("net_sales", F.lit(0)).alias("net_sales"),
        F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
        F.coalesce("gross_margin_dollars", F.lit(0)).alias("gross_margin_dollars"),
        hours.alias("labor_hours"), F.coalesce("headcount", F.lit(0)).cast("bigint").alias("headcount"),
        cost.alias("labor_cost"),
        ratio("net_sales", "labor_hours").alias("revenue_per_labor_hour"),
        ratio("units_sold", "labor_hours").alias("units_per_labor_hour"),
        ratio("gross_margin_dollars", "labor_cost").alias("gross_margin_to_labor_cost_ratio"))


def top_n_share(df: DataFrame, period: str, entity: str, value: str, n: int = 10,
                prefix: str | None = None) -> DataFrame:
    """T5 / K8: share of the period total held by the top ``n`` entities.

    ``row_number() <= n`` lets Spark insert a partial window-group limit before
    the shuffle (only ``n`` rows per period leave each map task); the period
    total is a separate partial-combined sum.  Ties are broken by the entity.
    """
    prefix = prefix or f"top_{n}"
    w = Window.partitionBy(period).orderBy(F.col(value).desc(), F.col(entity).asc())
    top = (df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
             .groupBy(period).agg(F.sum(value).alias(f"{prefix}_sales")))
    tot = df.groupBy(period).agg(F.sum(value).alias("total_period_sales"))
    j = tot.join(top, period, "left")
    return j.select(period, F.coalesce(F.col(f"{prefix}_sales"), F.lit(0)).alias(f"{prefix}_sales"),
                    "total_period_sales",
                    round_to(ratio(F.coalesce(F.col(f"{prefix}_sales"), F.lit(0)), "total_period_sales"), 4)
                    .alias(f"{prefix}_concentration_pct"))


def account_concentration(sales: DataFrame, account: str = "store_id", period: str = "month_start",
                          n: int = 10, brand: str | None = None) -> DataFrame:
    """K8: top-N account share of monthly net sales."""
    acct = _brand(sales, brand).groupBy(period, account).agg(F.sum("net_sales").alias("net_sales"))
    return top_n_share(acct, period, account, "net_sales", n)


def account_retention(sales: DataFrame, account: str = "store_id", period: str = "month_start",
                      brand: str | None = None) -> DataFrame:
    """K9: active, prior-active and retained accounts month over month."""
    active = _brand(sales, brand).filter(F.col("units") > 0).select(period, account).distinct()
    prev = active.select(F.add_months(F.col(period), 1).alias(period), F.col(account), F.lit(True).alias("__was"))
    cur = active.join(prev, [period, account], "left")
    r = cur.groupBy(period).agg(
        F.count_distinct(account).alias("active_accounts_current"),
        F.count_distinct(F.when(F.col("__was"), F.col(account))).alias("retained_accounts"))
    prior = active.groupBy(F.add_months(F.col(period), 1).alias(period)).agg(
        F.count_distinct(account).alias("active_accounts_prior"))
    j = r.join(prior, period, "left")
    return j.select(period, "active_accounts_current",
                    F.coalesce("active_accounts_prior", F.lit(0)).alias("active_accounts_prior"),
                    "retained_accounts",
                    round_to(ratio("retained_accounts", "active_accounts_prior"), 4).alias("account_retention_pct"))


def forecast_accuracy(actuals: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("sku", "store_id"),
                      week: str = "week_start") -> DataFrame:
    """Actual vs forecast units per week: absolute error, WAPE, bias."""
    a = actuals.groupBy(week, *keys).agg(F.sum("units").alias("actual_units"))
    f = forecast.groupBy(week, *keys).agg(F.sum("forecast_units").alias("forecast_units"))
    j = a.join(f, [week, *keys], "left")
    fc = F.coalesce("forecast_units", F.lit(0))
    g = j.groupBy(week).agg(
        F.sum("actual_units").alias("actual_units"), F.sum(fc).alias("forecast_units"),
        F.sum(F.abs(F.col("actual_units") - fc)).alias("abs_error_units"),
        F.sum(F.col("actual_units") - fc).alias("__bias"))
    return g.select(week, "actual_units", "forecast_units", "abs_error_units",
                    round_to(ratio("abs_error_units", "actual_units"), 4).alias("wape"),
                    round_to(ratio("__bias", "actual_units"), 4).alias("forecast_bias_pct"))


def sales_quality_counters(sales: DataFrame) -> DataFrame:
    """One-pass row-quality counters over the sales fact."""
    u, n, g, c = F.col("units"), F.col("net_sales"), F.col("gross_sales"), F.col("cogs")
    return sales.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(u < 0).alias("negative_units_rows"),
        F.count_if(n < 0).alias("negative_net_sales_rows"),
        F.count_if(g < n).alias("gross_less_than_net_rows"),
        F.count_if(c < 0).alias("negative_cogs_rows"),
        F.count_if((u == 0) & (n != 0)).alias("zero_units_nonzero_sales_rows"))


def gross_margin_daily(sales: DataFrame, by: Sequence[str] = ("sale_date", "store_id")) -> DataFrame:
    """Net sales, COGS, margin and margin % per day (and store)."""
    g = sales.groupBy(*by).agg(F.sum("net_sales").alias("net_sales"), F.sum("cogs").alias("cogs"),
                               F.count(F.lit(1)).alias("line_count"))
    return g.select(*by, "net_sales", "cogs", (F.col("net_sales") - F.col("cogs")).alias("gross_margin"),
                    ratio(F.col("net_sales") - F.col("cogs"), "net_sales").alias("gross_margin_pct"), "line_count")


def days_of_supply(inv: DataFrame, sales: DataFrame, keys: Sequence[str] = ("site_id", "sku"),
                   date: str = "snapshot_date", window_days: int = 28) -> DataFrame:
    """On hand (negative stock counts as none) ÷ average daily units over the trailing ``window_days``.

    ``inv`` is the deduplicated snapshot fact. Instead of expanding every snapshot by 28 days of sales,
    daily sales and snapshots are unioned into one series per key and a ``RANGE`` frame over the day number sums the
    trailing window in one pass; snapshot rows carry null units so they do not count as sales days.
    """
    day = F.unix_date(F.col(date))
    s = sales.groupBy(*keys, F.col("sale_date").alias(date)).agg(F.sum("units").alias("__u"))
    safe = F.greatest(F.col("on_hand_units").cast("double"), F.lit(0))
    series = (s.select(*keys, date, "__u", F.lit(None).cast("double").alias("on_hand_safe"), F.lit(False).alias("__inv"))
               .unionByName(inv.select(*keys, date, F.lit(None).cast("double").alias("__u"),
                                       safe.alias("on_hand_safe"), F.lit(True).alias("__inv"))))
    w = Window.partitionBy(*keys).orderBy(day).rangeBetween(-(window_days - 1), 0)
    series = series.withColumn("units_trailing", F.sum("__u").over(w))
    out = series.filter(F.col("__inv")).select(
        *keys, date, "on_hand_safe", "units_trailing",
        (F.col("units_trailing") / F.lit(float(window_days))).alias("avg_daily_units"))
    return out.withColumn("days_of_supply", ratio("on_hand_safe", "avg_daily_units"))


def instock_rate_daily(inv: DataFrame, carried: DataFrame, date: str = "snapshot_date", by: Sequence[str] = ("site_id",),
                       sku: str = "sku") -> DataFrame:
    """Share of SKUs in stock, of all in inventory and of those that the site carries on the day.

    ``carried``: (date, by, sku, is_carried), one row per key; SKUs without a row are not carried.
    """
    keys = [date, *by, sku]
    j = inv.join(carried.select(*keys, "is_carried"), keys, "left")
    held, stock = F.coalesce("is_carried", F.lit(False)), F.col("in_stock_flag")
    g = j.groupBy(date, *by).agg(
        F.count(F.lit(1)).alias("n_skus_in_inventory"), F.count_if(stock).alias("n_skus_in_stock"),
        F.count_if(held).alias("n_skus_carried"), F.count_if(held & stock).alias("n_carried_skus_in_stock"))
    return g.withColumns({"instock_rate_inventory_universe": ratio("n_skus_in_stock", "n_skus_in_inventory"),
                          "instock_rate_carried_universe": ratio("n_carried_skus_in_stock", "n_skus_carried")})


def roi_monthly(actuals: DataFrame, period: str = "period_month") -> DataFrame:
    """Ledger actuals pivoted by KPI category (A11 as filtered sums), margin over labor, contribution."""
    cat = F.col("kpi_category")
    a = actuals.groupBy(period).agg(*[F.sum(F.when(cat == k, F.col("actual_amount"))).alias(k)
                                      for k in ("net_sales", "cogs", "gross_margin", "labor_cost")])
    gm = F.coalesce(F.col("gross_margin"), F.col("net_sales") - F.col("cogs"))
    a = a.withColumn("gross_margin", gm)
    return a.select(period, "net_sales", "cogs", "gross_margin", "labor_cost",
                    (F.col("gross_margin") - F.col("labor_cost")).alias("contribution_margin"),
                    ratio("gross_margin", "labor_cost").alias("roi_gross_margin_over_labor"),
                    ratio(F.col("gross_margin") - F.col("labor_cost"), "labor_cost").alias("roi_contribution_over_labor"))


def breakeven_monthly(actuals: DataFrame, sales_daily: DataFrame, period: str = "period_month") -> DataFrame:
    """Break-even net sales for labor and the days of average sales needed to reach it."""
    cat = F.col("kpi_category")
    a = actuals.groupBy(period).agg(*[F.sum(F.when(cat == k, F.col("actual_amount"))).alias(k)
                                      for k in ("net_sales", "cogs", "labor_cost")])
    s = sales_daily.groupBy(F.trunc("sale_date", "month").alias(period)).agg(
        F.sum(F.coalesce("net_sales", F.lit(0))).alias("mart_net_sales"))
    j = a.join(s, period, "left")
    dim = F.dayofmonth(F.last_day(F.col(period)))
    gmp = ratio(F.col("net_sales") - F.col("cogs"), "net_sales")
    avg_daily = (F.when(F.col("mart_net_sales").isNotNull() & (F.col("mart_net_sales") != 0), ratio("mart_net_sales", dim))
                 .when(F.col("net_sales").isNotNull() & (F.col("net_sales") != 0), ratio("net_sales", dim)))
    be = F.when(F.col("labor_cost").isNotNull(), ratio("labor_cost", gmp))
    return j.select(period, F.col("net_sales").alias("actual_net_sales"), "cogs",
                    (F.col("net_sales") - F.col("cogs")).alias("gross_margin"), gmp.alias("gross_margin_pct"),
                    "labor_cost", be.alias("breakeven_net_sales_for_labor"),
                    avg_daily.alias("avg_daily_net_sales_in_month"),
                    ratio(be, avg_daily).alias("breakeven_days_estimate"))


def sales_per_labor_hour_daily(sales_day: DataFrame, labor_day: DataFrame, keys: Sequence[str] = ("work_date", "store_code")) -> DataFrame:
    """Store-day sales ⟕ labor hours (J2) with net and gross sales per hour (C34); days without sales are left out."""
    j = sales_day.join(labor_day, list(keys), "left")
    return j.withColumns({"net_sales_per_labor_hour": ratio("net_sales", "hours_worked"),
                          "gross_sales_per_labor_hour": ratio("gross_sales", "hours_worked")})


# Fixed severity ladder for low-margin alerts.
SEVERITY_ORDER = {"critical": 1, "high": 2, "medium": 3, "monitor": 4}


def low_margin_alerts(daily: DataFrame, keys: Sequence[str] = ("store_code", "sku", "channel"),
                      date: str = "sale_date", window_days: int = 28, as_of=None) -> DataFrame:
    """Trailing-window margin per grain, severity ladder, reason, action and a global priority rank.

    ``as_of`` defaults to the latest date in ``daily``, resolved once; as a literal it bounds the scan.
    """
    from .calendar import latest_date
    from .ranking import global_dense_rank
    end = F.lit(as_of or latest_date(daily, date)).cast("date")
    x = daily.filter((F.col(date) >= F.date_sub(end, window_days - 1)) & (F.col(date) <= end))
    z = F.lit(0)
    g = x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("source_day_count"),
        F.sum(F.coalesce("gross_sales", z)).alias("gross_sales"),
        F.sum(F.coalesce("discount_amount", z)).alias("discount_amount"),
        F.sum(F.coalesce("net_sales", z)).alias("net_sales"), F.sum(F.coalesce("cogs", z)).alias("cogs"))
    g = g.withColumns({"gross_margin": F.col("net_sales") - F.col("cogs"),
                       "gross_margin_pct": ratio(F.col("net_sales") - F.col("cogs"), "net_sales"),
                       "discount_rate": ratio("discount_amount", "gross_sales")})
    ns, gmp, dr = F.col("net_sales"), F.col("gross_margin_pct"), F.col("discount_rate")
    sev = (F.when(ns < 100, F.lit("monitor")).when((gmp < 0.25) & (ns >= 500), F.lit("critical"))
           .when((gmp < 0.30) & (ns >= 250), F.lit("high")).when(gmp < 0.35, F.lit("medium")).otherwise(F.lit("healthy")))
    why = (F.when(ns < 100, F.lit("Sales volume is low; monitor before taking action."))
           .when((gmp < 0.25) & (ns >= 500), F.lit("Gross margin is below 25% on meaningful sales volume."))
           .when((gmp < 0.30) & (ns >= 250), F.lit("Gross margin is below 30% on moderate sales volume."))
           .when(gmp < 0.35, F.lit("Gross margin is below the watchlist threshold."))
           .otherwise(F.lit("Margin appears healthy.")))
    act = (F.when(ns < 100, F.lit("Monitor; sales volume is too low for a strong decision."))
           .when((gmp < 0.25) & (dr >= 0.20), F.lit("Review promo depth and discounting strategy."))
           .when(gmp < 0.25, F.lit("Investigate pricing, COGS, or product margin erosion."))
           .when((gmp < 0.30) & (dr >= 0.15), F.lit("Check whether discounts are reducing margin below target."))
           .when(gmp < 0.35, F.lit("Add to margin watchlist and compare against trend."))
           .otherwise(F.lit("No immediate action required.")))
    g = g.withColumns({"severity": sev, "why_flagged": why, "recommended_action": act})
    g = g.filter(F.col("severity").isin(*SEVERITY_ORDER))
    sev_rank = F.create_map(*[F.lit(x) for kv in SEVERITY_ORDER.items() for x in kv])[F.col("severity")]
    g = g.withColumns({"__sev": sev_rank, "__ns": round_to(F.col("net_sales"), 4)})
    return global_dense_rank(g, [("__sev", "asc"), ("__ns", "desc")], "alert_priority_rank").drop("__sev", "__ns")


def order_rates(sales: DataFrame, period: str = "month_start") -> DataFrame:
    """Revenue per order, units per order, lines per order, discount and COGS rates."""
    g = sales.groupBy(period).agg(F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines"),
                                  F.sum("net_sales").alias("net_sales"), F.sum("units").alias("units"),
                                  F.sum("gross_sales").alias("gross_sales"), F.sum("discount_amount").alias("discount_amount"),
                                  F.sum("cogs").alias("cogs"))
    return g.select(period, "orders", ratio("net_sales", "orders").alias("revenue_per_order"),
                    ratio("units", "orders").alias("units_per_order"), ratio("lines", "orders").alias("lines_per_order"),
                    ratio("discount_amount", "gross_sales").alias("discount_rate"),
                    ratio("cogs", "net_sales").alias("cogs_pct_of_net"))


def operations_rates(shipments: DataFrame, inventory: DataFrame, labor: DataFrame, sales: DataFrame,
                     period: str = "month_start") -> DataFrame:
    """Fill, backorder, in-stock and overtime rates and labor cost share per period.

    Each fact is summed to the period before the full join; a fact without rows in a period gives null rates.
    """
    ship = shipments.groupBy(period).agg(*[F.sum(c).alias(c) for c in ("requested_units", "shipped_units", "backordered_units")])
    inv = inventory.groupBy(period).agg(F.avg(F.col("in_stock_flag").cast("int")).alias("in_stock_rate"))
    lab = labor.groupBy(period).agg(*[F.sum(c).alias(c) for c in ("labor_hours", "overtime_hours", "labor_cost_amount")])
    net = sales.groupBy(period).agg(F.sum("net_sales").alias("net_sales_amount"))
    j = ship.join(inv, period, "full").join(lab, period, "full").join(net, period, "full")
    return j.select(period, ratio("shipped_units", "requested_units").alias("fill_rate"),
                    ratio("backordered_units", "requested_units").alias("backorder_rate"), "in_stock_rate",
                    ratio("overtime_hours", F.col("labor_hours") + F.col("overtime_hours")).alias("overtime_rate"),
                    ratio("labor_cost_amount", "net_sales_amount").alias("labor_cost_pct_net_sales"))


def metric_series(series: dict[str, DataFrame]) -> DataFrame:
    """Metric name -> (date_key, location_key, value) as one long frame (metric_name, date_key, location_key, value)."""
    out = None
    for name, df in series.items():
        d = df.select(F.lit(name).alias("metric_name"), "date_key", F.col("location_key").cast("string").alias("location_key"),
                      F.col("value").cast("double").alias("value"))
        out = d if out is None else out.unionByName(d)
    return out


def anomaly_flags(series: DataFrame, lookback: int = 7, z_threshold: float = 2.0) -> DataFrame:
    """Z-score of each metric value against the previous ``lookback`` values of its location.

    ``series``: (metric_name, date_key, location_key, value), one row per metric, day and location. Baselines are the mean
    and sample deviation of the earlier values; a value is an anomaly if |z| > ``z_threshold``.
    """
    w = Window.partitionBy("metric_name", "location_key").orderBy("date_key").rowsBetween(-lookback, -1)
    out = series.withColumns({"baseline_avg": F.avg("value").over(w), "__sd": F.stddev_samp("value").over(w)})
    z = F.when(F.col("__sd") > 1e-9, (F.col("value") - F.col("baseline_avg")) / F.col("__sd"))  # a constant series has none
    return out.withColumns({"z_score": z, "is_anomaly": F.coalesce(F.abs(z) > z_threshold, F.lit(False))}).drop("__sd")


# Fixed words for the change against the previous month.
NO_PRIOR, REVIEW, WATCH, OK = "NO_PRIOR_PERIOD", "REVIEW_HIGH_VARIANCE", "WATCH_MODERATE_VARIANCE", "OK"


def mom_anomaly_status(series: DataFrame, keys: Sequence[str], period: str, value: str,
                       review: float = 0.50, watch: float = 0.25) -> DataFrame:
    """Periods whose change against the previous one (``lag``) is at least ``watch``, or that have none."""
    w = Window.partitionBy(*keys).orderBy(period)
    out = series.withColumn(f"prior_{value}", F.lag(value).over(w))
    pct = ratio(F.col(value) - F.col(f"prior_{value}"), f"prior_{value}")
    status = (F.when(F.col(f"prior_{value}").isNull(), F.lit(NO_PRIOR)).when(F.abs(pct) >= review, F.lit(REVIEW))
              .when(F.abs(pct) >= watch, F.lit(WATCH)).otherwise(F.lit(OK)))
    return out.withColumns({"mom_pct_change": pct, "anomaly_status": status}).filter(F.col("anomaly_status") != OK)
