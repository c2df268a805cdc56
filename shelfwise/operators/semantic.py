"""Semantic-layer measures (X1–X21): an aggregate evaluated under a filter context.

A measure is an aggregate ``Column``; a context is the ``groupBy`` keys plus an
optional filter.  "Ignore a slicer" contexts (ALL / ALLEXCEPT) are window sums
over the *aggregated* result partitioned by the kept keys — bounded by the
number of result rows, never by fact volume — and the grand total (ALL) is a
one-row aggregate joined back by broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import ratio, round_to


def evaluate(df: DataFrame, by: Sequence[str], measures: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Measures per ``by`` context; ``where`` is the CALCULATE filter."""
    d = df if where is None else df.filter(where)
    return d.groupBy(*by).agg(*[m.alias(k) for k, m in measures.items()])


def filtered(measure_expr: Column, cond: Column) -> Column:
    """A filtered measure inside the same aggregate pass (``sum(x) filter (where …)``)."""
    return F.when(cond, measure_expr)


def share_of_total(agg: DataFrame, value: str, keep: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Value ÷ total over the context that keeps only ``keep`` keys (ALLEXCEPT);
    ``keep=()`` is ALL (grand total, one-row aggregate broadcast back)."""
    out = out or f"{value}_share"
    return with_context_total(agg, value, keep, "sum", "__tot").withColumn(out, ratio(value, "__tot")).drop("__tot")


def with_context_total(agg: DataFrame, value: str, keep: Sequence[str], how: str, out: str) -> DataFrame:
    """Attach an aggregate of ``value`` over the context keeping only ``keep`` keys.

    Totals come from a partial-combined ``groupBy`` joined back on the kept keys
    (a one-row total is broadcast on a constant key) instead of a window, so a
    context holding very many rows is never gathered into one task.
    """
    fn = {"sum": F.sum, "avg": F.avg}[how]
    if keep:
        tot = agg.groupBy(*keep).agg(fn(value).alias(out))
        return agg.join(tot, list(keep), "left")
    tot = agg.agg(fn(value).alias(out)).withColumn("__k", F.lit(1))
    return agg.withColumn("__k", F.lit(1)).join(F.broadcast(tot), "__k").drop("__k")


def to_date(agg: DataFrame, date: str, value: str, grain: str = "month", by: Sequence[str] = (),
            out: str | None = None) -> DataFrame:
    """MTD / QTD / YTD running totals (running sum within the period partition)."""
    out = out or f"{value}_{grain[0]}td"
    w = Window.partitionBy(*by, F.date_trunc(grain, F.col(date))).orderBy(date) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return agg.withColumn(out, F.sum(value).over(w))


def period_shift(agg: DataFrame, period: str, keys: Sequence[str], value: str, months: int,
                 out: str) -> DataFrame:
    """Value of the same keys ``months`` earlier (equi join on the shifted month) and growth %."""
    prev = agg.select(F.add_months(F.col(period), months).alias(period), *keys, F.col(value).alias(out))
    j = agg.join(prev, [period, *keys], "left")
    return j.withColumn(f"{out}_growth_pct", ratio(F.col(value) - F.col(out), out))


def ytd_growth(agg: DataFrame, period: str, keys: Sequence[str], value: str) -> DataFrame:
    """Year-to-date total, the same months of the year before, and the growth between them.

    ``agg`` has one row per month and keys; a month without its counterpart a year earlier has no growth.
    """
    w = Window.partitionBy(*keys, F.year(period)).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ytd = agg.select(period, *keys, F.sum(value).over(w).alias(f"{value}_ytd"))
    return period_shift(ytd, period, keys, f"{value}_ytd", 12, f"{value}_pytd")


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c)


def rolling_months(agg: DataFrame, period: str, value: str, months: int, how: str = "sum",
                   by: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Trailing ``months`` window over a month number (RANGE frame, gaps respected)."""
    out = out or f"{value}_{how}_{months}m"
    w = Window.partitionBy(*by).orderBy(month_index(F.col(period))).rangeBetween(-(months - 1), 0)
    fn = {"sum": F.sum, "avg": F.avg}[how]
    return agg.withColumn(out, fn(value).over(w))


def rank_measures(agg: DataFrame, value: str, by: Sequence[str] = (), top_n: int = 10,
                  tie: Sequence[str] = ()) -> DataFrame:
    """Rank, dense rank, top-N flag and percent rank within the context.

    Uses ``ranking.distributed_rank`` so a context with very many rows (e.g. all
    stores of a month) is ranked across several tasks, not gathered into one.
    """
    from .ranking import distributed_rank
    r = distributed_rank(agg, list(by), [(value, "desc"), *[(c, "asc") for c in tie]], prefix="__")
    return r.withColumns({
        f"{value}_rank": F.col("__rank"), f"{value}_dense_rank": F.col("__dense_rank"),
        f"{value}_percent_rank": F.col("__percent_rank"), f"is_top_{top_n}": F.col("__row_number") <= top_n,
    }).drop("__rank", "__dense_rank", "__percent_rank", "__row_number")


def banding(c: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """SWITCH(TRUE()) banding — first band whose lower bound the value reaches (bands descending)."""
    expr = None
    for lower, label in bands:
        cond = c >= lower
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def mape(df: DataFrame, by: Sequence[str], actual: str, forecast: str) -> DataFrame:
    """Absolute percentage error at row grain, then averaged (rows with actual 0 skipped)."""
    ape = ratio(F.abs(F.col(actual) - F.col(forecast)), actual)
    return df.groupBy(*by).agg(F.avg(F.when(F.col(actual) != 0, ape)).alias("mape"),
                               F.count_if(F.col(actual) != 0).alias("rows_scored"))


def repeat_customers(orders: DataFrame, period: str, customer: str, order_id: str) -> DataFrame:
    """X11: customers with more than one order in the period, and the repeat rate (two-stage agg)."""
    per = orders.groupBy(period, customer).agg(F.count_distinct(order_id).alias("__orders"))
    g = per.groupBy(period).agg(F.count(F.lit(1)).alias("customers"),
                                F.count_if(F.col("__orders") > 1).alias("repeat_customers"))
    return g.withColumn("repeat_rate", ratio("repeat_customers", "customers"))


def retained_intersect(active: DataFrame, period: str, entity: str) -> DataFrame:
    """Accounts active this period *and* last period (INTERSECT of the two sets)."""
    cur = active.select(period, entity).distinct()
    prev = cur.select(F.add_months(F.col(period), 1).alias(period), entity)
    both = cur.intersect(prev)
    return both.groupBy(period).agg(F.count(F.lit(1)).alias("retained_accounts"))


def cohort_revenue(sales: DataFrame, customer: str, period: str, value: str) -> DataFrame:
    """Revenue by first-purchase cohort (min period per customer joined back) and period."""
    first = sales.groupBy(customer).agg(F.min(period).alias("cohort_period"))
    j = sales.join(first, customer)
    g = j.groupBy("cohort_period", period).agg(F.sum(value).alias("revenue"),
                                               F.count_distinct(customer).alias("active_customers"))
    return g.withColumn("months_since_first", F.months_between(F.col(period), F.col("cohort_period")).cast("int"))


def above_average(agg: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Flag groups whose value is above the context average."""
    out = with_context_total(agg, value, list(by), "avg", f"avg_{value}")
    return out.withColumn(f"is_above_avg_{value}", F.col(value) > F.col(f"avg_{value}"))


def new_customers(sales: DataFrame, customer: str, period: str) -> DataFrame:
    """Customers whose first purchase falls in the period."""
    first = sales.groupBy(customer).agg(F.min(period).alias(period))
    return first.groupBy(period).agg(F.count(F.lit(1)).alias("new_customers"))


def seasonal_index(agg: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Average value of a calendar month ÷ the overall monthly average."""
    m = agg.withColumn("__moy", F.month(period))
    g = m.groupBy(*by, "__moy").agg(F.avg(value).alias("__avg_moy"))
    g = with_context_total(g, "__avg_moy", list(by), "avg", "__avg_all")
    return g.select(*by, F.col("__moy").alias("month_of_year"), ratio("__avg_moy", "__avg_all").alias("seasonal_index"))


def distribution_velocity(sales: DataFrame, period: str, product: str, store: str, units: str = "units",
                          week: str = "week_start") -> DataFrame:
    """Distribution % (selling stores ÷ active stores in the period), rate of sale, and unit velocity per store and
    week (weeks in context: the distinct weeks of the period)."""
    sell = sales.filter(F.col(units) > 0)
    g = sell.groupBy(period, product).agg(F.count_distinct(store).alias("selling_stores"), F.sum(units).alias("units"))
    tot = sales.groupBy(period).agg(F.count_distinct(store).alias("active_stores"), F.count_distinct(week).alias("weeks_in_context"))
    j = g.join(tot, period)
    return j.withColumns({"distribution_pct": ratio("selling_stores", "active_stores"),
                          "rate_of_sale": ratio("units", "selling_stores"),
                          "velocity_per_store_week": ratio("units", F.col("selling_stores") * F.col("weeks_in_context"))})


def pvm_vs_prior(sales: DataFrame, period: str, keys: Sequence[str], months: int = 1) -> DataFrame:
    """Price / volume / mix per key versus the period ``months`` earlier (K10 definitions)."""
    m = sales.groupBy(period, *keys).agg(F.sum("units").alias("units"), F.sum("net_sales").alias("net_sales"))
    m = m.withColumn("price", ratio("net_sales", "units"))
    prev = m.select(F.add_months(F.col(period), months).alias(period), *keys, F.col("units").alias("prior_units"),
                    F.col("net_sales").alias("prior_sales"), F.col("price").alias("prior_price"))
    j = m.join(prev, [period, *keys], "left")
    z = F.lit(0)
    total = F.col("net_sales") - F.coalesce("prior_sales", z)
    price = F.coalesce("prior_units", z) * (F.coalesce("price", z) - F.coalesce("prior_price", z))
    volume = F.coalesce("prior_price", z) * (F.col("units") - F.coalesce("prior_units", z))
    return j.select(period, *keys, "net_sales", "prior_sales", total.alias("revenue_change"),
                    price.alias("price_effect"), volume.alias("volume_effect"), (total - price - volume).alias("mix_effect"))


def inventory_health_score(inv: DataFrame, sales: DataFrame, period: str, keys: Sequence[str],
                           inv_keys: Sequence[str], turnover_target: float = 12.0) -> DataFrame:
    """Turnover, days on hand, in-stock rate and a 0–1 health score
    (half in-stock rate, half turnover against a target)."""
    i = inv.groupBy(period, *keys).agg(F.avg("on_hand_units").alias("avg_on_hand"),
                                       ratio(F.count_if(F.col("on_hand_units") > 0), F.count(F.lit(1))).alias("instock_rate"))
    s = sales.groupBy(period, *keys).agg(F.sum("units").alias("units_sold"))
    j = i.join(s, [period, *keys], "left")
    dim = F.dayofmonth(F.last_day(F.col(period)))
    turnover = ratio(F.coalesce("units_sold", F.lit(0)) * 12.0, "avg_on_hand")
    j = j.withColumns({"annualised_turnover": turnover,
                       "days_on_hand": ratio("avg_on_hand", ratio("units_sold", dim))})
    score = F.lit(0.5) * F.col("instock_rate") + F.lit(0.5) * F.least(F.coalesce(F.col("annualised_turnover"), F.lit(0))
                                                                      / F.lit(turnover_target), F.lit(1.0))
    return j.withColumn("health_score", F.greatest(score, F.lit(0)))


def emissions_measures(fact: DataFrame, revenue: DataFrame, period: str = "activity_month",
                       min_reportable_rate: float = 0.95) -> DataFrame:
    """T CO2e by scope, reportable row rate, intensity per $1K and a status."""
    rep = F.col("is_reportable_emissions_row")
    t = F.when(rep, F.col("metric_tons_co2e"))
    g = fact.groupBy(period).agg(
        *[F.sum(F.when(F.col("scope") == f"Scope {i}", t)).alias(f"scope{i}_t") for i in (1, 2, 3)],
        F.sum(t).alias("total_t"), F.count(F.lit(1)).alias("rows"), F.count_if(rep).alias("reportable_rows"))
    r = revenue.groupBy(F.col("month_start").alias(period)).agg(F.sum("net_sales").alias("revenue"))
    j = g.join(r, period, "left").withColumns({
        "reportable_rate": ratio("reportable_rows", "rows"),
        "t_per_1k_revenue": ratio(F.col("total_t") * 1000.0, "revenue")})
    return j.withColumn("emissions_status", F.when(F.col("reportable_rate") < min_reportable_rate, F.lit("Review"))
                        .otherwise(F.lit("OK")))


def fifo_layers(receipts: DataFrame, issues: DataFrame, keys: Sequence[str], date: str = "date", qty: str = "units") -> DataFrame:
    """Which receipt each issued unit came from, first in first out: (keys, receipt_date, issue_date, units).

    Receipts and issues are summed by key and day, and both get running sums. Between two neighbouring sums of either side
    all units have the same receipt and the same issue: those of the next sum of each side. So one pass over the merged sums of
    a key (at most two rows a day) matches them, without joining receipts to issues. ``issue_date`` is null for what is
    left in stock, ``receipt_date`` for issues beyond all receipts.
    """
    by_day = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def sums(df: DataFrame, own: str, other: str) -> DataFrame:
        d = df.filter(F.col(qty) > 0).groupBy(*keys, date).agg(F.sum(qty).alias("__q"))
        return d.select(*keys, F.sum("__q").over(by_day).alias("__upto"), F.col(date).alias(own), F.lit(None).cast("date").alias(other))

    merged = sums(receipts, "receipt_date", "issue_date").unionByName(sums(issues, "issue_date", "receipt_date"))
    order = Window.partitionBy(*keys).orderBy("__upto", F.col("receipt_date").asc_nulls_last())
    ahead = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return merged.select(
        *keys, F.first("receipt_date", ignorenulls=True).over(ahead).alias("receipt_date"),
        F.first("issue_date", ignorenulls=True).over(ahead).alias("issue_date"),
        (F.col("__upto") - F.coalesce(F.lag("__upto").over(order), F.lit(0))).alias("units")).filter(F.col("units") > 0)


AGE_BUCKETS = ((0, 30, "0_30"), (31, 60, "31_60"), (61, 90, "61_90"), (91, None, "90_plus"))


def aged_inventory(layers: DataFrame, by: Sequence[str], as_of, buckets=AGE_BUCKETS) -> DataFrame:
    """Stock left on ``as_of`` by age of its receipt, the share older than 90 days, units issued and their mean days in
    stock (weighted by units), and units issued without a receipt."""
    age = F.datediff(F.lit(as_of).cast("date"), "receipt_date")
    left = F.col("issue_date").isNull()
    matched = ~left & F.col("receipt_date").isNotNull()
    u = F.col("units")
    within = lambda lo, hi: left & (age >= lo) & (F.lit(True) if hi is None else age <= hi)
    g = layers.groupBy(*by).agg(
        F.sum(F.when(left, u).otherwise(0)).alias("on_hand_units"),
        *[F.sum(F.when(within(lo, hi), u).otherwise(0)).alias(f"units_{name}") for lo, hi, name in buckets],
        F.sum(F.when(matched, u).otherwise(0)).alias("issued_units"),
        F.sum(F.when(matched, u * F.datediff("issue_date", "receipt_date"))).alias("__unit_days"),
        F.sum(F.when(F.col("receipt_date").isNull(), u).otherwise(0)).alias("unreceived_units"))
    oldest = buckets[-1][2]
    return g.withColumns({"aged_share": ratio(f"units_{oldest}", "on_hand_units"),
                          "mean_days_in_stock": ratio("__unit_days", "issued_units")}).drop("__unit_days")


def unit_turnover(snapshots: DataFrame, issued: DataFrame, by: Sequence[str], date: str = "snapshot_date",
                  on_hand: str = "on_hand_units", units: str = "units") -> DataFrame:
    """Inventory turnover in units: units sold / average over the dates of the units on hand on each."""
    days = snapshots.groupBy(*by, date).agg(F.sum(F.greatest(on_hand, F.lit(0))).alias("__on_hand"))
    avg = days.groupBy(*by).agg(F.avg("__on_hand").alias("avg_inventory_units"))
    sold = issued.groupBy(*by).agg(F.sum(units).alias("volume_units"))
    return avg.join(sold, list(by), "left").withColumn("inventory_turnover", ratio("volume_units", "avg_inventory_units"))


def since_launch(sales: DataFrame, entity: str, date: str, as_of) -> DataFrame:
    """Sales up to ``as_of`` with the entity's own first sale date and the days since it."""
    upto = sales.filter(F.col(date) <= F.lit(as_of).cast("date"))
    start = upto.groupBy(entity).agg(F.min(date).alias("launch_date"))
    return upto.join(start, entity).withColumn("days_since_launch", F.datediff(date, "launch_date"))


def launch_success(sales: DataFrame, forecasts: DataFrame, entity: str, date: str, value: str, as_of,
                   days: int = 90) -> DataFrame:
    """Revenue of each entity's first ``days`` days against its launch forecast (entity, launch_forecast).

    The window starts at the entity's own launch; ``window_complete`` tells whether it has passed by ``as_of``.
    """
    s = since_launch(sales, entity, date, as_of)
    g = s.groupBy(entity, "launch_date").agg(
        F.sum(F.when(F.col("days_since_launch") < days, F.col(value))).alias("launch_revenue"), F.sum(value).alias("revenue_to_date"))
    j = g.join(forecasts.select(entity, "launch_forecast"), entity, "left")
    return j.withColumns({"launch_success": ratio("launch_revenue", "launch_forecast"),
                          "window_complete": F.date_add("launch_date", days) <= F.lit(as_of).cast("date")})


def new_product_ramp(sales: DataFrame, entity: str, date: str, value: str, as_of, months: int = 6) -> DataFrame:
    """Revenue of the entities launched in the ``months`` before ``as_of`` by week since their own launch."""
    s = since_launch(sales, entity, date, as_of).filter(F.col("launch_date") >= F.add_months(F.lit(as_of).cast("date"), -months))
    return s.groupBy(F.floor(F.col("days_since_launch") / 7).cast("int").alias("weeks_since_launch")).agg(
        F.count_distinct(entity).alias("selling_products"), F.sum(value).alias("new_product_revenue"))


def _year_over_year(agg: DataFrame, period: str, keys: Sequence[str], values: Sequence[str], months: int) -> DataFrame:
    """``agg`` full outer joined with itself ``months`` earlier (``prior_*``, all values 0 where a side is missing), for periods
    that have a prior period at all."""
    prior = agg.select(F.add_months(F.col(period), months).alias(period), *keys, *[F.col(v).alias(f"prior_{v}") for v in values])
    both = agg.select(period).distinct().join(prior.select(period).distinct(), period)
    j = agg.select(period, *keys, *values).join(prior, [period, *keys], "full").join(both, period, "left_semi")
    return j.select(period, *keys, *[F.coalesce(v, F.lit(0)).alias(v) for c in values for v in (c, f"prior_{c}")])


def cannibalisation(sales: DataFrame, period: str, key: str, value: str, months: int = 12) -> DataFrame:
    """How much of a category's loss against the prior period stands against gains of others.

    Losses and gains are totalled per period; the lesser total is what can have moved. It is dealt to losing categories by their
    losses and to gaining ones by their gains, so no pairs of categories are formed.
    """
    agg = sales.groupBy(period, key).agg(F.sum(value).alias("revenue"))
    j = _year_over_year(agg, period, [key], ["revenue"], months)
    change = F.col("revenue") - F.col("prior_revenue")
    j = j.withColumns({"revenue_loss": F.greatest(-change, F.lit(0)), "revenue_gain": F.greatest(change, F.lit(0))})
    total = j.groupBy(period).agg(F.sum("revenue_loss").alias("total_loss"), F.sum("revenue_gain").alias("total_gain"))
    moved = F.least("total_loss", "total_gain")
    return j.join(total, period).withColumns({
        "cannibalised_loss": F.when(F.col("revenue_loss") > 0, ratio(F.col("revenue_loss") * moved, "total_loss")).otherwise(0.0),
        "cannibalising_gain": F.when(F.col("revenue_gain") > 0, ratio(F.col("revenue_gain") * moved, "total_gain")).otherwise(0.0)})


def mix_change(sales: DataFrame, period: str, key: str, value: str, margin: str, months: int = 12) -> DataFrame:
    """Change of each category's share against the prior period, and of the total margin rate split into a within effect
    (the category's own rate moved, at its mean share) and a between effect (its share moved, at its mean rate against the mean of both
    periods' total rates). Over all categories the two effects add up to the change of the total rate."""
    agg = sales.groupBy(period, key).agg(F.sum(value).alias("revenue"), F.sum(margin).alias("margin"))
    j = _year_over_year(agg, period, [key], ["revenue", "margin"], months)
    total = j.groupBy(period).agg(*[F.sum(c).alias(f"__{c}") for c in ("revenue", "prior_revenue", "margin", "prior_margin")])
    j = j.join(total, period)
    z = F.lit(0.0)
    share, prior = F.coalesce(ratio("revenue", "__revenue"), z), F.coalesce(ratio("prior_revenue", "__prior_revenue"), z)
    # A category without revenue on one side has moved in share only: its rate is that of the other side.
    now, before = ratio("margin", "revenue"), ratio("prior_margin", "prior_revenue")
    rate, prior_rate = F.coalesce(now, before, z), F.coalesce(before, now, z)
    overall = (F.coalesce(ratio("__margin", "__revenue"), z) + F.coalesce(ratio("__prior_margin", "__prior_revenue"), z)) / 2
    return j.select(
        period, key, "revenue", "prior_revenue", share.alias("mix"), prior.alias("prior_mix"), (share - prior).alias("mix_change"),
        now.alias("margin_rate"), before.alias("prior_margin_rate"),
        ((share + prior) / 2 * (rate - prior_rate)).alias("within_effect"),
        ((share - prior) * ((rate + prior_rate) / 2 - overall)).alias("between_effect"))


def low_margin_high_volume(sales: DataFrame, context: Sequence[str], key: str, max_margin: float = 0.5,
                           min_volume: float = 0.05) -> DataFrame:
    """Products whose margin is below ``max_margin`` and whose share of the context's units is above ``min_volume``."""
    g = sales.groupBy(*context, key).agg(F.sum("net_sales").alias("revenue"), F.sum("units").alias("units"),
                                         F.sum(F.col("net_sales") - F.col("cogs")).alias("gross_margin"))
    g = share_of_total(g, "units", context, "volume_share").withColumn("gross_margin_pct", ratio("gross_margin", "revenue"))
    return g.filter((F.col("gross_margin_pct") < max_margin) & (F.col("volume_share") > min_volume))
