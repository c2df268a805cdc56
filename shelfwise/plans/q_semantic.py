"""Semantic-layer measure queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..operators import history, semantic as S, variance
from ..sources.testdata import Tables
from . import model
from .oracle import FORECAST_EXTRACT, INVENTORY, PUNCHES, SALES_LINES
from .q_history import PAIRS_CTE
from .q_variance import _fva
from .registry import query, rounded


def _sales(spark, d):
    return model.sales_lines(Tables(spark, d))


X3_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, category, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2)
SELECT month_start, category, round(net_sales, 4) AS net_sales,
       round(net_sales / NULLIF(SUM(net_sales) OVER (PARTITION BY month_start), 0), 4) AS share_in_month,
       round(net_sales / NULLIF(SUM(net_sales) OVER (), 0), 4) AS share_of_total
FROM a
"""


@query("x3_share_of_total", X3_SQL)
def q_x3(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "category"], {"net_sales": F.sum("net_sales")})
    a = S.share_of_total(a, "net_sales", ["month_start"], "share_in_month")
    return rounded(S.share_of_total(a, "net_sales", [], "share_of_total"))


X5_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT sale_date, SUM(net_sales) AS net_sales, SUM(net_sales) FILTER (WHERE promo_flag) AS promo_net_sales
      FROM sales_lines GROUP BY 1)
SELECT sale_date, round(net_sales, 4) AS net_sales, round(promo_net_sales, 4) AS promo_net_sales,
       round(SUM(net_sales) OVER (PARTITION BY date_trunc('month', sale_date) ORDER BY sale_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS net_sales_mtd,
       round(SUM(net_sales) OVER (PARTITION BY date_trunc('quarter', sale_date) ORDER BY sale_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS net_sales_qtd,
       round(SUM(net_sales) OVER (PARTITION BY date_trunc('year', sale_date) ORDER BY sale_date
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS net_sales_ytd
FROM a
"""


@query("x5_to_date_totals", X5_SQL)
def q_x5(spark, d):
    a = S.evaluate(_sales(spark, d), ["sale_date"], {
        "net_sales": F.sum("net_sales"),
        "promo_net_sales": F.sum(S.filtered(F.col("net_sales"), F.col("promo_flag")))})
    for g in ("month", "quarter", "year"):
        a = S.to_date(a, "sale_date", "net_sales", g)
    return rounded(a)


X6_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, state, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2),
j AS (SELECT c.*, p.net_sales AS prior_month_sales, y.net_sales AS same_month_last_year
      FROM a c LEFT JOIN a p ON p.state = c.state AND p.month_start = CAST(c.month_start - INTERVAL 1 MONTH AS DATE)
      LEFT JOIN a y ON y.state = c.state AND y.month_start = CAST(c.month_start - INTERVAL 12 MONTH AS DATE))
SELECT month_start, state, round(net_sales, 4) AS net_sales, round(prior_month_sales, 4) AS prior_month_sales,
       round((net_sales - prior_month_sales) / NULLIF(prior_month_sales, 0), 4) AS prior_month_sales_growth_pct,
       round(same_month_last_year, 4) AS same_month_last_year,
       round((net_sales - same_month_last_year) / NULLIF(same_month_last_year, 0), 4) AS same_month_last_year_growth_pct
FROM j
"""


@query("x6_period_shift_growth", X6_SQL)
def q_x6(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "state"], {"net_sales": F.sum("net_sales")})
    a = S.period_shift(a, "month_start", ["state"], "net_sales", 1, "prior_month_sales")
    a = S.period_shift(a, "month_start", ["state"], "net_sales", 12, "same_month_last_year")
    return rounded(a)


X6Y_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, state, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2),
y AS (SELECT month_start, state, SUM(net_sales) OVER (PARTITION BY state, year(month_start) ORDER BY month_start) AS net_sales_ytd FROM a)
SELECT c.month_start, c.state, round(c.net_sales_ytd, 4) AS net_sales_ytd, round(p.net_sales_ytd, 4) AS net_sales_pytd,
       round((c.net_sales_ytd - p.net_sales_ytd) / NULLIF(p.net_sales_ytd, 0), 4) AS net_sales_pytd_growth_pct
FROM y c LEFT JOIN y p ON p.state = c.state AND p.month_start = CAST(c.month_start - INTERVAL 12 MONTH AS DATE)
"""


@query("x6_ytd_growth", X6Y_SQL)
def q_x6_ytd(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "state"], {"net_sales": F.sum("net_sales")})
    return rounded(S.ytd_growth(a, "month_start", ["state"], "net_sales"))


X7_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, category, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2)
SELECT month_start, category, round(net_sales, 4) AS net_sales,
       round(AVG(net_sales) OVER (PARTITION BY category ORDER BY year(month_start) * 12 + month(month_start)
                                  RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS net_sales_avg_3m,
       round(SUM(net_sales) OVER (PARTITION BY category ORDER BY year(month_start) * 12 + month(month_start)
                                  RANGE BETWEEN 11 PRECEDING AND CURRENT ROW), 4) AS net_sales_sum_12m
FROM a
"""


@query("x7_rolling_months", X7_SQL)
def q_x7(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "category"], {"net_sales": F.sum("net_sales")})
    a = S.rolling_months(a, "month_start", "net_sales", 3, "avg", ["category"])
    return rounded(S.rolling_months(a, "month_start", "net_sales", 12, "sum", ["category"]))


X8_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, store_id, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2)
SELECT month_start, store_id, round(net_sales, 4) AS net_sales,
       CAST(rank() OVER w AS INTEGER) AS net_sales_rank, CAST(dense_rank() OVER w AS INTEGER) AS net_sales_dense_rank,
       round(percent_rank() OVER w, 4) AS net_sales_percent_rank, row_number() OVER w <= 10 AS is_top_10
FROM a WINDOW w AS (PARTITION BY month_start ORDER BY net_sales DESC, store_id)
"""


@query("x8_rank_top_n", X8_SQL)
def q_x8(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "store_id"], {"net_sales": F.sum("net_sales")})
    return rounded(S.rank_measures(a, "net_sales", ["month_start"], 10, tie=["store_id"]))


# Fixed tier thresholds for lifetime account net sales.
TIERS = ((3_000_000.0, "Platinum"), (2_000_000.0, "Gold"), (1_000_000.0, "Silver"))

X9_SQL = f"""
WITH {SALES_LINES}
SELECT store_id, round(SUM(net_sales), 4) AS net_sales,
       CASE WHEN SUM(net_sales) >= 3000000.0 THEN 'Platinum' WHEN SUM(net_sales) >= 2000000.0 THEN 'Gold'
            WHEN SUM(net_sales) >= 1000000.0 THEN 'Silver' ELSE 'Bronze' END AS account_tier
FROM sales_lines GROUP BY 1
"""


@query("x9_banding_tiers", X9_SQL)
def q_x9(spark, d):
    a = S.evaluate(_sales(spark, d), ["store_id"], {"net_sales": F.sum("net_sales")})
    return rounded(a.withColumn("account_tier", S.banding(F.col("net_sales"), TIERS, "Bronze")))


X10_SQL = f"""
WITH {FORECAST_EXTRACT}
SELECT channel, round(AVG(CASE WHEN actual_net_sales <> 0
                              THEN abs(actual_net_sales - forecast_net_sales) / actual_net_sales END), 4) AS mape,
       count(*) FILTER (WHERE actual_net_sales <> 0) AS rows_scored
FROM fva GROUP BY 1
"""


@query("x10_mape", X10_SQL)
def q_x10(spark, d):
    return rounded(S.mape(_fva(Tables(spark, d)), ["channel"], "actual_net_sales", "forecast_net_sales"))


X11_SQL = f"""
WITH {SALES_LINES},
p AS (SELECT month_start, store_id, COUNT(DISTINCT order_id) AS n FROM sales_lines GROUP BY 1, 2)
SELECT month_start, COUNT(*) AS customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
       round(CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE) / NULLIF(COUNT(*), 0), 4) AS repeat_rate
FROM p GROUP BY 1
"""


@query("x11_repeat_customers", X11_SQL)
def q_x11(spark, d):
    return rounded(S.repeat_customers(_sales(spark, d), "month_start", "store_id", "order_id"))


X12_SQL = f"""
WITH {SALES_LINES},
c AS (SELECT DISTINCT month_start, store_id FROM sales_lines),
b AS (SELECT month_start, store_id FROM c INTERSECT
      SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE), store_id FROM c)
SELECT month_start, COUNT(*) AS retained_accounts FROM b GROUP BY 1
"""


@query("x12_retained_intersect", X12_SQL)
def q_x12(spark, d):
    return S.retained_intersect(_sales(spark, d), "month_start", "store_id")


X15_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, category, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2),
m AS (SELECT category, CAST(month(month_start) AS INTEGER) AS month_of_year, AVG(net_sales) AS am FROM a GROUP BY 1, 2)
SELECT category, month_of_year, round(am / NULLIF(AVG(am) OVER (PARTITION BY category), 0), 4) AS seasonal_index FROM m
"""


@query("x15_seasonal_index", X15_SQL)
def q_x15(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "category"], {"net_sales": F.sum("net_sales")})
    return rounded(S.seasonal_index(a, "month_start", "net_sales", ["category"]))


X16_SQL = f"""
WITH {SALES_LINES},
f AS (SELECT store_id, min(month_start) AS cohort_period FROM sales_lines GROUP BY 1)
SELECT cohort_period, month_start, round(SUM(net_sales), 4) AS revenue, COUNT(DISTINCT s.store_id) AS active_customers,
       CAST(datediff('month', cohort_period, month_start) AS INTEGER) AS months_since_first
FROM sales_lines s JOIN f USING (store_id) GROUP BY 1, 2
"""


@query("x16_cohort_revenue", X16_SQL)
def q_x16(spark, d):
    return rounded(S.cohort_revenue(_sales(spark, d), "store_id", "month_start", "net_sales"))


X17_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, category, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2)
SELECT month_start, category, round(net_sales, 4) AS net_sales,
       round(AVG(net_sales) OVER (PARTITION BY month_start), 4) AS avg_net_sales,
       net_sales > AVG(net_sales) OVER (PARTITION BY month_start) AS is_above_avg_net_sales
FROM a
"""


@query("x17_above_average", X17_SQL)
def q_x17(spark, d):
    a = S.evaluate(_sales(spark, d), ["month_start", "category"], {"net_sales": F.sum("net_sales")})
    return rounded(S.above_average(a, "net_sales", ["month_start"]))


X18_SQL = f"""
WITH {SALES_LINES},
r AS (SELECT n_name AS state, 0.05 + 0.01 * (n_nationkey % 5) AS excise_rate FROM nation)
SELECT month_start, s.state, round(SUM(net_sales), 4) AS net_sales, round(MAX(excise_rate), 4) AS excise_rate,
       round(SUM(net_sales * excise_rate), 4) AS excise_tax
FROM sales_lines s JOIN r ON s.state = r.state GROUP BY 1, 2
"""


@query("x18_excise_tax", X18_SQL)
def q_x18(spark, d):
    t = Tables(spark, d)
    # Rate table by rule from the nation key (25 rows by schema definition).
    rates = t.nation.select(F.col("n_name").alias("state"),
                            (F.lit(0.05) + F.lit(0.01) * (F.col("n_nationkey") % 5)).alias("excise_rate"))
    s = model.sales_lines(t).join(F.broadcast(rates), "state")
    return rounded(s.groupBy("month_start", "state").agg(
        F.sum("net_sales").alias("net_sales"), F.max("excise_rate").alias("excise_rate"),
        F.sum(F.col("net_sales") * F.col("excise_rate")).alias("excise_tax")))


X20_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {PAIRS_CTE},
s AS (SELECT month_start, SUM(net_sales) AS net_sales, SUM(net_sales - cogs) AS gross_margin FROM sales_lines GROUP BY 1),
dly AS (SELECT month_start, sale_date, SUM(net_sales) AS day_sales FROM sales_lines GROUP BY 1, 2),
md AS (SELECT month_start, median(day_sales) AS median_daily_sales FROM dly GROUP BY 1),
i AS (SELECT month_start, CAST(count(*) FILTER (WHERE on_hand_units > 0) AS DOUBLE) / COUNT(*) AS instock_rate,
             SUM(greatest(on_hand_units, 0.0)) AS on_hand FROM inventory GROUP BY 1),
u AS (SELECT month_start, SUM(units) / day(last_day(month_start)) AS daily_units FROM sales_lines GROUP BY 1),
l AS (SELECT CAST(date_trunc('month', work_date) AS DATE) AS month_start, SUM(minutes_worked) / 60.0 AS labor_hours
      FROM pm GROUP BY 1),
k AS (SELECT month_start FROM s UNION SELECT month_start FROM i UNION SELECT month_start FROM l)
SELECT k.month_start, round(net_sales, 4) AS net_sales, round(gross_margin, 4) AS gross_margin,
       round(median_daily_sales, 4) AS median_daily_sales, round(labor_hours, 4) AS labor_hours,
       round(net_sales / NULLIF(labor_hours, 0), 4) AS sales_per_labor_hour, round(instock_rate, 4) AS instock_rate,
       round(on_hand / NULLIF(daily_units, 0), 4) AS days_of_supply
FROM k LEFT JOIN u USING (month_start) LEFT JOIN s USING (month_start) LEFT JOIN md USING (month_start) LEFT JOIN i USING (month_start)
LEFT JOIN l USING (month_start)
"""


@query("x20_exec_monthly_totals", X20_SQL)
def q_x20(spark, d):
    t = Tables(spark, d)
    # Sales by day first: month totals and the median of the days come from that one pass.
    daily = model.sales_lines(t).groupBy("month_start", "sale_date").agg(
        F.sum("net_sales").alias("day_sales"), F.sum("units").alias("units"),
        F.sum(F.col("net_sales") - F.col("cogs")).alias("gross_margin"))
    sm = daily.groupBy("month_start").agg(
        F.sum("day_sales").alias("net_sales"), F.sum("units").alias("units"), F.sum("gross_margin").alias("gross_margin"),
        F.median("day_sales").alias("median_daily_sales"))
    inv = model.inventory(t).groupBy("month_start").agg(
        ratio(F.count_if(F.col("on_hand_units") > 0), F.count(F.lit(1))).alias("instock_rate"),
        F.sum(F.greatest("on_hand_units", F.lit(0.0))).alias("on_hand"))
    lab = history.pair_events(model.punches(t)).groupBy(F.trunc("work_date", "month").alias("month_start")) \
        .agg((F.sum("minutes_worked") / 60.0).alias("labor_hours"))
    j = sm.join(inv, "month_start", "full").join(lab, "month_start", "full")
    return rounded(j.select("month_start", "net_sales", "gross_margin", "median_daily_sales", "labor_hours",
                            ratio("net_sales", "labor_hours").alias("sales_per_labor_hour"), "instock_rate",
                            ratio("on_hand", ratio("units", F.dayofmonth(F.last_day("month_start")))).alias("days_of_supply")))


X21_SQL = f"""
WITH {SALES_LINES}
SELECT month_start, COUNT(*) AS new_customers FROM (SELECT store_id, min(month_start) AS month_start
                                                   FROM sales_lines GROUP BY 1) GROUP BY 1
"""


@query("x21_new_customers", X21_SQL)
def q_x21(spark, d):
    return S.new_customers(_sales(spark, d), "store_id", "month_start")
