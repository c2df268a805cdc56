"""Variance queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import staging, variance
from ..sources.testdata import Tables
from . import model, raw
from .oracle import FORECAST_EXTRACT, SALES_LINES
from .registry import query, rounded

K10_SQL = f"""
WITH {SALES_LINES},
m AS (SELECT month_start, sku, SUM(units) AS units, SUM(net_sales) AS net_sales,
             SUM(net_sales) / NULLIF(SUM(units), 0) AS net_price FROM sales_lines GROUP BY 1, 2),
cp AS (SELECT c.month_start, c.sku, c.units, c.net_sales, c.net_price, p.units AS prev_units,
              p.net_sales AS prev_sales, p.net_price AS prev_price
       FROM m c LEFT JOIN m p ON p.sku = c.sku AND p.month_start = CAST(c.month_start - INTERVAL 1 MONTH AS DATE)),
d AS (SELECT month_start, COALESCE(net_sales, 0) - COALESCE(prev_sales, 0) AS rv,
             COALESCE(prev_units, 0) * (COALESCE(net_price, 0) - COALESCE(prev_price, 0)) AS pe,
             COALESCE(prev_price, 0) * (COALESCE(units, 0) - COALESCE(prev_units, 0)) AS ve FROM cp)
SELECT month_start, round(SUM(rv), 4) AS revenue_variance, round(SUM(pe), 4) AS price_effect,
       round(SUM(ve), 4) AS volume_effect, round(SUM(rv) - SUM(pe) - SUM(ve), 4) AS mix_effect
FROM d GROUP BY 1
"""


@query("k10_price_volume_mix", K10_SQL)
def q_k10(spark, d):
    return rounded(variance.price_volume_mix_mom(model.sales_lines(Tables(spark, d))), 4)


def _fva(t):
    return variance.forecast_vs_actual(staging.stage_forecast_weekly(raw.forecast_weekly_extract(t)))


K19_SQL = f"""
WITH {FORECAST_EXTRACT}
SELECT week_start_date, store_code, state, region, sku, product_name, product_family, channel,
       round(forecast_units, 4) AS forecast_units, round(actual_units, 4) AS actual_units,
       round(forecast_net_sales, 4) AS forecast_net_sales, round(actual_net_sales, 4) AS actual_net_sales,
       round(forecast_unit_price, 4) AS forecast_unit_price, round(actual_unit_price, 4) AS actual_unit_price,
       promo_flag, stockout_flag, is_partial_actual, seasonality_label, business_event, plan_version,
       round(unit_variance, 4) AS unit_variance, round(sales_variance, 4) AS sales_variance,
       round(sales_variance_pct, 4) AS sales_variance_pct, round(absolute_sales_error, 4) AS absolute_sales_error,
       round(absolute_percent_error, 4) AS absolute_percent_error, is_missing_actual, forecast_performance_status
FROM fva
"""


@query("k19_forecast_vs_actual", K19_SQL)
def q_k19(spark, d):
    return rounded(_fva(Tables(spark, d)))


K20_SQL = f"""
WITH {FORECAST_EXTRACT}
SELECT week_start_date, store_code, sku, channel, plan_version, round(total_sales_variance, 4) AS total_sales_variance,
       round(volume_effect, 4) AS volume_effect, round(price_effect, 4) AS price_effect,
       round(mix_or_residual_effect, 4) AS mix_or_residual_effect, primary_variance_driver, forecast_performance_status
FROM pvm
"""


@query("k20_forecast_price_volume", K20_SQL)
def q_k20(spark, d):
    p = variance.forecast_price_volume(_fva(Tables(spark, d)))
    return rounded(p.select("week_start_date", "store_code", "sku", "channel", "plan_version", "total_sales_variance",
                            "volume_effect", "price_effect", "mix_or_residual_effect", "primary_variance_driver",
                            "forecast_performance_status"))


K21_SQL = f"""
WITH {FORECAST_EXTRACT}
SELECT week_start_date, channel, plan_version, round(SUM(forecast_net_sales), 4) AS forecast_net_sales,
       round(SUM(volume_effect), 4) AS volume_effect, round(SUM(price_effect), 4) AS price_effect,
       round(SUM(mix_or_residual_effect), 4) AS mix_or_residual_effect,
       round(SUM(actual_net_sales), 4) AS actual_net_sales, round(SUM(total_sales_variance), 4) AS total_sales_variance,
       COUNT(*) AS row_count, COUNT(actual_net_sales) AS rows_with_actuals,
       COUNT(*) - COUNT(actual_net_sales) AS rows_missing_actuals
FROM pvm WHERE actual_net_sales IS NOT NULL GROUP BY 1, 2, 3
"""


@query("k21_variance_bridge", K21_SQL)
def q_k21(spark, d):
    return rounded(variance.variance_bridge(variance.forecast_price_volume(_fva(Tables(spark, d)))))


K22_SQL = f"""
WITH {FORECAST_EXTRACT},
g AS (SELECT week_start_date, channel, plan_version, SUM(forecast_net_sales) AS forecast_net_sales,
             SUM(actual_net_sales) AS actual_net_sales, SUM(actual_net_sales - forecast_net_sales) AS forecast_bias_amount,
             SUM(abs(actual_net_sales - forecast_net_sales)) AS absolute_sales_error,
             COUNT(*) AS row_count, COUNT(actual_net_sales) AS rows_with_actuals,
             COUNT(*) - COUNT(actual_net_sales) AS rows_missing_actuals
      FROM fva WHERE actual_net_sales IS NOT NULL GROUP BY 1, 2, 3)
SELECT week_start_date, channel, plan_version, round(forecast_net_sales, 4) AS forecast_net_sales,
       round(actual_net_sales, 4) AS actual_net_sales, round(forecast_bias_amount, 4) AS forecast_bias_amount,
       round(absolute_sales_error, 4) AS absolute_sales_error, row_count, rows_with_actuals, rows_missing_actuals,
       round(absolute_sales_error / NULLIF(actual_net_sales, 0), 4) AS wape,
       round(forecast_bias_amount / NULLIF(forecast_net_sales, 0), 4) AS bias_pct
FROM g
"""


@query("k22_forecast_kpi", K22_SQL)
def q_k22(spark, d):
    return rounded(variance.forecast_kpi(_fva(Tables(spark, d))))


K23_SQL = f"""
WITH {SALES_LINES},
daily AS (SELECT sale_date, store_id AS store_code, sku, channel, SUM(units) AS units_sold, SUM(net_sales) AS net_sales
          FROM sales_lines GROUP BY ALL),
mx AS (SELECT max(sale_date) AS m FROM daily),
w AS (SELECT d.*, sale_date >= CAST(m - INTERVAL 27 DAY AS DATE) AS is_cur FROM daily d, mx
      WHERE sale_date >= CAST(m - INTERVAL 55 DAY AS DATE) AND sale_date <= m),
p AS (SELECT store_code, sku, channel,
             SUM(CASE WHEN is_cur THEN COALESCE(units_sold, 0) ELSE 0 END) AS current_units_sold,
             SUM(CASE WHEN NOT is_cur THEN COALESCE(units_sold, 0) ELSE 0 END) AS prior_units_sold,
             SUM(CASE WHEN is_cur THEN COALESCE(net_sales, 0) ELSE 0 END) AS current_net_sales,
             SUM(CASE WHEN NOT is_cur THEN COALESCE(net_sales, 0) ELSE 0 END) AS prior_net_sales
      FROM w GROUP BY 1, 2, 3),
v AS (SELECT *, current_net_sales - prior_net_sales AS net_sales_variance,
             CASE WHEN prior_net_sales <> 0 THEN (current_net_sales - prior_net_sales) / prior_net_sales END
               AS net_sales_variance_pct,
             CASE WHEN current_units_sold <> 0 THEN current_net_sales / current_units_sold END AS current_avg_net_price,
             CASE WHEN prior_units_sold <> 0 THEN prior_net_sales / prior_units_sold END AS prior_avg_net_price FROM p),
e AS (SELECT *, (current_units_sold - prior_units_sold) * COALESCE(prior_avg_net_price, current_avg_net_price, 0)
                  AS estimated_volume_effect,
             (COALESCE(current_avg_net_price, 0) - COALESCE(prior_avg_net_price, 0)) * current_units_sold
                  AS estimated_price_effect FROM v),
l AS (SELECT *,
        CASE WHEN prior_net_sales = 0 AND current_net_sales > 0 THEN 'nw'
             WHEN prior_net_sales > 0 AND current_net_sales = 0 THEN 'lo'
             WHEN net_sales_variance < 0 AND abs(estimated_volume_effect) >= abs(estimated_price_effect) THEN 'vd'
             WHEN net_sales_variance < 0 AND abs(estimated_price_effect) > abs(estimated_volume_effect) THEN 'pd'
             WHEN net_sales_variance > 0 AND abs(estimated_volume_effect) >= abs(estimated_price_effect) THEN 'vu'
             WHEN net_sales_variance > 0 AND abs(estimated_price_effect) > abs(estimated_volume_effect) THEN 'pu'
             ELSE 'st' END AS k FROM e),
lab(k, primary_revenue_driver, recommended_action) AS (VALUES
  ('nw', 'New / growing business', 'Review what changed and consider expanding distribution or support.'),
  ('lo', 'Lost / declining business', 'Investigate lost sales, distribution gaps, account issues, or discontinued demand.'),
  ('vd', 'Volume-driven decline', 'Investigate demand decline, inventory availability, account performance, or lost distribution.'),
  ('pd', 'Price-driven decline', 'Review pricing, discounting, promo activity, or channel price pressure.'),
  ('vu', 'Volume-driven growth', 'Protect supply and consider expanding high-performing store/SKU/channel combinations.'),
  ('pu', 'Price-driven growth', 'Review whether price improvement is sustainable without hurting demand.'),
  ('st', 'Stable / low movement', 'Monitor; no immediate action required.'))
SELECT store_code, sku, channel, round(current_units_sold, 4) AS current_units_sold,
       round(prior_units_sold, 4) AS prior_units_sold, round(current_net_sales, 4) AS current_net_sales,
       round(prior_net_sales, 4) AS prior_net_sales, round(net_sales_variance, 4) AS net_sales_variance,
       round(net_sales_variance_pct, 4) AS net_sales_variance_pct, round(current_avg_net_price, 4) AS current_avg_net_price,
       round(prior_avg_net_price, 4) AS prior_avg_net_price, round(estimated_volume_effect, 4) AS estimated_volume_effect,
       round(estimated_price_effect, 4) AS estimated_price_effect, primary_revenue_driver, recommended_action,
       CAST(dense_rank() OVER (ORDER BY round(abs(net_sales_variance), 4) DESC) AS INTEGER) AS variance_impact_rank
FROM l JOIN lab USING (k)
"""


@query("k23_revenue_root_cause", K23_SQL)
def q_k23(spark, d):
    t = Tables(spark, d)
    end = model.latest_sale_date(t)
    s = model.sales_lines(t, since=end and end - dt.timedelta(days=55))
    daily = s.groupBy("sale_date", F.col("store_id").alias("store_code"), "sku", "channel").agg(
        F.sum("units").alias("units_sold"), F.sum("net_sales").alias("net_sales"))
    return rounded(variance.revenue_root_cause(daily, as_of=end))
