"""Sales KPI queries (K1–K18) on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facts, kpi
from ..sources.testdata import Tables
from . import model
from .oracle import K1_SQL, SALES_LINES
from .registry import query, rounded


@query("k1_exec_summary", K1_SQL)
def q_k1(spark, d):
    t = Tables(spark, d)
    return rounded(kpi.exec_summary(model.sales_lines(t)))

from ..functions.clean import ratio  # noqa: E402
from .oracle import INVENTORY  # noqa: E402

R = "round({x}, 4)"


def _r(x, a=None, n=4):
    return f"round({x}, {n}) AS {a or x}"


K2_SQL = f"""
WITH {SALES_LINES},
mix AS (SELECT month_start, category, brand, SUM(units) AS units_sold, SUM(net_sales) AS net_sales,
               SUM(net_sales - cogs) AS gross_margin_dollars FROM sales_lines GROUP BY 1, 2, 3),
tot AS (SELECT month_start, SUM(units_sold) tu, SUM(net_sales) tn, SUM(gross_margin_dollars) tm FROM mix GROUP BY 1)
SELECT m.month_start, category, brand, {_r('units_sold')}, {_r('net_sales')}, {_r('gross_margin_dollars')},
       round(units_sold / NULLIF(tu, 0), 4) AS unit_mix_pct, round(net_sales / NULLIF(tn, 0), 4) AS revenue_mix_pct,
       round(gross_margin_dollars / NULLIF(tm, 0), 4) AS margin_mix_pct
FROM mix m JOIN tot t ON m.month_start = t.month_start
"""


@query("k2_product_mix", K2_SQL)
def q_k2(spark, d):
    return rounded(kpi.product_mix(model.sales_lines(Tables(spark, d))))


K3_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT month_start, state, category, pack_size, SUM(units) AS units_sold, SUM(net_sales) AS net_sales,
             SUM(net_sales - cogs) AS gross_margin_dollars, SUM(units * COALESCE(pack_size, 0)) AS mg
      FROM sales_lines GROUP BY 1, 2, 3, 4)
SELECT month_start, state, category, pack_size, {_r('units_sold')}, {_r('net_sales')}, {_r('gross_margin_dollars')},
       round(net_sales / NULLIF(units_sold, 0), 4) AS net_price_per_pack,
       round(net_sales / NULLIF(mg, 0), 4) AS net_revenue_per_mg,
       round(gross_margin_dollars / NULLIF(mg, 0), 4) AS margin_per_mg
FROM a
"""


@query("k3_price_pack", K3_SQL)
def q_k3(spark, d):
    return rounded(kpi.price_pack(model.sales_lines(Tables(spark, d))))


K4_SQL = f"""
WITH {SALES_LINES},
sw AS (SELECT week_start, store_id, state, category, MAX(CASE WHEN promo_flag THEN 1 ELSE 0 END) AS any_promo,
              SUM(units) AS units_sold FROM sales_lines GROUP BY 1, 2, 3, 4),
s AS (SELECT week_start, state, category,
             SUM(CASE WHEN any_promo = 1 THEN units_sold ELSE 0 END) AS promo_units,
             SUM(CASE WHEN any_promo = 0 THEN units_sold ELSE 0 END) AS nonpromo_units,
             COUNT(DISTINCT CASE WHEN any_promo = 1 THEN store_id END) AS promo_locations,
             COUNT(DISTINCT CASE WHEN any_promo = 0 THEN store_id END) AS nonpromo_locations
      FROM sw GROUP BY 1, 2, 3)
SELECT week_start, state, category, {_r('promo_units')}, {_r('nonpromo_units')},
       round(promo_units / NULLIF(promo_units + nonpromo_units, 0), 4) AS promo_penetration_pct,
       round(round(promo_units / NULLIF(promo_locations, 0), 2), 4) AS promo_ros_units_per_store,
       round(round(nonpromo_units / NULLIF(nonpromo_locations, 0), 2), 4) AS nonpromo_ros_units_per_store,
       round(((promo_units / NULLIF(promo_locations, 0)) - (nonpromo_units / NULLIF(nonpromo_locations, 0)))
             / NULLIF(nonpromo_units / NULLIF(nonpromo_locations, 0), 0), 4) AS promo_lift_pct
FROM s
"""


@query("k4_promo_performance", K4_SQL)
def q_k4(spark, d):
    return rounded(kpi.promo_performance(model.sales_lines(Tables(spark, d))))


K5_SQL = f"""
WITH {SALES_LINES}
SELECT week_start, state, category, COUNT(DISTINCT CASE WHEN units > 0 THEN store_id END) AS active_doors,
       round(SUM(units), 4) AS units_sold,
       round(round(SUM(units) / NULLIF(COUNT(DISTINCT CASE WHEN units > 0 THEN store_id END), 0), 2), 4)
         AS rate_of_sale_units_per_active_door
FROM sales_lines GROUP BY 1, 2, 3
"""


@query("k5_distribution_ros", K5_SQL)
def q_k5(spark, d):
    return rounded(kpi.distribution_ros(model.sales_lines(Tables(spark, d))))


K6_SQL = f"""
WITH {SALES_LINES}, {INVENTORY},
inv AS (SELECT month_start, sku, site_id, state, category, AVG(on_hand_units) AS avg_on_hand_units,
               AVG(CASE WHEN in_stock_flag IS NOT NULL THEN CAST(in_stock_flag AS DOUBLE)
                        WHEN on_hand_units > 0 THEN 1.0 ELSE 0.0 END) AS in_stock_pct
        FROM inventory GROUP BY 1, 2, 3, 4, 5),
sales AS (SELECT month_start, sku, site_id, SUM(units) AS units_sold FROM sales_lines GROUP BY 1, 2, 3),
g AS (SELECT inv.month_start, state, category, AVG(avg_on_hand_units) AS avg_on_hand_units,
             SUM(COALESCE(units_sold, 0)) AS units_sold, SUM(units_sold) AS units_raw, AVG(in_stock_pct) AS in_stock_pct
      FROM inv LEFT JOIN sales ON sales.month_start = inv.month_start AND sales.sku = inv.sku AND sales.site_id = inv.site_id
      GROUP BY 1, 2, 3)
SELECT month_start, state, category, {_r('avg_on_hand_units')}, {_r('units_sold')}, {_r('in_stock_pct')},
       round(1.0 - in_stock_pct, 4) AS stockout_rate,
       round(CASE WHEN units_sold <> 0 THEN avg_on_hand_units
                  / NULLIF(units_raw / NULLIF(CAST(dayofmonth(last_day(month_start)) AS DOUBLE), 0), 0) END, 4)
         AS approx_days_on_hand,
       round(units_sold / NULLIF(avg_on_hand_units, 0), 4) AS inventory_turnover_units
FROM g
"""


# Lines of either side that one task groups and joins (nearly 1 KB a line in its maps and sorts).
LINES_PER_TASK = 250_000


@query("k6_inventory_health", K6_SQL)
def q_k6(spark, d):
    t = Tables(spark, d)
    tasks = t.lineitem.count() // LINES_PER_TASK + 1
    return rounded(kpi.inventory_health(model.inventory(t), model.sales_lines(t), tasks=tasks))


K8_SQL = f"""
WITH {SALES_LINES},
acct AS (SELECT month_start, store_id, SUM(net_sales) AS net_sales FROM sales_lines GROUP BY 1, 2),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY month_start ORDER BY net_sales DESC, store_id ASC) AS rn FROM acct),
g AS (SELECT month_start, SUM(CASE WHEN rn <= 10 THEN net_sales ELSE 0 END) AS top_10_sales,
             SUM(net_sales) AS total_period_sales FROM ranked GROUP BY 1)
SELECT month_start, {_r('top_10_sales')}, {_r('total_period_sales')},
       round(top_10_sales / NULLIF(total_period_sales, 0), 4) AS top_10_concentration_pct
FROM g
"""


@query("k8_account_concentration", K8_SQL)
def q_k8(spark, d):
    return rounded(kpi.account_concentration(model.sales_lines(Tables(spark, d))))


K9_SQL = f"""
WITH {SALES_LINES},
ma AS (SELECT DISTINCT month_start, store_id FROM sales_lines WHERE units > 0),
r AS (SELECT cur.month_start, COUNT(DISTINCT cur.store_id) AS active_accounts_current,
             COUNT(DISTINCT prev.store_id) AS retained_accounts
      FROM ma cur LEFT JOIN ma prev ON prev.store_id = cur.store_id
                               AND prev.month_start = CAST(cur.month_start - INTERVAL 1 MONTH AS DATE)
      GROUP BY 1),
p AS (SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) AS month_start, COUNT(DISTINCT store_id) AS active_accounts_prior
      FROM ma GROUP BY 1)
SELECT r.month_start, active_accounts_current, COALESCE(active_accounts_prior, 0) AS active_accounts_prior,
       retained_accounts, round(retained_accounts / NULLIF(active_accounts_prior, 0), 4) AS account_retention_pct
FROM r LEFT JOIN p ON r.month_start = p.month_start
"""


@query("k9_account_retention", K9_SQL)
def q_k9(spark, d):
    return rounded(kpi.account_retention(model.sales_lines(Tables(spark, d))))


K11_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT week_start, sku, store_id, SUM(units) AS actual_units FROM sales_lines GROUP BY 1, 2, 3),
f AS (SELECT CAST(week_start + INTERVAL 364 DAY AS DATE) AS week_start, sku, store_id, SUM(units) AS forecast_units
      FROM sales_lines GROUP BY 1, 2, 3),
g AS (SELECT a.week_start, SUM(actual_units) AS actual_units, SUM(COALESCE(forecast_units, 0)) AS forecast_units,
             SUM(abs(actual_units - COALESCE(forecast_units, 0))) AS abs_error_units,
             SUM(actual_units - COALESCE(forecast_units, 0)) AS bias
      FROM a LEFT JOIN f ON a.week_start = f.week_start AND a.sku = f.sku AND a.store_id = f.store_id GROUP BY 1)
SELECT week_start, {_r('actual_units')}, {_r('forecast_units')}, {_r('abs_error_units')},
       round(abs_error_units / NULLIF(actual_units, 0), 4) AS wape, round(bias / NULLIF(actual_units, 0), 4) AS forecast_bias_pct
FROM g
"""


def seasonal_naive_forecast(sales):
    """Forecast = same week one year (364 days) earlier."""
    return sales.select(F.date_add("week_start", 364).alias("week_start"), "sku", "store_id",
                        F.col("units").alias("forecast_units"))


@query("k11_forecast_accuracy", K11_SQL)
def q_k11(spark, d):
    s = model.sales_lines(Tables(spark, d))
    return rounded(kpi.forecast_accuracy(s, seasonal_naive_forecast(s)))


K12_SQL = f"""
WITH {SALES_LINES}
SELECT COUNT(*) AS rows_checked, count(*) FILTER (WHERE units < 0) AS negative_units_rows,
       count(*) FILTER (WHERE net_sales < 0) AS negative_net_sales_rows,
       count(*) FILTER (WHERE gross_sales < net_sales) AS gross_less_than_net_rows,
       count(*) FILTER (WHERE cogs < 0) AS negative_cogs_rows,
       count(*) FILTER (WHERE units = 0 AND net_sales <> 0) AS zero_units_nonzero_sales_rows
FROM sales_lines
"""


@query("k12_sales_quality_counters", K12_SQL)
def q_k12(spark, d):
    return kpi.sales_quality_counters(model.sales_lines(Tables(spark, d)))


K13_SQL = f"""
WITH {SALES_LINES}
SELECT sale_date, store_id, round(SUM(net_sales), 4) AS net_sales, round(SUM(cogs), 4) AS cogs,
       round(SUM(net_sales) - SUM(cogs), 4) AS gross_margin,
       round((SUM(net_sales) - SUM(cogs)) / NULLIF(SUM(net_sales), 0), 4) AS gross_margin_pct,
       COUNT(*) AS line_count
FROM sales_lines GROUP BY 1, 2
"""


@query("k13_gross_margin_daily", K13_SQL)
def q_k13(spark, d):
    return rounded(kpi.gross_margin_daily(model.sales_lines(Tables(spark, d))))


SNAPSHOT_CTE = """
snap AS (SELECT * EXCLUDE (rn), COALESCE(in_stock_flag, on_hand_units > 0) AS stocked FROM (
  SELECT snapshot_date, site_id, sku, on_hand_units, in_stock_flag,
         ROW_NUMBER() OVER (PARTITION BY snapshot_date, site_id, sku ORDER BY COALESCE(on_hand_units < 0, FALSE),
                            on_hand_units DESC NULLS LAST, in_stock_flag DESC NULLS LAST) AS rn
  FROM inventory WHERE snapshot_date IS NOT NULL AND site_id IS NOT NULL AND sku IS NOT NULL) WHERE rn = 1)"""


def _snapshots(t):
    """Deduplicated daily snapshots with the in-stock flag filled from the stock."""
    inv = model.inventory(t).select("snapshot_date", "site_id", "sku", "on_hand_units", "in_stock_flag")
    return facts.inventory_snapshot_fact(inv).withColumn("in_stock_flag", F.coalesce("in_stock_flag", F.col("on_hand_units") > 0))


K17_SQL = f"""
WITH {INVENTORY}, {SNAPSHOT_CTE},
cov AS (SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_suppkey AS site_id, l_partkey AS sku, bool_or(l_quantity >= 10) AS is_carried
        FROM lineitem GROUP BY 1, 2, 3),
g AS (SELECT s.snapshot_date, s.site_id, COUNT(*) AS n, count(*) FILTER (WHERE stocked) AS st, count(*) FILTER (WHERE is_carried) AS c,
             count(*) FILTER (WHERE is_carried AND stocked) AS cs
      FROM snap s LEFT JOIN cov USING (snapshot_date, site_id, sku) GROUP BY 1, 2)
SELECT snapshot_date, site_id, n AS n_skus_in_inventory, st AS n_skus_in_stock, c AS n_skus_carried, cs AS n_carried_skus_in_stock,
       round(CAST(st AS DOUBLE) / NULLIF(n, 0), 4) AS instock_rate_inventory_universe,
       round(CAST(cs AS DOUBLE) / NULLIF(c, 0), 4) AS instock_rate_carried_universe
FROM g
"""


@query("k17_instock_rate_daily", K17_SQL)
def q_k17(spark, d):
    t = Tables(spark, d)
    carried = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("snapshot_date"), F.col("l_suppkey").alias("site_id"),
                                 F.col("l_partkey").alias("sku")).agg(F.bool_or(F.col("l_quantity") >= 10).alias("is_carried"))
    return rounded(kpi.instock_rate_daily(_snapshots(t), carried))


K18_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {SNAPSHOT_CTE},
s AS (SELECT site_id, sku, sale_date, SUM(units) AS u FROM sales_lines GROUP BY 1, 2, 3),
t AS (SELECT i.site_id, i.sku, i.snapshot_date, greatest(i.on_hand_units, 0.0) AS on_hand_safe,
             (SELECT SUM(u) FROM s WHERE s.site_id = i.site_id AND s.sku = i.sku
                AND s.sale_date BETWEEN CAST(i.snapshot_date - INTERVAL 27 DAY AS DATE) AND i.snapshot_date) AS units_trailing
      FROM snap i)
SELECT site_id, sku, snapshot_date, round(on_hand_safe, 4) AS on_hand_safe, round(units_trailing, 4) AS units_trailing,
       round(units_trailing / 28.0, 4) AS avg_daily_units,
       round(on_hand_safe / NULLIF(units_trailing / 28.0, 0), 4) AS days_of_supply
FROM t
"""


@query("k18_days_of_supply", K18_SQL)
def q_k18(spark, d):
    t = Tables(spark, d)
    return rounded(kpi.days_of_supply(_snapshots(t), model.sales_lines(t)))


T3_SQL = f"""
WITH {SALES_LINES},
m AS (SELECT DISTINCT month_start FROM sales_lines ORDER BY month_start DESC LIMIT 3)
SELECT month_start, state, round(SUM(net_sales), 4) AS net_sales
FROM sales_lines WHERE month_start IN (SELECT month_start FROM m) GROUP BY 1, 2
"""


@query("t3_latest_periods", T3_SQL)
def q_t3(spark, d):
    """The latest three months (the limit is the feature), state totals."""
    from ..operators.ranking import latest_n_periods
    s = model.sales_lines(Tables(spark, d)).groupBy("month_start", "state").agg(F.sum("net_sales").alias("net_sales"))
    return rounded(latest_n_periods(s, "month_start", 3))
