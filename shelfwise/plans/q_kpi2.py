"""Further KPI queries: ROI, break-even, labor productivity, alerts, rates, anomalies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..operators import history, kpi, recon, staging
from ..sources.testdata import Tables
from . import ghg, model, raw
from .oracle import GHG, INVENTORY, SALES_LINES
from .q_facts import dist_daily
from .q_recon import Q21_SQL, q21_frame
from .registry import query, rounded
from .sql_facts import DIST_CTE, FIN_CTE

SHIFT = model.LABOR_SHIFT_DAYS


def _fin(t):
    return staging.stage_finance_actuals(raw.finance_actuals_extract(t))


K14_SQL = f"""
WITH {FIN_CTE},
a AS (SELECT period_month, SUM(actual_amount) FILTER (WHERE kpi_category = 'net_sales') AS net_sales,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'cogs') AS cogs,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'gross_margin') AS gm,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'labor_cost') AS labor_cost FROM k GROUP BY 1),
d AS (SELECT period_month, net_sales, cogs, COALESCE(gm, net_sales - cogs) AS gross_margin, labor_cost FROM a)
SELECT period_month, round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs, round(gross_margin, 4) AS gross_margin,
       round(labor_cost, 4) AS labor_cost, round(gross_margin - labor_cost, 4) AS contribution_margin,
       round(gross_margin / NULLIF(labor_cost, 0), 4) AS roi_gross_margin_over_labor,
       round((gross_margin - labor_cost) / NULLIF(labor_cost, 0), 4) AS roi_contribution_over_labor
FROM d
"""


@query("k14_roi_monthly", K14_SQL)
def q_k14(spark, d):
    return rounded(kpi.roi_monthly(_fin(Tables(spark, d))))


K15_SQL = f"""
WITH {FIN_CTE}, {DIST_CTE},
a AS (SELECT period_month, SUM(actual_amount) FILTER (WHERE kpi_category = 'net_sales') AS net_sales,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'cogs') AS cogs,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'labor_cost') AS labor_cost FROM k GROUP BY 1),
sm AS (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS period_month, SUM(COALESCE(net_sales, 0)) AS mart_net_sales
       FROM dist GROUP BY 1),
j AS (SELECT a.*, mart_net_sales, (a.net_sales - cogs) / NULLIF(a.net_sales, 0) AS gmp,
             CAST(dayofmonth(last_day(a.period_month)) AS DOUBLE) AS dim FROM a LEFT JOIN sm USING (period_month)),
e AS (SELECT *, CASE WHEN mart_net_sales IS NOT NULL AND mart_net_sales <> 0 THEN mart_net_sales / dim
                     WHEN net_sales IS NOT NULL AND net_sales <> 0 THEN net_sales / dim END AS avg_daily,
             CASE WHEN labor_cost IS NOT NULL THEN labor_cost / NULLIF(gmp, 0) END AS be FROM j)
SELECT period_month, round(net_sales, 4) AS actual_net_sales, round(cogs, 4) AS cogs,
       round(net_sales - cogs, 4) AS gross_margin, round(gmp, 4) AS gross_margin_pct, round(labor_cost, 4) AS labor_cost,
       round(be, 4) AS breakeven_net_sales_for_labor, round(avg_daily, 4) AS avg_daily_net_sales_in_month,
       round(be / NULLIF(avg_daily, 0), 4) AS breakeven_days_estimate
FROM e
"""


@query("k15_breakeven_monthly", K15_SQL)
def q_k15(spark, d):
    t = Tables(spark, d)
    return rounded(kpi.breakeven_monthly(_fin(t), dist_daily(t, ["net_sales"])))


ALIGNED_PAIRS = f"""
punches AS (
  SELECT event_id AS punch_id, 'S' || lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS store_code,
         user_id AS employee_id, ts - INTERVAL {SHIFT} DAY AS punch_ts, CAST(ts - INTERVAL {SHIFT} DAY AS DATE) AS work_date,
         CASE upper(NULLIF(trim(event_type), '')) WHEN 'CLICK' THEN 'IN' WHEN 'VIEW' THEN 'OUT'
              ELSE upper(NULLIF(trim(event_type), '')) END AS action
  FROM events),
o AS (SELECT *, LEAD(action) OVER w AS next_action, LEAD(punch_ts) OVER w AS next_ts
      FROM punches WINDOW w AS (PARTITION BY store_code, employee_id ORDER BY punch_ts, action)),
pm AS (SELECT *, CASE WHEN action = 'IN' AND next_action = 'OUT' AND next_ts >= punch_ts
                      THEN greatest((epoch_us(next_ts) - epoch_us(punch_ts)) / 60000000.0, 0.0) END AS minutes_worked,
              COALESCE(action = 'IN' AND next_action = 'OUT' AND next_ts >= punch_ts, FALSE) AS is_pair FROM o),
ed AS (SELECT work_date, store_code, employee_id, SUM(minutes_worked) / 60.0 AS hours_worked FROM pm
       GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE is_pair) > 0),
lab AS (SELECT work_date, store_code, SUM(hours_worked) AS labor_hours, COUNT(DISTINCT employee_id) AS employees_worked
        FROM ed GROUP BY 1, 2)"""

SALES_STORE_DAY = """
sd AS (SELECT sale_date AS work_date, 'S' || lpad(CAST(store_id % 8 AS VARCHAR), 2, '0') AS store_code,
              SUM(net_sales) AS net_sales, SUM(units) AS units, SUM(net_sales - cogs) AS gross_margin_dollars
       FROM sales_lines GROUP BY 1, 2)"""


def _labor_day(t):
    daily = history.labor_daily_employee(model.punches_aligned(t))
    return history.labor_store_daily(daily).select("work_date", "store_code", "labor_hours", "employees_worked")


def _sales_day(t):
    s = model.sales_lines(t)
    return s.groupBy(F.col("sale_date").alias("work_date"), model.punch_store_of(F.col("store_id")).alias("store_code")) \
        .agg(F.sum("net_sales").alias("net_sales"), F.sum("units").alias("units"),
             F.sum(F.col("net_sales") - F.col("cogs")).alias("gross_margin_dollars"))


K16_SQL = f"""
WITH {SALES_LINES}, {ALIGNED_PAIRS}, {SALES_STORE_DAY}
SELECT sale_date AS work_date, s.store_code, round(net_sales, 4) AS net_sales, round(gross_sales, 4) AS gross_sales,
       round(discount_amount, 4) AS discount_amount, round(cogs, 4) AS cogs, round(units, 4) AS units, orders, customers,
       round(hours_worked, 4) AS hours_worked, n_punches, n_employees,
       round(net_sales / NULLIF(hours_worked, 0), 4) AS net_sales_per_labor_hour,
       round(gross_sales / NULLIF(hours_worked, 0), 4) AS gross_sales_per_labor_hour
FROM (SELECT sale_date, 'S' || lpad(CAST(store_id % 8 AS VARCHAR), 2, '0') AS store_code, SUM(net_sales) AS net_sales,
             SUM(gross_sales) AS gross_sales, SUM(discount_amount) AS discount_amount, SUM(cogs) AS cogs, SUM(units) AS units,
             COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT store_id) AS customers FROM sales_lines GROUP BY 1, 2) s
LEFT JOIN (SELECT work_date, store_code, SUM(hours_worked) AS hours_worked, CAST(SUM(n_punches) AS BIGINT) AS n_punches,
                  COUNT(DISTINCT employee_id) AS n_employees
           FROM (SELECT work_date, store_code, employee_id, SUM(minutes_worked) / 60.0 AS hours_worked, COUNT(*) AS n_punches FROM pm
                 GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE is_pair) > 0) GROUP BY 1, 2) l
  ON s.sale_date = l.work_date AND s.store_code = l.store_code
"""


@query("k16_sales_per_labor_hour_daily", K16_SQL)
def q_k16(spark, d):
    t = Tables(spark, d)
    s = model.sales_lines(t)
    sales = s.groupBy(F.col("sale_date").alias("work_date"), model.punch_store_of(F.col("store_id")).alias("store_code")).agg(
        *[F.sum(c).alias(c) for c in ("net_sales", "gross_sales", "discount_amount", "cogs", "units")],
        F.count_distinct("order_id").alias("orders"), F.count_distinct("store_id").alias("customers"))
    labor = history.labor_daily_employee(model.punches_aligned(t)).groupBy("work_date", "store_code").agg(
        F.sum("hours_worked").alias("hours_worked"), F.sum("n_events").alias("n_punches"),
        F.count_distinct("employee_id").alias("n_employees"))
    return rounded(kpi.sales_per_labor_hour_daily(sales, labor))


K7_AS_OF = "2001-07-31"

K7_SQL = f"""
WITH {SALES_LINES}, {ALIGNED_PAIRS}, {SALES_STORE_DAY},
locs AS (SELECT DISTINCT store_code FROM punches),
grid AS (SELECT store_code, CAST(unnest(generate_series(DATE '{K7_AS_OF}' - INTERVAL 90 DAY, DATE '{K7_AS_OF}',
                                                        INTERVAL 1 DAY)) AS DATE) AS full_date FROM locs)
SELECT g.full_date, g.store_code, round(COALESCE(net_sales, 0), 4) AS net_sales, round(COALESCE(units, 0), 4) AS units_sold,
       round(COALESCE(gross_margin_dollars, 0), 4) AS gross_margin_dollars,
       round(COALESCE(labor_hours, 0), 4) AS labor_hours, CAST(COALESCE(employees_worked, 0) AS BIGINT) AS headcount,
       round(COALESCE(labor_hours * {model.LABOR_RATE_PER_HOUR}, 0), 4) AS labor_cost,
       round(CASE WHEN COALESCE(labor_hours, 0) <> 0 THEN net_sales / labor_hours END, 4) AS revenue_per_labor_hour,
       round(CASE WHEN COALESCE(labor_hours, 0) <> 0 THEN units / labor_hours END, 4) AS units_per_labor_hour,
       round(CASE WHEN COALESCE(labor_hours * {model.LABOR_RATE_PER_HOUR}, 0) <> 0
                  THEN gross_margin_dollars / (labor_hours * {model.LABOR_RATE_PER_HOUR}) END, 4)
         AS gross_margin_to_labor_cost_ratio
FROM grid g LEFT JOIN sd ON sd.work_date = g.full_date AND sd.store_code = g.store_code
LEFT JOIN lab ON lab.work_date = g.full_date AND lab.store_code = g.store_code
"""


@query("k7_sales_labor_productivity", K7_SQL)
def q_k7(spark, d):
    t = Tables(spark, d)
    sales_day = _sales_day(t).withColumnRenamed("work_date", "sale_date")
    lab = _labor_day(t).select("work_date", "store_code", "labor_hours",
                               F.col("employees_worked").alias("headcount"),
                               (F.col("labor_hours") * model.LABOR_RATE_PER_HOUR).alias("labor_cost"))
    locs = model.punches(t).select("store_code")
    return rounded(kpi.sales_labor_productivity(sales_day, lab, locs, K7_AS_OF, 90, "store_code"))


K24_SQL = f"""
WITH {SALES_LINES},
daily AS (SELECT sale_date, store_id AS store_code, sku, channel, SUM(gross_sales) AS gross_sales,
                 SUM(discount_amount) AS discount_amount, SUM(net_sales) AS net_sales, SUM(cogs) AS cogs
          FROM sales_lines GROUP BY 1, 2, 3, 4),
mx AS (SELECT max(sale_date) AS m FROM daily),
g AS (SELECT store_code, sku, channel, COUNT(*) AS source_day_count, SUM(COALESCE(gross_sales, 0)) AS gross_sales,
             SUM(COALESCE(discount_amount, 0)) AS discount_amount, SUM(COALESCE(net_sales, 0)) AS net_sales,
             SUM(COALESCE(cogs, 0)) AS cogs
      FROM daily, mx WHERE sale_date >= CAST(m - INTERVAL 27 DAY AS DATE) AND sale_date <= m GROUP BY 1, 2, 3),
h AS (SELECT *, net_sales - cogs AS gross_margin,
             CASE WHEN net_sales <> 0 THEN (net_sales - cogs) / net_sales END AS gmp,
             CASE WHEN gross_sales <> 0 THEN discount_amount / gross_sales END AS dr FROM g),
l AS (SELECT *,
        CASE WHEN net_sales < 100 THEN 'monitor' WHEN gmp < 0.25 AND net_sales >= 500 THEN 'critical'
             WHEN gmp < 0.30 AND net_sales >= 250 THEN 'high' WHEN gmp < 0.35 THEN 'medium' ELSE 'healthy' END AS severity,
        CASE WHEN net_sales < 100 THEN 'Sales volume is low; monitor before taking action.'
             WHEN gmp < 0.25 AND net_sales >= 500 THEN 'Gross margin is below 25% on meaningful sales volume.'
             WHEN gmp < 0.30 AND net_sales >= 250 THEN 'Gross margin is below 30% on moderate sales volume.'
             WHEN gmp < 0.35 THEN 'Gross margin is below the watchlist threshold.'
             ELSE 'Margin appears healthy.' END AS why_flagged,
        CASE WHEN net_sales < 100 THEN 'Monitor; sales volume is too low for a strong decision.'
             WHEN gmp < 0.25 AND dr >= 0.20 THEN 'Review promo depth and discounting strategy.'
             WHEN gmp < 0.25 THEN 'Investigate pricing, COGS, or product margin erosion.'
             WHEN gmp < 0.30 AND dr >= 0.15 THEN 'Check whether discounts are reducing margin below target.'
             WHEN gmp < 0.35 THEN 'Add to margin watchlist and compare against trend.'
             ELSE 'No immediate action required.' END AS recommended_action FROM h)
SELECT store_code, sku, channel, source_day_count, round(gross_sales, 4) AS gross_sales,
       round(discount_amount, 4) AS discount_amount, round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs,
       round(gross_margin, 4) AS gross_margin, round(gmp, 4) AS gross_margin_pct, round(dr, 4) AS discount_rate,
       severity, why_flagged, recommended_action,
       CAST(dense_rank() OVER (ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3
                                             WHEN 'monitor' THEN 4 END, round(net_sales, 4) DESC) AS INTEGER)
         AS alert_priority_rank
FROM l WHERE severity IN ('critical', 'high', 'medium', 'monitor')
"""


@query("k24_low_margin_alerts", K24_SQL)
def q_k24(spark, d):
    t = Tables(spark, d)
    end = model.latest_sale_date(t)
    s = model.sales_lines(t, since=end and end - dt.timedelta(days=27))
    daily = s.groupBy("sale_date", F.col("store_id").alias("store_code"), "sku", "channel").agg(
        F.sum("gross_sales").alias("gross_sales"), F.sum("discount_amount").alias("discount_amount"),
        F.sum("net_sales").alias("net_sales"), F.sum("cogs").alias("cogs"))
    return rounded(kpi.low_margin_alerts(daily, as_of=end))


K27_SQL = f"""
WITH {SALES_LINES},
g AS (SELECT month_start, COUNT(DISTINCT order_id) AS orders, COUNT(*) AS lines, SUM(net_sales) AS net_sales,
             SUM(units) AS units, SUM(gross_sales) AS gross_sales, SUM(discount_amount) AS discount_amount,
             SUM(cogs) AS cogs FROM sales_lines GROUP BY 1)
SELECT month_start, orders, round(net_sales / NULLIF(orders, 0), 4) AS revenue_per_order,
       round(units / NULLIF(orders, 0), 4) AS units_per_order, round(CAST(lines AS DOUBLE) / NULLIF(orders, 0), 4) AS lines_per_order,
       round(discount_amount / NULLIF(gross_sales, 0), 4) AS discount_rate, round(cogs / NULLIF(net_sales, 0), 4) AS cogs_pct_of_net
FROM g
"""


@query("k27_order_rates", K27_SQL)
def q_k27(spark, d):
    return rounded(kpi.order_rates(model.sales_lines(Tables(spark, d))))


# Role mapping of K27: a line's quantity is requested, a quarter of each returned line was backordered, and hours of an
# employee-day beyond eight are overtime.
K27O_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {ALIGNED_PAIRS},
sh AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start, SUM(l_quantity) AS req,
              SUM(CASE WHEN l_returnflag = 'R' THEN 0.75 ELSE 1.0 END * l_quantity) AS shipped,
              SUM(CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0.0 END * l_quantity) AS back FROM lineitem GROUP BY 1),
iv AS (SELECT month_start, AVG(CAST(COALESCE(in_stock_flag, on_hand_units > 0) AS INTEGER)) AS in_stock_rate FROM inventory GROUP BY 1),
lb AS (SELECT CAST(date_trunc('month', work_date) AS DATE) AS month_start, SUM(least(hours_worked, 8.0)) AS h,
              SUM(greatest(hours_worked - 8.0, 0.0)) AS o, SUM(hours_worked * {model.LABOR_RATE_PER_HOUR}) AS c FROM ed GROUP BY 1),
sl AS (SELECT month_start, SUM(net_sales) AS net FROM sales_lines GROUP BY 1)
SELECT month_start, round(shipped / NULLIF(req, 0), 4) AS fill_rate, round(back / NULLIF(req, 0), 4) AS backorder_rate,
       round(in_stock_rate, 4) AS in_stock_rate, round(o / NULLIF(h + o, 0), 4) AS overtime_rate,
       round(c / NULLIF(net, 0), 4) AS labor_cost_pct_net_sales
FROM sh FULL JOIN iv USING (month_start) FULL JOIN lb USING (month_start) FULL JOIN sl USING (month_start)
"""


@query("k27_operations_rates", K27O_SQL)
def q_k27_operations(spark, d):
    t = Tables(spark, d)
    qty = F.col("l_quantity")
    back = F.when(F.col("l_returnflag") == "R", 0.25).otherwise(0.0)
    ship = t.lineitem.select(F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month_start"), qty.alias("requested_units"),
                             ((1.0 - back) * qty).alias("shipped_units"), (back * qty).alias("backordered_units"))
    inv = model.inventory(t).select("month_start", F.coalesce("in_stock_flag", F.col("on_hand_units") > 0).alias("in_stock_flag"))
    h = F.col("hours_worked")
    labor = history.labor_daily_employee(model.punches_aligned(t)).select(
        F.trunc("work_date", "month").alias("month_start"), F.least(h, F.lit(8.0)).alias("labor_hours"),
        F.greatest(h - 8.0, F.lit(0.0)).alias("overtime_hours"), (h * model.LABOR_RATE_PER_HOUR).alias("labor_cost_amount"))
    return rounded(kpi.operations_rates(ship, inv, labor, model.sales_lines(t)))


K28_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {ALIGNED_PAIRS}, {SALES_STORE_DAY},
m AS (
  SELECT 'gross_margin_pct' AS metric_name, sale_date AS date_key, CAST(store_id AS VARCHAR) AS location_key,
         SUM(net_sales - cogs) / NULLIF(SUM(net_sales), 0) AS value FROM sales_lines GROUP BY 2, 3
  UNION ALL
  SELECT 'stockout_rate', snapshot_date, CAST(site_id AS VARCHAR),
         CAST(count(*) FILTER (WHERE on_hand_units <= 0) AS DOUBLE) / COUNT(*) FROM inventory GROUP BY 2, 3
  UNION ALL
  SELECT 'net_sales_per_labor_hour', sd.work_date, sd.store_code, net_sales / NULLIF(labor_hours, 0)
  FROM sd JOIN lab ON sd.work_date = lab.work_date AND sd.store_code = lab.store_code),
r AS (SELECT *, AVG(value) OVER w AS baseline_avg, stddev_samp(value) OVER w AS dev
      FROM m WINDOW w AS (PARTITION BY metric_name, location_key ORDER BY date_key ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, CASE WHEN dev > 1e-9 THEN (value - baseline_avg) / dev END AS z FROM r)
SELECT metric_name, date_key, location_key, round(value, 4) AS value, round(baseline_avg, 4) AS baseline_avg, round(z, 4) AS z_score,
       COALESCE(abs(z) > 2.0, FALSE) AS is_anomaly
FROM z
"""


@query("k28_anomaly_flags", K28_SQL)
def q_k28(spark, d):
    t = Tables(spark, d)
    # One pass over the sales for both of their metrics: grouping sets by account and by punch store.
    s = model.sales_lines(t).select(F.col("sale_date").alias("date_key"), F.col("store_id").cast("string").alias("account"),
                                    model.punch_store_of(F.col("store_id")).alias("store_code"), "net_sales", "cogs")
    by = s.groupingSets([["date_key", "account"], ["date_key", "store_code"]], "date_key", "account", "store_code").agg(
        (F.grouping("account") == 0).alias("is_margin"), F.sum("net_sales").alias("net_sales"),
        F.sum(F.col("net_sales") - F.col("cogs")).alias("margin"))
    hours = _labor_day(t).select(F.col("work_date").alias("date_key"), "store_code", "labor_hours", F.lit(True).alias("has_labor"))
    sales = by.join(hours, ["date_key", "store_code"], "left").filter(F.col("is_margin") | F.col("has_labor")).select(
        F.when(F.col("is_margin"), F.lit("gross_margin_pct")).otherwise(F.lit("net_sales_per_labor_hour")).alias("metric_name"),
        "date_key", F.when(F.col("is_margin"), F.col("account")).otherwise(F.col("store_code")).alias("location_key"),
        F.when(F.col("is_margin"), ratio("margin", "net_sales")).otherwise(ratio("net_sales", "labor_hours")).alias("value"))
    out = model.inventory(t).groupBy(F.col("snapshot_date").alias("date_key"), F.col("site_id").alias("location_key")).agg(
        (F.count_if(F.col("on_hand_units") <= 0) / F.count(F.lit(1))).alias("value"))
    return rounded(kpi.anomaly_flags(kpi.metric_series({"stockout_rate": out}).unionByName(sales)))


K29_SQL = f"""
WITH {GHG},
m AS (SELECT source_system, scope, activity_month, SUM(metric_tons_co2e) FILTER (WHERE is_reportable_emissions_row) AS metric_tons_co2e
      FROM fact GROUP BY 1, 2, 3),
l AS (SELECT *, LAG(metric_tons_co2e) OVER (PARTITION BY source_system, scope ORDER BY activity_month) AS prior FROM m),
p AS (SELECT *, (metric_tons_co2e - prior) / NULLIF(prior, 0) AS pct FROM l),
s AS (SELECT *, CASE WHEN prior IS NULL THEN 'NO_PRIOR_PERIOD' WHEN abs(pct) >= 0.5 THEN 'REVIEW_HIGH_VARIANCE'
                     WHEN abs(pct) >= 0.25 THEN 'WATCH_MODERATE_VARIANCE' ELSE 'OK' END AS anomaly_status FROM p)
SELECT source_system, scope, activity_month, round(metric_tons_co2e, 4) AS metric_tons_co2e,
       round(prior, 4) AS prior_metric_tons_co2e, round(pct, 4) AS mom_pct_change, anomaly_status
FROM s WHERE anomaly_status <> 'OK'
"""


@query("k29_mom_anomaly_status", K29_SQL)
def q_k29(spark, d):
    reportable = F.when(F.col("is_reportable_emissions_row"), F.col("metric_tons_co2e"))
    s = ghg.fact(Tables(spark, d)).groupBy("source_system", "scope", "activity_month").agg(F.sum(reportable).alias("metric_tons_co2e"))
    return rounded(kpi.mom_anomaly_status(s, ["source_system", "scope"], "activity_month", "metric_tons_co2e"))


# Role mapping of K31: punch stores belong to the region whose key is their number modulo 5. The data confidence score is the
# share of the distributor-against-POS control rows (Q21, a store and day each) that pass.
K31_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {ALIGNED_PAIRS},
w AS (SELECT week_start, region, SUM(net_sales) AS net_sales, SUM(net_sales - cogs) AS gm FROM sales_lines GROUP BY 1, 2),
i AS (SELECT CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start, r.r_name AS region,
             CAST(count(*) FILTER (WHERE on_hand_units <= 0) AS DOUBLE) / COUNT(*) AS stockout_rate
      FROM inventory JOIN nation n ON inventory.state = n.n_name JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2),
l AS (SELECT CAST(date_trunc('week', work_date) AS DATE) AS week_start, r_name AS region, SUM(labor_hours) AS labor_hours
      FROM lab JOIN region ON CAST(substr(store_code, 2) AS INTEGER) % 5 = r_regionkey GROUP BY 1, 2),
q AS (SELECT CAST(date_trunc('week', c.sale_date) AS DATE) AS week_start, r_name AS region,
             CAST(count(*) FILTER (WHERE c.status = 'Pass') AS DOUBLE) / COUNT(*) AS data_confidence_score
      FROM ({Q21_SQL}) c JOIN customer ON c.store_code = CAST(c_custkey AS VARCHAR)
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT w.week_start, w.region, round(net_sales, 4) AS net_sales, round(gm / NULLIF(net_sales, 0), 4) AS gross_margin_pct,
       round(stockout_rate, 4) AS stockout_rate, round(net_sales / NULLIF(labor_hours, 0), 4) AS revenue_per_labor_hour,
       round(data_confidence_score, 4) AS data_confidence_score
FROM w LEFT JOIN i ON w.week_start = i.week_start AND w.region = i.region
LEFT JOIN l ON w.week_start = l.week_start AND w.region = l.region
LEFT JOIN q ON w.week_start = q.week_start AND w.region = q.region
"""


@query("k31_weekly_regional_export", K31_SQL)
def q_k31(spark, d):
    t = Tables(spark, d)
    grain = ["week_start", "region"]
    week = lambda c: F.date_trunc("week", c).cast("date").alias("week_start")
    w = model.sales_lines(t).groupBy(*grain).agg(F.sum("net_sales").alias("net_sales"),
                                                 F.sum(F.col("net_sales") - F.col("cogs")).alias("__gm"))
    inv = model.inventory(t).join(model.geography(t).select("state", "region"), "state") \
        .groupBy(week("snapshot_date"), "region") \
        .agg(ratio(F.count_if(F.col("on_hand_units") <= 0), F.count(F.lit(1))).alias("stockout_rate"))
    regions = t.region.select(F.col("r_regionkey").alias("__key"), F.col("r_name").alias("region"))
    hours = _labor_day(t).withColumn("__key", F.substring("store_code", 2, 9).cast("long") % 5).join(regions, "__key") \
        .groupBy(week("work_date"), "region").agg(F.sum("labor_hours").alias("labor_hours"))
    stores = model.stores(t).select(F.col("store_id").cast("string").alias("store_code"), "region")
    score = recon.confidence(q21_frame(t).join(stores, "store_code").select(week("sale_date"), "region", "status"), grain, "Pass")
    out = w.join(inv, grain, "left").join(hours, grain, "left").join(score, grain, "left")
    return rounded(out.select(*grain, "net_sales", ratio("__gm", "net_sales").alias("gross_margin_pct"), "stockout_rate",
                              ratio("net_sales", "labor_hours").alias("revenue_per_labor_hour"), "data_confidence_score"))
