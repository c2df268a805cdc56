"""Reconciliation and control queries (Q16–Q27, Q36)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import dedup, facts, history, recon, staging, variance
from ..session import materialized
from ..sources.testdata import Tables
from . import model, raw
from .oracle import FORECAST_EXTRACT, INVENTORY, PUNCHES, SALES_LINES
from .q_facts import dist_daily, pos_day
from .q_history import M17_SQL
from .q_variance import _fva
from .registry import query, rounded
from .sql_facts import DIST_CTE, FIN_CTE, POS_CTE

AS_OF = "2001-08-31"


def q21_frame(t, dist=None, pos=None):
    return recon.recon_distributor_vs_pos(dist or dist_daily(t, ["net_sales", "gross_sales", "units"]), pos or pos_day(t))


Q21_CORE = f"""
WITH {DIST_CTE}, {POS_CTE},
d AS (SELECT sale_date, store_code, SUM(COALESCE(net_sales, 0)) AS dist_net_sales,
             SUM(COALESCE(gross_sales, 0)) AS dist_gross_sales, SUM(COALESCE(CAST(units AS DOUBLE), 0)) AS dist_qty
      FROM dist GROUP BY 1, 2),
p AS (SELECT sale_date, store_code, SUM(COALESCE(net_sales, 0)) AS pos_net_sales,
             SUM(COALESCE(gross_sales, 0)) AS pos_gross_sales, SUM(COALESCE(units, 0)) AS pos_qty FROM posd GROUP BY 1, 2),
j AS (SELECT COALESCE(d.sale_date, p.sale_date) AS sale_date, COALESCE(d.store_code, p.store_code) AS store_code,
             dist_net_sales, pos_net_sales, COALESCE(pos_net_sales, 0) - COALESCE(dist_net_sales, 0) AS delta_net_sales,
             dist_gross_sales, pos_gross_sales,
             COALESCE(pos_gross_sales, 0) - COALESCE(dist_gross_sales, 0) AS delta_gross_sales,
             dist_qty, pos_qty, COALESCE(pos_qty, 0) - COALESCE(dist_qty, 0) AS delta_qty,
             CASE WHEN greatest(abs(COALESCE(dist_net_sales, 0)), abs(COALESCE(pos_net_sales, 0))) = 0 THEN 0.0
                  ELSE abs(COALESCE(dist_net_sales, 0) - COALESCE(pos_net_sales, 0))
                       / greatest(abs(COALESCE(dist_net_sales, 0)), abs(COALESCE(pos_net_sales, 0))) END
               AS delta_pct_net_sales
      FROM d FULL OUTER JOIN p ON d.sale_date = p.sale_date AND d.store_code = p.store_code),
q21 AS (SELECT *, 0.01 AS tolerance_pct,
               CASE WHEN sale_date IS NULL OR store_code IS NULL THEN 'Fail' WHEN delta_pct_net_sales <= 0.01 THEN 'Pass'
                    WHEN delta_pct_net_sales <= 0.02 THEN 'Warning' ELSE 'Fail' END AS status FROM j)"""

Q21_SQL = Q21_CORE + """
SELECT sale_date, store_code, round(dist_net_sales, 4) AS dist_net_sales, round(pos_net_sales, 4) AS pos_net_sales,
       round(delta_net_sales, 4) AS delta_net_sales, round(dist_gross_sales, 4) AS dist_gross_sales,
       round(pos_gross_sales, 4) AS pos_gross_sales, round(delta_gross_sales, 4) AS delta_gross_sales,
       round(dist_qty, 4) AS dist_qty, round(pos_qty, 4) AS pos_qty, round(delta_qty, 4) AS delta_qty,
       round(delta_pct_net_sales, 4) AS delta_pct_net_sales, round(CAST(tolerance_pct AS DOUBLE), 4) AS tolerance_pct,
       status
FROM q21
"""


@query("q21_recon_distributor_vs_pos", Q21_SQL)
def q_q21(spark, d):
    return rounded(q21_frame(Tables(spark, d)))


def q22_frame(t):
    s = model.sales_lines(t).select(F.col("month_start").alias("period_month"), "net_sales", "gross_sales", "cogs")
    g = staging.stage_finance_actuals(raw.finance_actuals_extract(t))
    return recon.recon_sales_to_ledger(s, g)


Q22_CORE = f"""
WITH {SALES_LINES}, {FIN_CTE},
m AS (SELECT month_start AS period_month, SUM(COALESCE(net_sales, 0)) AS mart_net_sales,
             SUM(COALESCE(gross_sales, 0)) AS mart_gross_sales, SUM(COALESCE(cogs, 0)) AS mart_cogs,
             SUM(COALESCE(net_sales, 0) - COALESCE(cogs, 0)) AS mart_gross_margin FROM sales_lines GROUP BY 1),
g AS (SELECT period_month, SUM(actual_amount) FILTER (WHERE kpi_category = 'net_sales') AS gl_net_sales,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'gross_sales') AS gl_gross_sales,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'cogs') AS gl_cogs,
             SUM(actual_amount) FILTER (WHERE kpi_category = 'gross_margin') AS gl_gross_margin FROM k GROUP BY 1),
r AS (SELECT COALESCE(m.period_month, g.period_month) AS period_month, m.*, g.* EXCLUDE (period_month)
      FROM m FULL OUTER JOIN g ON m.period_month = g.period_month),
melt AS (SELECT period_month, 'net_sales' AS metric, mart_net_sales AS mart_amount, gl_net_sales AS gl_amount FROM r
         UNION ALL SELECT period_month, 'gross_sales', mart_gross_sales, gl_gross_sales FROM r
         UNION ALL SELECT period_month, 'cogs', mart_cogs, gl_cogs FROM r
         UNION ALL SELECT period_month, 'gross_margin', mart_gross_margin, gl_gross_margin FROM r),
q22 AS (
  SELECT period_month, metric, mart_amount, gl_amount, COALESCE(mart_amount, 0) - COALESCE(gl_amount, 0) AS diff_amount,
         CASE WHEN greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) = 0 THEN 0.0
              ELSE abs(COALESCE(mart_amount, 0) - COALESCE(gl_amount, 0))
                   / greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) END AS pct_diff,
         CASE WHEN mart_amount IS NULL THEN 'FAIL_missing_mart' WHEN gl_amount IS NULL THEN 'FAIL_missing_gl'
              WHEN abs(COALESCE(mart_amount, 0) - COALESCE(gl_amount, 0)) <= 500 THEN 'PASS'
              WHEN metric = 'gross_margin' AND greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) > 0
                AND abs(COALESCE(mart_amount, 0) - COALESCE(gl_amount, 0))
                    / greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) <= 0.035 THEN 'PASS'
              WHEN metric <> 'gross_margin' AND greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) > 0
                AND abs(COALESCE(mart_amount, 0) - COALESCE(gl_amount, 0))
                    / greatest(abs(COALESCE(mart_amount, 0)), abs(COALESCE(gl_amount, 0))) <= 0.02 THEN 'PASS'
              ELSE 'FAIL_mismatch' END AS status
  FROM melt)"""

Q22_SQL = Q22_CORE + """
SELECT period_month, metric, round(mart_amount, 4) AS mart_amount, round(gl_amount, 4) AS gl_amount,
       round(diff_amount, 4) AS diff_amount, round(pct_diff, 4) AS pct_diff, status FROM q22
"""


@query("q22_recon_sales_to_ledger", Q22_SQL)
def q_q22(spark, d):
    return rounded(q22_frame(Tables(spark, d)))


def _store_flags(t, dist=None, pos=None):
    """Fact models with the flags of rows that have no partner in the store and product dimensions."""
    st = model.stores(t).select(F.col("store_id").cast("string").alias("__store"))
    pr = t.part.select(F.col("p_partkey").cast("string").alias("__sku"))
    # Punch stores are codes of their own: their dimension is the punch store of every account.
    ps = model.stores(t).select(model.punch_store_of(F.col("store_id")).alias("__store")).distinct()

    def flagged(df, stores, products=None):
        df = df.join(stores, df["store_code"] == stores["__store"], "left")
        return df.join(products, df["sku"] == products["__sku"], "left") if products is not None else df
    labor = history.labor_store_daily(history.labor_daily_employee(model.punches(t)))
    return flagged(dist or dist_daily(t), st, pr), flagged(labor, ps), flagged(pos or pos_day(t), st)


Q21R_DAYS = 90
Q21R_SQL = Q21_SQL + f""" WHERE sale_date >= CAST((SELECT max(CAST(o_orderdate AS DATE)) FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) - INTERVAL {Q21R_DAYS} DAY AS DATE)
"""


@query("q21_recon_recent_days", Q21R_SQL)
def q_q21_recent(spark, d):
    """The same reconciliation over the trailing 90 days; the bound is a literal on both sides."""
    t = Tables(spark, d)
    end = model.latest_sale_date(t)
    start = end and end - dt.timedelta(days=Q21R_DAYS)
    return rounded(recon.recon_distributor_vs_pos(dist_daily(t), pos_day(t), start=start))


def q16_frame(t, dist=None, pos=None):
    no_store = F.col("__store").isNull()
    dist, labor, pos = _store_flags(t, dist, pos)
    return recon.missing_dim_control([
        ("mart.fact_sales_distributor_daily", dist, "sale_date", "dim_store", no_store),
        ("mart.fact_labor_daily", labor, "work_date", "dim_store", no_store),
        ("mart.fact_sales_pos_daily", pos, "sale_date", "dim_store", no_store)])


LABOR_CTE = f"""labor AS (SELECT work_date, store_code FROM ({M17_SQL}))"""
STORE_CTE = """st AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS k FROM customer),
ps AS (SELECT DISTINCT 'S' || lpad(CAST(c_custkey % 8 AS VARCHAR), 2, '0') AS k FROM customer)"""

Q16_CORE = f"""
WITH {DIST_CTE}, {POS_CTE}, {LABOR_CTE}, {STORE_CTE},
g AS (SELECT 'mart.fact_sales_distributor_daily' AS model_name, sale_date AS grain_date, 'dim_store' AS dim_name, COUNT(*) AS fact_rows,
             count(*) FILTER (WHERE st.k IS NULL) AS missing_dim_rows FROM dist LEFT JOIN st ON store_code = st.k GROUP BY 2
      UNION ALL SELECT 'mart.fact_labor_daily', work_date, 'dim_store', COUNT(*), count(*) FILTER (WHERE ps.k IS NULL)
             FROM labor LEFT JOIN ps ON store_code = ps.k GROUP BY 2
      UNION ALL SELECT 'mart.fact_sales_pos_daily', sale_date, 'dim_store', COUNT(*), count(*) FILTER (WHERE st.k IS NULL)
             FROM posd LEFT JOIN st ON store_code = st.k GROUP BY 2),
q16 AS (SELECT *, CASE WHEN fact_rows = 0 THEN 0.0 ELSE CAST(missing_dim_rows AS DOUBLE) / fact_rows END AS missing_pct,
               CASE WHEN fact_rows = 0 THEN 'WARN_no_rows' WHEN missing_dim_rows = 0 THEN 'PASS'
                    WHEN CAST(missing_dim_rows AS DOUBLE) / fact_rows <= 0.001 THEN 'WARN_low' ELSE 'FAIL' END AS status FROM g)"""

Q16_SQL = Q16_CORE + """
SELECT model_name, grain_date, dim_name, fact_rows, missing_dim_rows, round(missing_pct, 4) AS missing_pct, status FROM q16
"""


@query("q16_missing_dim_control", Q16_SQL)
def q_q16(spark, d):
    return rounded(q16_frame(Tables(spark, d)))


Q17_SQL = f"""
WITH {DIST_CTE}, {LABOR_CTE}, {STORE_CTE},
s AS (SELECT COUNT(*) AS n, count(*) FILTER (WHERE st.k IS NULL) AS a, count(*) FILTER (WHERE p_partkey IS NULL) AS b,
             count(*) FILTER (WHERE st.k IS NULL OR p_partkey IS NULL) AS c
      FROM dist LEFT JOIN st ON store_code = st.k LEFT JOIN part ON sku = CAST(p_partkey AS VARCHAR)),
l AS (SELECT COUNT(*) AS n, count(*) FILTER (WHERE ps.k IS NULL) AS a FROM labor LEFT JOIN ps ON store_code = ps.k)
SELECT 'mart.fact_sales_distributor_daily' AS fact_model, n AS n_fact_rows, a AS n_missing_dim_store, b AS n_missing_dim_sku,
       c AS n_missing_any_dim, round(CAST(a AS DOUBLE) / NULLIF(n, 0), 4) AS pct_missing_dim_store,
       round(CAST(b AS DOUBLE) / NULLIF(n, 0), 4) AS pct_missing_dim_sku, round(CAST(c AS DOUBLE) / NULLIF(n, 0), 4) AS pct_missing_any_dim
FROM s
UNION ALL SELECT 'mart.fact_labor_daily', n, a, 0, a, round(CAST(a AS DOUBLE) / NULLIF(n, 0), 4), NULL,
       round(CAST(a AS DOUBLE) / NULLIF(n, 0), 4) FROM l
"""


@query("q17_dim_join_coverage", Q17_SQL)
def q_q17(spark, d):
    dist, labor, _ = _store_flags(Tables(spark, d))
    no_store, no_sku = F.col("__store").isNull(), F.col("__sku").isNull()
    return rounded(recon.dim_join_coverage({
        "mart.fact_sales_distributor_daily": (dist, {"dim_store": no_store, "dim_sku": no_sku}),
        "mart.fact_labor_daily": (labor, {"dim_store": no_store})}, ["dim_store", "dim_sku"]))


def latest_dates(t):
    fin = facts.finance_monthly(staging.stage_finance_actuals(raw.finance_actuals_extract(t)))
    parts = [recon.latest_date_of(model.sales_lines(t), ["sale_date", "txn_date"], "fact_sales"),
             recon.latest_date_of(model.inventory(t), ["snapshot_date"], "fact_inventory"),
             recon.latest_date_of(model.punches(t), ["work_date", "punch_date"], "fact_labor"),
             recon.latest_date_of(fin, ["month_start", "period_month"], "fact_actuals_monthly")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


LATEST_SQL = f"""
{SALES_LINES}, {INVENTORY}, {PUNCHES}, {FIN_CTE},
ld AS (SELECT 'fact_sales' AS model_name, 'sale_date' AS date_column, max(sale_date) AS latest_date FROM sales_lines
       UNION ALL SELECT 'fact_inventory', 'snapshot_date', max(snapshot_date) FROM inventory
       UNION ALL SELECT 'fact_labor', 'work_date', max(work_date) FROM punches
       UNION ALL SELECT 'fact_actuals_monthly', 'period_month', max(period_month) FROM k)"""

Q18_SQL = f"""
WITH {LATEST_SQL}
SELECT model_name, date_column, latest_date, CAST(DATE '{AS_OF}' - latest_date AS INTEGER) AS lag_days,
       CASE WHEN latest_date IS NULL THEN 'Fail' WHEN DATE '{AS_OF}' - latest_date <= 2 THEN 'Pass'
            WHEN DATE '{AS_OF}' - latest_date <= 7 THEN 'Warning' ELSE 'Fail' END AS freshness_status
FROM ld
"""


@query("q18_freshness", Q18_SQL)
def q_q18(spark, d):
    return recon.freshness(latest_dates(Tables(spark, d)), AS_OF)


Q19_SQL = f"""
WITH {LATEST_SQL},
l AS (SELECT *, CASE WHEN model_name = 'fact_actuals_monthly' THEN 'finance' ELSE 'operations' END AS domain,
             CASE WHEN model_name = 'fact_actuals_monthly' THEN 40 ELSE 2 END AS p,
             CASE WHEN model_name = 'fact_actuals_monthly' THEN 60 ELSE 5 END AS w FROM ld)
SELECT model_name, date_column, latest_date, domain, CAST(DATE '{AS_OF}' - latest_date AS INTEGER) AS lag_days,
       CASE WHEN latest_date IS NULL THEN 'Fail' WHEN DATE '{AS_OF}' - latest_date <= p THEN 'Pass'
            WHEN DATE '{AS_OF}' - latest_date <= w THEN 'Warning' ELSE 'Fail' END AS freshness_status
FROM l
"""


@query("q19_freshness_by_domain", Q19_SQL)
def q_q19(spark, d):
    ld = latest_dates(Tables(spark, d)).withColumn(
        "domain", F.when(F.col("model_name") == "fact_actuals_monthly", F.lit("finance")).otherwise(F.lit("operations")))
    return recon.freshness(ld, AS_OF, pass_days=2, warn_days=5, limits={"finance": (40, 60)}, domain_col="domain") \
        .select("model_name", "date_column", "latest_date", "domain", "lag_days", "freshness_status")


Q20_SQL = f"""
WITH {SALES_LINES}, {INVENTORY}, {PUNCHES}
SELECT 'fact_sales' AS model_name, sale_date AS activity_date, COUNT(*) AS row_count FROM sales_lines GROUP BY 2
UNION ALL SELECT 'fact_inventory', snapshot_date, COUNT(*) FROM inventory GROUP BY 2
UNION ALL SELECT 'fact_labor', work_date, COUNT(*) FROM punches GROUP BY 2
"""


@query("q20_rowcounts_daily", Q20_SQL)
def q_q20(spark, d):
    t = Tables(spark, d)
    return recon.rowcounts_daily({"fact_sales": (model.sales_lines(t), "sale_date"),
                                  "fact_inventory": (model.inventory(t), "snapshot_date"),
                                  "fact_labor": (model.punches(t), "work_date")})


def q23_frame(t):
    # Both daily facts feed two controls: each is built once.
    dist = materialized(dist_daily(t, ["net_sales", "gross_sales", "units"]).drop("channel"), "dist_daily")
    pos = materialized(pos_day(t).select("sale_date", "store_code", "net_sales", "gross_sales", "units"), "pos_daily")
    return recon.unified_controls({
        "recon_distributor_vs_pos": (q21_frame(t, dist, pos), "status", ["sale_date", "store_code"]),
        "recon_sales_to_ledger": (q22_frame(t), "status", ["period_month", "metric"]),
        "missing_dim_joins": (q16_frame(t, dist, pos), "status", ["model_name", "dim_name", "grain_date"]),
    })


Q24_SQL = f"""
SELECT check_name, status, COUNT(*) AS row_count FROM (
  SELECT 'recon_distributor_vs_pos' AS check_name, status FROM ({Q21_SQL}) UNION ALL
  SELECT 'recon_sales_to_ledger', status FROM ({Q22_SQL}) UNION ALL
  SELECT 'missing_dim_joins', status FROM ({Q16_SQL})) GROUP BY 1, 2
"""


@query("q24_control_summary", Q24_SQL)
def q_q24(spark, d):
    return recon.summary_by_status(q23_frame(Tables(spark, d)))


Q25_SQL = f"""
WITH {POS_CTE}
SELECT 'pos_int_vs_mart' AS check_name, a_rows, round(a_total, 4) AS a_total, b_rows, round(b_total, 4) AS b_total,
       a_rows = b_rows AS rows_match, abs(a_total - b_total) < 0.005 AS totals_match
FROM (SELECT COUNT(*) AS a_rows, SUM(net_amount) AS a_total FROM posb),
     (SELECT CAST(SUM(pos_lines) AS BIGINT) AS b_rows, SUM(net_sales) AS b_total FROM posd)
"""


@query("q25_layer_tieout", Q25_SQL)
def q_q25(spark, d):
    t = Tables(spark, d)
    a = dedup.pos_transactions(raw.pos_transactions(t)) \
        .select(F.col("net_amount").alias("net_sales"))
    return rounded(recon.layer_tieout(a, pos_day(t), "net_sales", "pos_int_vs_mart", b_rows_col="pos_lines"))


Q27_SQL = f"""
WITH {SALES_LINES}
SELECT 'fact_sales_lines' AS fact_name, COUNT(*) AS row_count,
       COUNT(DISTINCT (order_id, line_number)) AS distinct_grain_rows,
       COUNT(*) = COUNT(DISTINCT (order_id, line_number)) AS grain_is_unique
FROM sales_lines
"""


@query("q27_grain_sanity", Q27_SQL)
def q_q27(spark, d):
    return recon.grain_sanity(model.sales_lines(Tables(spark, d)), ["order_id", "line_number"], "fact_sales_lines")


Q36_SQL = f"""
WITH {FORECAST_EXTRACT},
b AS (SELECT week_start_date, channel, plan_version, SUM(forecast_net_sales) AS forecast_net_sales,
             SUM(volume_effect) AS volume_effect, SUM(price_effect) AS price_effect,
             SUM(mix_or_residual_effect) AS mix_or_residual_effect, SUM(actual_net_sales) AS actual_net_sales
      FROM pvm WHERE actual_net_sales IS NOT NULL GROUP BY 1, 2, 3)
SELECT week_start_date, channel, plan_version,
       round(forecast_net_sales + volume_effect + price_effect + mix_or_residual_effect, 4) AS explained_actual,
       round(actual_net_sales - (forecast_net_sales + volume_effect + price_effect + mix_or_residual_effect), 4) AS tieout_gap,
       abs(actual_net_sales - (forecast_net_sales + volume_effect + price_effect + mix_or_residual_effect)) <= 0.01 AS ties_out
FROM b
"""


@query("q36_bridge_tieout", Q36_SQL)
def q_q36(spark, d):
    b = variance.variance_bridge(variance.forecast_price_volume(_fva(Tables(spark, d))))
    return rounded(recon.bridge_tieout(b).select("week_start_date", "channel", "plan_version", "explained_actual",
                                                 "tieout_gap", "ties_out"))


Q36_EVENT_SQL = f"""
WITH {FORECAST_EXTRACT}
SELECT business_event, COUNT(*) AS row_count, round(SUM(total_sales_variance), 4) AS total_sales_variance,
       round(SUM(volume_effect), 4) AS volume_effect, round(SUM(price_effect), 4) AS price_effect,
       round(SUM(mix_or_residual_effect), 4) AS mix_or_residual_effect
FROM pvm WHERE actual_net_sales IS NOT NULL GROUP BY 1
"""


@query("q36_variance_by_business_event", Q36_EVENT_SQL)
def q_q36_event(spark, d):
    return rounded(variance.variance_by(variance.forecast_price_volume(_fva(Tables(spark, d))), "business_event"))
