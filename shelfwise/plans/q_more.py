"""More measures, dimensions, staging and controls: X4, X13, X14, X19, M8, M19, H5, H7, Q31, K25."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..operators import emissions as E
from ..operators import facts, recon, semantic as S, staging
from ..sources.testdata import Tables
from . import ghg, model, raw
from .oracle import GHG, INVENTORY, SALES_LINES
from .q_facts import pos_day
from .q_history import SHIPMENTS_CTE
from .registry import query, rounded
from .sql_facts import POS_CTE

X4_SQL = f"""
WITH {SALES_LINES},
g AS (SELECT month_start, category, COUNT(DISTINCT store_id) AS selling_stores, SUM(units) AS units
      FROM sales_lines WHERE units > 0 GROUP BY 1, 2),
t AS (SELECT month_start, COUNT(DISTINCT store_id) AS active_stores, COUNT(DISTINCT week_start) AS weeks_in_context
      FROM sales_lines GROUP BY 1)
SELECT month_start, category, selling_stores, round(units, 4) AS units, active_stores, weeks_in_context,
       round(CAST(selling_stores AS DOUBLE) / NULLIF(active_stores, 0), 4) AS distribution_pct,
       round(units / NULLIF(selling_stores, 0), 4) AS rate_of_sale,
       round(units / NULLIF(selling_stores * weeks_in_context, 0), 4) AS velocity_per_store_week
FROM g JOIN t USING (month_start)
"""


@query("x4_distribution_velocity", X4_SQL)
def q_x4(spark, d):
    return rounded(S.distribution_velocity(model.sales_lines(Tables(spark, d)), "month_start", "category", "store_id"))


X13_SQL = f"""
WITH {SALES_LINES},
m AS (SELECT month_start, category, SUM(units) AS units, SUM(net_sales) AS net_sales,
             SUM(net_sales) / NULLIF(SUM(units), 0) AS price FROM sales_lines GROUP BY 1, 2),
j AS (SELECT c.*, p.units AS prior_units, p.net_sales AS prior_sales, p.price AS prior_price
      FROM m c LEFT JOIN m p ON p.category = c.category AND p.month_start = CAST(c.month_start - INTERVAL 1 MONTH AS DATE)),
e AS (SELECT *, net_sales - COALESCE(prior_sales, 0) AS tot,
             COALESCE(prior_units, 0) * (COALESCE(price, 0) - COALESCE(prior_price, 0)) AS pe,
             COALESCE(prior_price, 0) * (units - COALESCE(prior_units, 0)) AS ve FROM j)
SELECT month_start, category, round(net_sales, 4) AS net_sales, round(prior_sales, 4) AS prior_sales,
       round(tot, 4) AS revenue_change, round(pe, 4) AS price_effect, round(ve, 4) AS volume_effect,
       round(tot - pe - ve, 4) AS mix_effect
FROM e
"""


@query("x13_pvm_vs_prior", X13_SQL)
def q_x13(spark, d):
    return rounded(S.pvm_vs_prior(model.sales_lines(Tables(spark, d)), "month_start", ["category"]))


X14_SQL = f"""
WITH {SALES_LINES}, {INVENTORY},
i AS (SELECT month_start, category, AVG(on_hand_units) AS avg_on_hand,
             CAST(count(*) FILTER (WHERE on_hand_units > 0) AS DOUBLE) / COUNT(*) AS instock_rate FROM inventory GROUP BY 1, 2),
s AS (SELECT month_start, category, SUM(units) AS units_sold FROM sales_lines GROUP BY 1, 2),
j AS (SELECT i.*, units_sold, COALESCE(units_sold, 0) * 12.0 / NULLIF(avg_on_hand, 0) AS annualised_turnover,
             avg_on_hand / NULLIF(units_sold / NULLIF(CAST(dayofmonth(last_day(i.month_start)) AS DOUBLE), 0), 0) AS days_on_hand
      FROM i LEFT JOIN s ON i.month_start = s.month_start AND i.category = s.category)
SELECT month_start, category, round(avg_on_hand, 4) AS avg_on_hand, round(instock_rate, 4) AS instock_rate,
       round(units_sold, 4) AS units_sold, round(annualised_turnover, 4) AS annualised_turnover,
       round(days_on_hand, 4) AS days_on_hand,
       round(greatest(0.5 * instock_rate + 0.5 * least(COALESCE(annualised_turnover, 0.0) / 12.0, 1.0), 0.0), 4) AS health_score
FROM j
"""


@query("x14_inventory_health_score", X14_SQL)
def q_x14(spark, d):
    t = Tables(spark, d)
    return rounded(S.inventory_health_score(model.inventory(t), model.sales_lines(t), "month_start", ["category"],
                                            ["category"]))


X19_SQL = f"""
WITH {SALES_LINES}, {GHG},
g AS (SELECT activity_month,
             SUM(CASE WHEN scope = 'Scope 1' AND is_reportable_emissions_row THEN metric_tons_co2e END) AS scope1_t,
             SUM(CASE WHEN scope = 'Scope 2' AND is_reportable_emissions_row THEN metric_tons_co2e END) AS scope2_t,
             SUM(CASE WHEN scope = 'Scope 3' AND is_reportable_emissions_row THEN metric_tons_co2e END) AS scope3_t,
             SUM(CASE WHEN is_reportable_emissions_row THEN metric_tons_co2e END) AS total_t, COUNT(*) AS rows,
             count(*) FILTER (WHERE is_reportable_emissions_row) AS reportable_rows FROM fact GROUP BY 1),
r AS (SELECT month_start AS activity_month, SUM(net_sales) AS revenue FROM sales_lines GROUP BY 1)
SELECT g.activity_month, round(scope1_t, 4) AS scope1_t, round(scope2_t, 4) AS scope2_t, round(scope3_t, 4) AS scope3_t,
       round(total_t, 4) AS total_t, rows, reportable_rows, round(revenue, 4) AS revenue,
       round(CAST(reportable_rows AS DOUBLE) / NULLIF(rows, 0), 4) AS reportable_rate,
       round(total_t * 1000.0 / NULLIF(revenue, 0), 4) AS t_per_1k_revenue,
       CASE WHEN CAST(reportable_rows AS DOUBLE) / NULLIF(rows, 0) < 0.95 THEN 'Review' ELSE 'OK' END AS emissions_status
FROM g LEFT JOIN r ON g.activity_month = r.activity_month
"""


@query("x19_emissions_measures", X19_SQL)
def q_x19(spark, d):
    t = Tables(spark, d)
    return rounded(S.emissions_measures(ghg.fact(t), model.sales_lines(t)))


def _products(t):
    return t.part.select(F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("product_name"))


M8_SQL = f"""
WITH {POS_CTE}
SELECT posd.sku, sale_date, store_code, pos_lines, pos_transactions, round(units, 4) AS units,
       round(gross_sales, 4) AS gross_sales, round(net_sales, 4) AS net_sales, p_name AS product_name,
       COALESCE(p_name, 'Unknown ' || posd.sku) AS product_label
FROM posd LEFT JOIN part ON posd.sku = CAST(p_partkey AS VARCHAR)
"""


@query("m8_pos_daily_labeled", M8_SQL)
def q_m8(spark, d):
    t = Tables(spark, d)
    return rounded(facts.with_product_label(pos_day(t), _products(t)))


M19_SQL = f"""
WITH {INVENTORY},
k AS (SELECT CAST(l_partkey AS VARCHAR) AS sku FROM lineitem UNION SELECT CAST(sku AS VARCHAR) FROM inventory
      UNION SELECT CAST(p_partkey AS VARCHAR) FROM part)
SELECT k.sku, p_name AS product_name, COALESCE(p_name, 'Unknown ' || k.sku) AS product_label,
       p_name IS NOT NULL AS is_known_product
FROM k LEFT JOIN part ON k.sku = CAST(p_partkey AS VARCHAR)
"""


@query("m19_product_dimension", M19_SQL)
def q_m19(spark, d):
    t = Tables(spark, d)
    keys = [t.lineitem.select(F.col("l_partkey").alias("sku")), model.inventory(t).select("sku"),
            t.part.select(F.col("p_partkey").alias("sku"))]
    return facts.product_dimension(keys, _products(t))


def pos_text_extract(t):
    p = raw.pos_lines(t)
    k = F.col("txn_id")
    ts_txt = F.when(k % 2 == 0, F.concat(F.date_format("txn_date", "yyyy-MM-dd"), F.lit(" 10:30:00"))) \
        .otherwise(F.concat(F.date_format("txn_date", "MM/dd/yyyy"), F.lit(" 10:30")))
    return p.select("txn_id", ts_txt.alias("txn_ts_raw"), F.when(k % 2 == 0, F.col("txn_date")).alias("txn_date"),
                    F.concat(F.col("store_code"), F.lit(" ")).alias("store_code_norm"),
                    F.col("sku").alias("product_sku_norm"),
                    F.concat(F.col("qty").cast("int").cast("string"), F.lit(" ea")).alias("qty_raw"),
                    F.when(F.col("line_number") % 3 != 0, F.col("qty").cast("int")).alias("qty"),
                    "gross_amount", "net_amount", F.when(k % 3 == 0, F.lit(12.5)).alias("unit_price"), F.lit("$ 9.75").alias("unit_price_raw"),
                    F.when(k % 4 == 0, F.lit("10%")).when(k % 4 == 1, F.lit("none")).alias("discount_pct_raw"))


H5_SQL = f"""
WITH pos AS (SELECT l_orderkey AS txn_id, l_linenumber AS line_number, CAST(o_orderdate AS DATE) AS d,
                    CAST(o_custkey AS VARCHAR) AS sc, CAST(l_partkey AS VARCHAR) AS sku, l_quantity AS q,
                    CAST(l_extendedprice AS DECIMAL(18,4)) AS gross_amount, CAST(CAST(l_extendedprice AS DECIMAL(9,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net_amount
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
x AS (SELECT txn_id, CASE WHEN txn_id % 2 = 0 THEN strftime(d, '%Y-%m-%d') || ' 10:30:00'
                          ELSE strftime(d, '%m/%d/%Y') || ' 10:30' END AS txn_ts_raw,
             CASE WHEN txn_id % 2 = 0 THEN d END AS txn_date0, sc || ' ' AS store_code_norm, sku AS product_sku_norm,
             CAST(CAST(q AS INTEGER) AS VARCHAR) || ' ea' AS qty_raw,
             CASE WHEN line_number % 3 <> 0 THEN CAST(q AS INTEGER) END AS qty0, gross_amount, net_amount FROM pos),
s AS (SELECT txn_id,
             CASE WHEN regexp_matches(trim(txn_ts_raw), '^\\d{{4}}-\\d{{2}}-\\d{{2}}[ T]\\d{{2}}:\\d{{2}}(:\\d{{2}})?$')
                    THEN COALESCE(try_strptime(replace(trim(txn_ts_raw), 'T', ' '), '%Y-%m-%d %H:%M:%S'),
                                  try_strptime(replace(trim(txn_ts_raw), 'T', ' '), '%Y-%m-%d %H:%M'))
                  WHEN regexp_matches(trim(txn_ts_raw), '^\\d{{2}}/\\d{{2}}/\\d{{4}} \\d{{2}}:\\d{{2}}(:\\d{{2}})?$')
                    THEN COALESCE(try_strptime(trim(txn_ts_raw), '%m/%d/%Y %H:%M:%S'),
                                  try_strptime(trim(txn_ts_raw), '%m/%d/%Y %H:%M')) END AS txn_ts,
             txn_date0, NULLIF(trim(store_code_norm), '') AS store_code, NULLIF(trim(product_sku_norm), '') AS sku,
             COALESCE(qty0, TRY_CAST(NULLIF(regexp_replace(trim(qty_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)) AS qty,
             gross_amount, net_amount, CASE WHEN txn_id % 3 = 0 THEN 12.5 ELSE 9.75 END AS unit_price,
             CASE WHEN txn_id % 4 = 0 THEN 10 END AS discount_pct, CAST(NULL AS VARCHAR) AS load_id, CAST(NULL AS TIMESTAMP) AS ingested_at FROM x),
t AS (SELECT * EXCLUDE (txn_date0), COALESCE(txn_date0, CAST(txn_ts AS DATE)) AS txn_date FROM s)
SELECT txn_id, txn_ts, txn_date, store_code, sku, qty, round(gross_amount, 4) AS gross_amount,
       round(net_amount, 4) AS net_amount, round(unit_price, 4) AS unit_price, round(discount_pct, 4) AS discount_pct, load_id, ingested_at,
       (txn_id IS NULL OR txn_date IS NULL OR store_code IS NULL OR sku IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY txn_id) > 1 AS is_duplicate_candidate
FROM t
"""


@query("h5_stage_pos", H5_SQL)
def q_h5(spark, d):
    return rounded(staging.stage_pos(pos_text_extract(Tables(spark, d))))


def wms_text_extract(t):
    s = model.shipments(t)
    return s.select(F.date_format("ship_date", "MM/dd/yyyy").alias("ship_date_raw"),
                    F.col("shipment_id").alias("shipment_id_norm"),
                    F.concat(F.lit("W"), F.col("site_id").cast("string")).alias("site_code_norm"),
                    F.col("sku").cast("string").alias("sku_norm"),
                    F.col("units_shipped").cast("int").cast("string").alias("units_shipped_raw"),
                    F.concat(F.lit(" "), F.lower("carrier")).alias("carrier_norm"), "load_id")


H7_SQL = f"""
WITH {SHIPMENTS_CTE},
s AS (SELECT CAST(try_strptime(trim(strftime(ship_date, '%m/%d/%Y')), '%m/%d/%Y') AS DATE) AS ship_date,
             NULLIF(trim(shipment_id), '') AS shipment_id, NULLIF(trim('W' || CAST(site_id AS VARCHAR)), '') AS site_code,
             NULLIF(trim(CAST(sku AS VARCHAR)), '') AS sku,
             TRY_CAST(NULLIF(regexp_replace(trim(CAST(CAST(units_shipped AS INTEGER) AS VARCHAR)), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)
               AS units_shipped,
             NULLIF(trim(lower(carrier)), '') AS carrier, load_id FROM shipments)
SELECT *, COALESCE(units_shipped < 0, FALSE) AS is_negative_units, units_shipped IS NULL AS is_missing_units,
       (ship_date IS NULL OR site_code IS NULL OR sku IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY load_id, ship_date, shipment_id, site_code, sku) > 1 AS is_duplicate_candidate
FROM s
"""


@query("h7_stage_wms_shipments", H7_SQL)
def q_h7(spark, d):
    return staging.stage_wms_shipments(wms_text_extract(Tables(spark, d)))


Q31_SQL = f"""
WITH {GHG}
SELECT 'missing_factor' AS check_name, CAST(count(*) FILTER (WHERE has_missing_factor_join) AS BIGINT) AS control_count,
       count(*) FILTER (WHERE has_missing_factor_join) AS fact_count, TRUE AS ties_out FROM fact
UNION ALL
SELECT 'negative_activity', CAST(count(*) FILTER (WHERE has_negative_activity) AS BIGINT),
       count(*) FILTER (WHERE has_negative_activity), TRUE FROM fact
UNION ALL
SELECT 'unknown_activity_type', CAST(count(*) FILTER (WHERE has_unknown_activity_type) AS BIGINT),
       count(*) FILTER (WHERE has_unknown_activity_type), TRUE FROM fact
"""


@query("q31_control_tieout", Q31_SQL)
def q_q31(spark, d):
    fact = ghg.fact(Tables(spark, d))
    ctrl = E.emissions_controls(fact)
    return recon.control_tieout({
        "missing_factor": (ctrl, "missing_factor_rows", fact, F.col("has_missing_factor_join")),
        "negative_activity": (ctrl, "negative_activity_rows", fact, F.col("has_negative_activity")),
        "unknown_activity_type": (ctrl, "unknown_activity_type_rows", fact, F.col("has_unknown_activity_type")),
    })


# Fixed KPI driver tree (KPI → driver → lever), joined with the latest month's KPI values.
DRIVER_TREE = (
    ("net_sales", "volume", "distribution and rate of sale"),
    ("net_sales", "price", "list price and discount depth"),
    ("gross_margin_pct", "cogs", "product cost and mix"),
    ("gross_margin_pct", "discount", "promo depth"),
    ("units", "doors", "active selling accounts"),
    ("discount_rate", "promo", "promo frequency"),
)

K25_SQL = f"""
WITH {SALES_LINES},
m AS (SELECT month_start, SUM(net_sales) AS net_sales, SUM(units) AS units,
             (SUM(net_sales) - SUM(cogs)) / NULLIF(SUM(net_sales), 0) AS gross_margin_pct,
             (SUM(gross_sales) - SUM(net_sales)) / NULLIF(SUM(gross_sales), 0) AS discount_rate
      FROM sales_lines WHERE month_start = (SELECT max(month_start) FROM sales_lines) GROUP BY 1),
v AS (SELECT month_start, 'net_sales' AS kpi_name, net_sales AS kpi_value FROM m UNION ALL
      SELECT month_start, 'units', units FROM m UNION ALL SELECT month_start, 'gross_margin_pct', gross_margin_pct FROM m
      UNION ALL SELECT month_start, 'discount_rate', discount_rate FROM m),
tree(kpi_name, driver, lever) AS (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in DRIVER_TREE)})
SELECT tree.kpi_name, driver, lever, month_start, round(kpi_value, 4) AS kpi_value FROM tree JOIN v USING (kpi_name)
"""


@query("k25_driver_tree_values", K25_SQL)
def q_k25(spark, d):
    s = model.sales_lines(Tables(spark, d))
    mx = s.agg(F.max("month_start").alias("month_start"))
    m = s.join(F.broadcast(mx), "month_start").groupBy("month_start").agg(
        F.sum("net_sales").alias("net_sales"), F.sum("units").alias("units"),
        ratio(F.sum("net_sales") - F.sum("cogs"), F.sum("net_sales")).alias("gross_margin_pct"),
        ratio(F.sum("gross_sales") - F.sum("net_sales"), F.sum("gross_sales")).alias("discount_rate"))
    v = m.unpivot(["month_start"], ["net_sales", "units", "gross_margin_pct", "discount_rate"], "kpi_name", "kpi_value")
    tree = spark.createDataFrame(list(DRIVER_TREE), "kpi_name string, driver string, lever string")
    return rounded(F.broadcast(tree).join(v, "kpi_name").select("kpi_name", "driver", "lever", "month_start", "kpi_value"))
