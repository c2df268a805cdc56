"""DuckDB SQL equivalents of the registered queries (same column names).

Shared CTE text mirrors ``plans/model.py`` role for role.
"""

from __future__ import annotations

from .registry import SQL  # noqa: F401

SALES_LINES = """
sales_lines AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
         CAST(o.o_orderdate AS DATE) AS sale_date,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month_start,
         CAST(date_trunc('week', o.o_orderdate) AS DATE) AS week_start,
         c.c_custkey AS store_id, c.c_name AS store_name, n.n_name AS state, r.r_name AS region,
         lower(c.c_mktsegment) AS channel,
         p.p_partkey AS sku, p.p_name AS product_name, p.p_brand AS brand, p.p_type AS category,
         p.p_size AS pack_size, (p.p_type = 'PROMO') AS promo_flag, CAST(p.p_retailprice AS DECIMAL(18,4)) AS list_price,
         l.l_suppkey AS site_id, CAST(l.l_shipdate AS DATE) AS ship_date,
         l.l_returnflag AS return_flag, l.l_linestatus AS line_status, o.o_orderpriority AS order_priority,
         l.l_quantity AS units, CAST(l.l_extendedprice AS DECIMAL(18,4)) AS gross_sales,
         CAST(CAST(l.l_extendedprice AS DECIMAL(9,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS discount_amount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(9,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net_sales,
         CAST(CAST(l.l_quantity AS INTEGER) * CAST(p.p_retailprice AS DECIMAL(9,2)) * 0.6 AS DECIMAL(18,4)) AS cogs
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

K1_SQL = f"""
WITH {SALES_LINES},
b AS (
  SELECT month_start, state, channel, SUM(units) AS units_sold, SUM(gross_sales) AS gross_sales,
         SUM(net_sales) AS net_sales, SUM(cogs) AS cogs
  FROM sales_lines GROUP BY 1, 2, 3
)
SELECT month_start, state, channel,
       round(units_sold, 4) AS units_sold, round(gross_sales, 4) AS gross_sales,
       round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs,
       round(net_sales - cogs, 4) AS gross_margin_dollars,
       round(CASE WHEN net_sales = 0 THEN NULL ELSE (net_sales - cogs) / net_sales END, 4) AS gross_margin_pct,
       round(CASE WHEN units_sold = 0 THEN NULL ELSE gross_sales / units_sold END, 4) AS gross_vwap,
       round(CASE WHEN units_sold = 0 THEN NULL ELSE net_sales / units_sold END, 4) AS net_vwap,
       round(CASE WHEN gross_sales = 0 THEN NULL ELSE (gross_sales - net_sales) / gross_sales END, 4) AS discount_rate
FROM b
"""


ACCOUNT_STATUS_EXTRACT = """
account_status_extract AS (
  SELECT 'L' || CAST(o_orderkey % 4 AS VARCHAR) AS load_id,
         CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS status_date,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
              ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END AS status_date_raw,
         CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS store_code_norm,
         CASE WHEN o_orderkey % 2 = 1 THEN '  ' || lbl || ' ' ELSE lbl END AS account_status_raw,
         o_orderpriority AS status_reason_norm
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Pending approval'
                                     WHEN 'P' THEN 'INACTIVE - closed' END AS lbl FROM orders)
)"""

SALES_DISTRIBUTOR_EXTRACT = SALES_LINES + """,
sales_distributor_extract AS (
  SELECT 'L' || CAST(order_id % 3 AS VARCHAR) AS load_id,
         CASE WHEN line_number % 2 = 0 THEN sale_date END AS sale_date,
         strftime(sale_date, '%m/%d/%Y') AS sale_date_raw,
         CAST(store_id AS VARCHAR) AS store_id_norm,
         CAST(sku AS VARCHAR) AS sku,
         CASE upper(channel) WHEN 'AUTOMOBILE' THEN ' Retail ' WHEN 'BUILDING' THEN 'WHOLESALE club'
              WHEN 'FURNITURE' THEN 'Distributor' WHEN 'HOUSEHOLD' THEN 'retail' WHEN 'MACHINERY' THEN 'eCommerce' END
           AS channel_norm,
         CASE WHEN line_number % 3 <> 0 THEN CAST(units AS INTEGER) END AS qty,
         CAST(CAST(units AS INTEGER) AS VARCHAR) || ' units' AS qty_raw,
         list_price AS unit_list_price, gross_sales, discount_amount,
         CASE WHEN return_flag = 'R' THEN -net_sales ELSE net_sales END AS net_sales, cogs, ' ' || product_name AS product_name_raw,
         CASE WHEN line_number <> 3 THEN 0.05 END AS discount_rate, '0.25 off' AS discount_rate_raw,
         CASE WHEN line_number <> 2 THEN 9.75 END AS unit_net_price, '$' || CAST(CAST(units AS INTEGER) AS VARCHAR) || '.50' AS unit_net_price_raw,
         CASE WHEN line_number % 4 <> 0 THEN 1 END AS orders, '2 orders' AS orders_raw,
         CASE WHEN line_number % 5 <> 0 THEN 1 END AS customers, 'n/a' AS customers_raw
  FROM sales_lines
)"""

TIMECLOCK_EXTRACT = """
timeclock_extract AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%m/%d/%Y %H:%M:%S') END AS punch_ts_raw,
         'E' || CAST(user_id AS VARCHAR) AS employee_id_raw,
         'S' || lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS site_code_norm,
         event_type AS action_raw,
         'L' || CAST(event_id % 2 AS VARCHAR) AS load_id
  FROM events
)"""

PUNCHES = """
punches AS (
  SELECT event_id AS punch_id, 'S' || lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS store_code,
         user_id AS employee_id, ts AS punch_ts, CAST(ts AS DATE) AS work_date, event_type AS action_raw,
         CASE upper(NULLIF(trim(event_type), '')) WHEN 'CLICK' THEN 'IN' WHEN 'VIEW' THEN 'OUT'
              ELSE upper(NULLIF(trim(event_type), '')) END AS action,
         value
  FROM events
)"""

ORDERS_TEXT = """
orders_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id_raw,
         CASE WHEN o_orderkey % 7 = 0 THEN '  '
              WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
              ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END AS order_date_raw,
         CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
              WHEN o_orderkey % 2 = 1 THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS total_raw,
         CASE WHEN o_orderkey % 3 = 0 THEN ' c-' || CAST(o_custkey AS VARCHAR) || ' '
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_raw,
         CASE WHEN o_orderkey % 2 = 1 THEN lower(o_orderpriority) ELSE o_orderpriority || '  ' END AS priority_raw,
         o_orderstatus AS status_raw
  FROM orders
)"""


INVENTORY = """
inventory AS (
  SELECT CAST(l.l_shipdate AS DATE) AS snapshot_date, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month_start,
         l.l_suppkey AS site_id, l.l_partkey AS sku, n.n_name AS state, p.p_type AS category,
         l.l_quantity - 10.0 AS on_hand_units, l.l_quantity AS received_units,
         CASE WHEN l.l_linenumber % 2 = 1 THEN l.l_quantity - 10.0 > 0 END AS in_stock_flag
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _txt(x, scale=4):
    return f"CAST(CAST(round({x}, {scale}) AS DECIMAL(18,{scale})) AS VARCHAR)"


FORECAST_EXTRACT = SALES_LINES + f""",
fa AS (SELECT week_start, store_id, state, region, sku, product_name, category, channel,
              SUM(units) AS actual_units, SUM(net_sales) AS actual_net_sales
       FROM sales_lines GROUP BY ALL),
ff AS (SELECT CAST(week_start + INTERVAL 364 DAY AS DATE) AS week_start, store_id, state, region, sku, product_name,
              category, channel, actual_units AS forecast_units, actual_net_sales AS forecast_net_sales FROM fa),
fj AS (SELECT COALESCE(fa.week_start, ff.week_start) AS week_start, COALESCE(fa.store_id, ff.store_id) AS store_id,
              COALESCE(fa.state, ff.state) AS state, COALESCE(fa.region, ff.region) AS region,
              COALESCE(fa.sku, ff.sku) AS sku, COALESCE(fa.product_name, ff.product_name) AS product_name,
              COALESCE(fa.category, ff.category) AS category, COALESCE(fa.channel, ff.channel) AS channel,
              actual_units, actual_net_sales, forecast_units, forecast_net_sales
       FROM fa FULL OUTER JOIN ff ON fa.week_start = ff.week_start AND fa.store_id = ff.store_id
         AND fa.state = ff.state AND fa.region = ff.region AND fa.sku = ff.sku AND fa.product_name = ff.product_name
         AND fa.category = ff.category AND fa.channel = ff.channel),
forecast_extract AS (
  SELECT strftime(week_start, '%Y-%m-%d') AS week_start_date, CAST(store_id AS VARCHAR) AS store_code, state, region,
         CAST(sku AS VARCHAR) AS sku, product_name, category AS product_family,
         CASE WHEN store_id % 2 = 1 THEN ' ' || upper(channel) ELSE channel END AS channel,
         {_txt('forecast_units')} AS forecast_units, {_txt('actual_units')} AS actual_units,
         {_txt('forecast_net_sales')} AS forecast_net_sales, {_txt('actual_net_sales')} AS actual_net_sales,
         {_txt('forecast_net_sales / forecast_units')} AS forecast_unit_price,
         {_txt('actual_net_sales / actual_units')} AS actual_unit_price,
         CASE WHEN category = 'PROMO' THEN 'Yes' ELSE 'no' END AS promo_flag,
         CASE WHEN actual_units < 5 THEN 'Y' WHEN actual_units IS NOT NULL THEN 'N' END AS stockout_flag,
         CASE WHEN actual_net_sales IS NULL THEN 'true' ELSE 'false' END AS is_partial_actual,
         strftime(week_start, '%B') AS seasonality_label,
         CASE WHEN category = 'PROMO' THEN ' Promo Week ' WHEN month(week_start) = 12 THEN 'HOLIDAY' END AS business_event,
         'baseline' AS plan_version
  FROM fj
),
staged_forecast AS (
  SELECT TRY_CAST(NULLIF(trim(week_start_date), '') AS DATE) AS week_start_date,
         NULLIF(trim(store_code), '') AS store_code, NULLIF(trim(state), '') AS state, NULLIF(trim(region), '') AS region,
         NULLIF(trim(sku), '') AS sku, NULLIF(trim(product_name), '') AS product_name,
         NULLIF(trim(product_family), '') AS product_family, lower(NULLIF(trim(channel), '')) AS channel,
         TRY_CAST(NULLIF(trim(forecast_units), '') AS DOUBLE) AS forecast_units,
         TRY_CAST(NULLIF(trim(actual_units), '') AS DOUBLE) AS actual_units,
         TRY_CAST(NULLIF(trim(forecast_net_sales), '') AS DOUBLE) AS forecast_net_sales,
         TRY_CAST(NULLIF(trim(actual_net_sales), '') AS DOUBLE) AS actual_net_sales,
         TRY_CAST(NULLIF(trim(forecast_unit_price), '') AS DOUBLE) AS forecast_unit_price,
         TRY_CAST(NULLIF(trim(actual_unit_price), '') AS DOUBLE) AS actual_unit_price,
         CASE WHEN lower(trim(promo_flag)) IN ('true','t','yes','y','1') THEN TRUE
              WHEN lower(trim(promo_flag)) IN ('false','f','no','n','0') THEN FALSE END AS promo_flag,
         CASE WHEN lower(trim(stockout_flag)) IN ('true','t','yes','y','1') THEN TRUE
              WHEN lower(trim(stockout_flag)) IN ('false','f','no','n','0') THEN FALSE END AS stockout_flag,
         COALESCE(CASE WHEN lower(trim(is_partial_actual)) IN ('true','t','yes','y','1') THEN TRUE
                       WHEN lower(trim(is_partial_actual)) IN ('false','f','no','n','0') THEN FALSE END, FALSE)
           AS is_partial_actual,
         lower(NULLIF(trim(seasonality_label), '')) AS seasonality_label, lower(NULLIF(trim(business_event), '')) AS business_event, NULLIF(trim(plan_version), '') AS plan_version
  FROM forecast_extract
),
fva AS (
  SELECT *, actual_units - forecast_units AS unit_variance, actual_net_sales - forecast_net_sales AS sales_variance,
         CASE WHEN forecast_net_sales <> 0 THEN (actual_net_sales - forecast_net_sales) / forecast_net_sales END
           AS sales_variance_pct,
         abs(actual_net_sales - forecast_net_sales) AS absolute_sales_error,
         CASE WHEN actual_net_sales <> 0 THEN abs(actual_net_sales - forecast_net_sales) / actual_net_sales END
           AS absolute_percent_error,
         actual_net_sales IS NULL AS is_missing_actual,
         CASE WHEN actual_net_sales IS NULL THEN 'partial_actual'
              WHEN actual_net_sales > forecast_net_sales THEN 'above_forecast'
              WHEN actual_net_sales < forecast_net_sales THEN 'below_forecast' ELSE 'on_forecast' END
           AS forecast_performance_status
  FROM staged_forecast
),
pvm AS (
  SELECT *, sales_variance AS total_sales_variance,
         CASE WHEN actual_net_sales IS NOT NULL THEN (actual_units - forecast_units) * forecast_unit_price END AS volume_effect,
         CASE WHEN actual_net_sales IS NOT NULL THEN (actual_unit_price - forecast_unit_price) * actual_units END AS price_effect,
         CASE WHEN actual_net_sales IS NOT NULL THEN sales_variance - (actual_units - forecast_units) * forecast_unit_price
              - (actual_unit_price - forecast_unit_price) * actual_units END AS mix_or_residual_effect,
         CASE WHEN actual_net_sales IS NULL THEN 'partial_actual' WHEN stockout_flag = TRUE THEN 'stockout'
              WHEN promo_flag = TRUE THEN 'promo'
              WHEN actual_units > forecast_units AND actual_unit_price >= forecast_unit_price THEN 'volume_up'
              WHEN actual_units < forecast_units AND actual_unit_price <= forecast_unit_price THEN 'volume_down'
              WHEN actual_unit_price > forecast_unit_price THEN 'price_up'
              WHEN actual_unit_price < forecast_unit_price THEN 'price_down' ELSE 'base_business' END
           AS primary_variance_driver
  FROM fva
)"""


RETAIL_QUARTERLY = SALES_LINES + f""",
rq_extract AS (
  SELECT CASE WHEN order_id % 17 = 0 THEN ' '
              ELSE CAST(year(sale_date) AS VARCHAR) || 'Q' || CAST(quarter(sale_date) AS VARCHAR) END AS quarter_id,
         CASE WHEN order_id % 19 = 0 THEN '' ELSE strftime(CAST(week_start + INTERVAL 6 DAY AS DATE), '%Y-%m-%d') END
           AS week_end_date,
         CASE WHEN line_number = 7 THEN NULL ELSE CAST(store_id AS VARCHAR) END AS dispensary_account_id,
         CAST(sku AS VARCHAR) AS sku_id,
         {_txt("CASE WHEN return_flag = 'R' THEN -units ELSE units END", 2)} AS units_sold,
         {_txt('gross_sales', 2)} AS gross_sales, {_txt('discount_amount', 2)} AS discount_amount,
         {_txt('net_sales', 2)} AS net_sales
  FROM sales_lines
),
rq AS (
  SELECT NULLIF(trim(quarter_id), '') AS quarter_id, TRY_CAST(NULLIF(trim(week_end_date), '') AS DATE) AS week_end_date,
         NULLIF(trim(dispensary_account_id), '') AS dispensary_account_id, NULLIF(trim(sku_id), '') AS sku_id,
         TRY_CAST(NULLIF(trim(units_sold), '') AS DOUBLE) AS units_sold,
         TRY_CAST(NULLIF(trim(gross_sales), '') AS DOUBLE) AS gross_sales,
         TRY_CAST(NULLIF(trim(discount_amount), '') AS DOUBLE) AS discount_amount,
         TRY_CAST(NULLIF(trim(net_sales), '') AS DOUBLE) AS net_sales
  FROM rq_extract
)"""


GHG = """
factors(factor_id, scope, factor_type, region, activity_unit, factor_value_kg_co2e_per_unit, source_authority,
        effective_start, effective_end, factor_version, is_current) AS (VALUES
  (1, 'Scope 2', 'electricity', 'AFRICA', 'kwh', 0.3, 'grid authority', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (2, 'Scope 2', 'electricity', 'AFRICA', 'kwh', 0.28, 'grid authority', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (3, 'Scope 2', 'electricity', 'AMERICA', 'kwh', 0.35, 'grid authority', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (4, 'Scope 2', 'electricity', 'AMERICA', 'kwh', 0.33, 'grid authority', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (5, 'Scope 2', 'electricity', 'ASIA', 'kwh', 0.4, 'grid authority', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (6, 'Scope 2', 'electricity', 'ASIA', 'kwh', 0.38, 'grid authority', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (7, 'Scope 2', 'electricity', 'EUROPE', 'kwh', 0.45, 'grid authority', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (8, 'Scope 2', 'electricity', 'EUROPE', 'kwh', 0.43, 'grid authority', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (9, 'Scope 2', 'electricity', 'MIDDLE EAST', 'kwh', 0.5, 'grid authority', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (10, 'Scope 1', 'diesel', 'US', 'gallon', 10.21, 'national inventory', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (11, 'Scope 1', 'diesel', 'US', 'gallon', 10.18, 'national inventory', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (12, 'Scope 1', 'natural_gas', 'US', 'therm', 5.3, 'national inventory', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (13, 'Scope 1', 'natural_gas', 'US', 'therm', 5.31, 'national inventory', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (14, 'Scope 3', 'freight_truck', 'US', 'ton_mile', 0.161, 'national inventory', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (15, 'Scope 3', 'freight_truck', 'US', 'ton_mile', 0.158, 'national inventory', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (16, 'Scope 3', 'corrugate', 'US', 'kg', 0.9, 'national inventory', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (17, 'Scope 3', 'corrugate', 'US', 'kg', 0.88, 'national inventory', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y'),
  (18, 'Scope 3', 'plastic_film', 'US', 'kg', 2.1, 'national inventory', DATE '1990-01-01', DATE '1998-12-31', 'v1', 'N'),
  (19, 'Scope 3', 'plastic_film', 'US', 'kg', 2.05, 'national inventory', DATE '1999-01-01', DATE '2099-12-31', 'v2', 'Y')),
facilities AS (
  SELECT upper(trim(' f' || CAST(s_suppkey AS VARCHAR))) AS facility_id, s_name AS facility_name,
         'Warehouse' AS facility_type, n_name AS state_province, 'US' AS country, upper(r_name) AS grid_region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
product_lines AS (
  SELECT upper('pl-' || lower(p_type)) AS product_line_id, p_type AS pt FROM (SELECT DISTINCT p_type FROM part)
  WHERE p_type <> 'PROMO'),
li AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_record_id,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS activity_month,
         CASE WHEN l_suppkey % 10 = 9 THEN 'FX' ELSE 'F' END || CAST(l_suppkey AS VARCHAR) AS facility_id, *
  FROM lineitem),
act0 AS (
  SELECT 'utility_bills' AS source_system, source_record_id, activity_month, 'Scope 2' AS scope, facility_id,
         CAST(NULL AS VARCHAR) AS product_line_id, 'Purchased electricity' AS activity_category,
         'electricity' AS factor_type, l_quantity * 100.0 * CASE WHEN l_tax = 0 THEN -1.0 ELSE 1.0 END AS activity_amount,
         'kwh' AS activity_unit, l_extendedprice * 0.1 AS cost_usd FROM li WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'fuel_usage', source_record_id, activity_month, 'Scope 1', facility_id, NULL, 'Stationary combustion',
         CASE WHEN l_linestatus = 'O' THEN 'diesel' ELSE 'natural_gas' END, l_quantity,
         CASE WHEN l_linestatus = 'O' THEN 'gallon' ELSE 'therm' END, l_extendedprice * 0.05 FROM li WHERE l_returnflag = 'N'
  UNION ALL
  SELECT 'shipping_logistics', source_record_id, activity_month, 'Scope 3', facility_id, 'PL-' || upper(p_type),
         'Upstream transportation', 'freight_truck', l_quantity * 12.5, 'ton_mile', l_extendedprice * 0.02
  FROM li JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'packaging_procurement', CAST(o_orderkey AS VARCHAR), CAST(date_trunc('month', o_orderdate) AS DATE), 'Scope 3',
         'F' || CAST(o_orderkey % 100 AS VARCHAR), NULL, 'Purchased goods - packaging',
         CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown_material' WHEN o_orderpriority = '1-URGENT' THEN 'corrugate'
              ELSE 'plastic_film' END, o_totalprice / 1000.0, 'kg', o_totalprice * 0.01 FROM orders),
act AS (
  SELECT md5(concat_ws('|', source_system, source_record_id)) AS activity_id, *,
         concat_ws(':', source_system, source_record_id) AS evidence_reference,
         COALESCE(activity_amount < 0, FALSE) AS has_negative_activity, facility_id IS NULL AS has_missing_facility_id,
         (product_line_id IS NULL AND scope = 'Scope 3') AS has_missing_product_line_id,
         activity_month IS NULL AS has_invalid_activity_month,
         (factor_type IS NULL OR factor_type NOT IN ('electricity','diesel','natural_gas','freight_truck','corrugate','plastic_film'))
           AS has_unknown_activity_type
  FROM act0),
matched AS (
  SELECT a.*, f.grid_region, pl.product_line_id IS NOT NULL AS pl_found, f.facility_id IS NOT NULL AS fac_found,
         upper(left(pl.pt, 1)) || lower(substr(pl.pt, 2)) AS product_line_name,
         ef.factor_id, ef.factor_version, ef.factor_value_kg_co2e_per_unit, ef.source_authority
  FROM act a LEFT JOIN facilities f ON a.facility_id = f.facility_id
  LEFT JOIN product_lines pl ON a.product_line_id = pl.product_line_id
  LEFT JOIN factors ef ON a.factor_type = ef.factor_type AND a.activity_unit = ef.activity_unit
       AND (CASE WHEN a.scope = 'Scope 2' THEN f.grid_region ELSE 'US' END) = ef.region
       AND a.activity_month >= ef.effective_start AND a.activity_month <= ef.effective_end),
fact0 AS (
  SELECT *,
         CASE WHEN activity_amount IS NOT NULL AND factor_value_kg_co2e_per_unit IS NOT NULL AND activity_amount >= 0
              THEN activity_amount * factor_value_kg_co2e_per_unit END AS kg_co2e,
         CASE WHEN activity_amount IS NOT NULL AND factor_value_kg_co2e_per_unit IS NOT NULL AND activity_amount >= 0
              THEN activity_amount * factor_value_kg_co2e_per_unit / 1000.0 END AS metric_tons_co2e,
         NOT fac_found AS has_missing_facility_join,
         (NOT pl_found AND product_line_id IS NOT NULL) AS has_missing_product_line_join,
         factor_id IS NULL AS has_missing_factor_join
  FROM matched),
fact AS (
  SELECT *,
         NOT (has_negative_activity OR has_missing_facility_id OR has_invalid_activity_month OR has_unknown_activity_type
              OR has_missing_facility_join OR has_missing_factor_join) AS is_reportable_emissions_row,
         CASE WHEN has_missing_factor_join THEN '❌ Missing factor join'
              WHEN has_negative_activity THEN '⚠️ Negative activity'
              WHEN has_missing_facility_id THEN '⚠️ Missing facility ID'
              WHEN has_invalid_activity_month THEN '⚠️ Invalid activity month'
              WHEN has_unknown_activity_type THEN '⚠️ Unknown activity type'
              WHEN has_missing_facility_join THEN '⚠️ Missing facility join'
              WHEN has_missing_product_line_join THEN '⚠️ Missing product line join'
              WHEN NOT (has_negative_activity OR has_missing_facility_id OR has_invalid_activity_month
                        OR has_unknown_activity_type OR has_missing_facility_join OR has_missing_factor_join)
                THEN '✅ Reportable' ELSE '⚠️ Review' END AS qa_status_label
  FROM fact0)"""
