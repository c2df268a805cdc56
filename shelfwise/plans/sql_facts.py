"""DuckDB SQL for the fact / dimension / calendar queries (mirrors q_facts)."""

from __future__ import annotations

from .oracle import INVENTORY, SALES_LINES
from .q_clean import H4_CORE
from .q_history import PAIRS_CTE

_H4_PAYLOAD = ["load_id", "drop_date", "ingested_at", "qty", "unit_list_price", "gross_sales", "discount_amount",
               "net_sales", "cogs", "product_name", "discount_rate", "unit_net_price", "orders", "customers", "is_bad_amount", "is_missing_key", "is_duplicate_candidate"]

DIST_CTE = f"""
h4 AS ({H4_CORE}),
best AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY sale_date, store_code, sku, channel
            ORDER BY is_missing_key, is_bad_amount, ingested_at DESC NULLS LAST, drop_date DESC NULLS LAST,
                     load_id DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in _H4_PAYLOAD)}) AS rn
  FROM h4 WHERE sale_date IS NOT NULL AND store_code IS NOT NULL AND sku IS NOT NULL AND channel IS NOT NULL) WHERE rn = 1),
dist AS (SELECT sale_date, store_code, sku, channel, CAST(SUM(qty) AS BIGINT) AS units, SUM(gross_sales) AS gross_sales,
                SUM(discount_amount) AS discount_amount, SUM(net_sales) AS net_sales, SUM(cogs) AS cogs,
                COUNT(*) AS source_rows, MAX(load_id) AS any_load_id, MAX(product_name) AS product_name,
                CAST(SUM(COALESCE(orders, 0)) AS BIGINT) AS orders, CAST(SUM(COALESCE(customers, 0)) AS BIGINT) AS customers,
                SUM(COALESCE(unit_net_price, 0) * COALESCE(qty, 0)) / NULLIF(SUM(qty), 0) AS weighted_net_price,
                SUM(unit_list_price * qty) / NULLIF(SUM(CASE WHEN unit_list_price IS NOT NULL THEN qty END), 0)
                  AS weighted_list_price,
                SUM(net_sales) / NULLIF(SUM(qty), 0) AS implied_net_price,
                SUM(discount_amount) / NULLIF(SUM(gross_sales), 0) AS implied_discount_rate
         FROM best GROUP BY 1, 2, 3, 4)"""

M7_SQL = f"""
WITH {DIST_CTE}
SELECT sale_date, store_code, sku, channel, units, round(gross_sales, 4) AS gross_sales,
       round(discount_amount, 4) AS discount_amount, round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs,
       source_rows, any_load_id, product_name, orders, customers, round(weighted_net_price, 4) AS weighted_net_price,
       round(weighted_list_price, 4) AS weighted_list_price,
       round(implied_net_price, 4) AS implied_net_price, round(implied_discount_rate, 4) AS implied_discount_rate
FROM dist
"""

POS_CTE = """
pos0 AS (SELECT l_orderkey AS k, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txn_id,
                CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS VARCHAR) AS store_code, CAST(l_partkey AS VARCHAR) AS sku,
                l_quantity AS qty, CAST(l_extendedprice AS DECIMAL(18,4)) AS gross_amount, CAST(CAST(l_extendedprice AS DECIMAL(9,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net_amount
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pos AS (SELECT txn_id, CASE WHEN k % 14 <> 0 THEN d END AS txn_date, store_code, sku, qty, gross_amount, net_amount,
               d AS drop_date, 'P1' AS load_id FROM pos0
        UNION ALL
        SELECT txn_id, d, store_code, sku, qty, gross_amount, CAST(net_amount * 0.9 AS DECIMAL(18,4)), CAST(d + INTERVAL 1 DAY AS DATE), 'P2'
        FROM pos0 WHERE k % 7 = 0),
posb AS (SELECT * FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY txn_id ORDER BY (txn_date IS NOT NULL) DESC, (store_code IS NOT NULL) DESC,
            (sku IS NOT NULL) DESC, drop_date DESC NULLS LAST, load_id DESC NULLS LAST, txn_date DESC NULLS LAST,
            store_code DESC NULLS LAST, sku DESC NULLS LAST, qty DESC NULLS LAST, gross_amount DESC NULLS LAST,
            net_amount DESC NULLS LAST) AS rn FROM pos WHERE txn_id IS NOT NULL) WHERE rn = 1),
posd AS (SELECT txn_date AS sale_date, store_code, sku, COUNT(*) AS pos_lines, COUNT(DISTINCT txn_id) AS pos_transactions,
                SUM(qty) AS units, SUM(gross_amount) AS gross_sales, SUM(net_amount) AS net_sales
         FROM posb GROUP BY 1, 2, 3)"""

M22_SQL = f"""
WITH {POS_CTE}
SELECT sale_date, store_code, sku, pos_lines, pos_transactions, round(units, 4) AS units,
       round(gross_sales, 4) AS gross_sales, round(net_sales, 4) AS net_sales
FROM posd
"""

CONF_CTE = f"""{DIST_CTE}, {POS_CTE},
u AS (SELECT sale_date, store_code, sku, channel, CAST(units AS DOUBLE) AS units, gross_sales, discount_amount, net_sales, cogs, orders,
             'distributor' AS source_system FROM dist
      UNION ALL
      SELECT sale_date, store_code, sku, 'retail', units, gross_sales, gross_sales - net_sales, net_sales, NULL, pos_transactions, 'pos' FROM posd),
conf AS (
  SELECT u.*, p.p_name AS product_name, st.n_name AS state,
         COALESCE(p.p_name, 'Unknown ' || u.sku) AS product_label,
         u.sale_date IS NULL AS is_missing_date, st.c_custkey IS NULL AS is_missing_store,
         p.p_partkey IS NULL AS is_missing_sku, u.channel IS NULL AS is_missing_channel
  FROM u LEFT JOIN part p ON u.sku = CAST(p.p_partkey AS VARCHAR)
  LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) st
         ON u.store_code = CAST(st.c_custkey AS VARCHAR))"""

M1_SQL = f"""
WITH {CONF_CTE}
SELECT store_code, sku, sale_date, channel, round(units, 4) AS units, round(gross_sales, 4) AS gross_sales,
       round(discount_amount, 4) AS discount_amount, round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs, orders,
       source_system, product_name, state, product_label, is_missing_date,
       is_missing_store, is_missing_sku, is_missing_channel
FROM conf
"""

M10_SQL = f"""
WITH {CONF_CTE}
SELECT sale_date, store_code, round(SUM(COALESCE(net_sales, 0)), 4) AS net_sales, round(SUM(COALESCE(units, 0)), 4) AS units,
       round(SUM(COALESCE(gross_sales, 0)), 4) AS gross_sales, round(SUM(COALESCE(discount_amount, 0)), 4) AS discount_amount,
       CAST(SUM(COALESCE(orders, 0)) AS BIGINT) AS orders, round(SUM(COALESCE(cogs, 0)), 4) AS cogs, COUNT(cogs) AS rows_with_cogs,
       COUNT(DISTINCT channel) AS distinct_channels, round(SUM(COALESCE(net_sales, 0)) - SUM(COALESCE(cogs, 0)), 4) AS gross_profit,
       round((SUM(COALESCE(net_sales, 0)) - SUM(COALESCE(cogs, 0))) / NULLIF(SUM(COALESCE(net_sales, 0)), 0), 4) AS gross_margin_pct,
       round(SUM(CASE WHEN source_system = 'distributor' THEN net_sales END), 4) AS distributor_net_sales,
       round(SUM(CASE WHEN source_system = 'pos' THEN net_sales END), 4) AS pos_net_sales,
       COUNT(DISTINCT sku) AS distinct_skus, COUNT(*) AS fact_rows
FROM conf GROUP BY 1, 2
"""

M3_SQL = f"""
WITH {SALES_LINES}, {INVENTORY},
keys AS (SELECT CAST(p_partkey AS VARCHAR) AS sku FROM part UNION SELECT CAST(l_partkey AS VARCHAR) FROM lineitem
         UNION SELECT CAST(sku AS VARCHAR) FROM inventory),
prof AS (SELECT CAST(sku AS VARCHAR) AS sku, min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date,
                SUM(units) AS lifetime_units FROM sales_lines GROUP BY 1),
st AS (SELECT CAST(sku AS VARCHAR) AS sku, snapshot_date AS as_of_date,
              CASE WHEN on_hand_units > 0 THEN 'active' ELSE 'out_of_stock' END AS status FROM inventory),
cur AS (SELECT sku, status AS current_status, status_versions FROM (
          SELECT *, COUNT(*) OVER (PARTITION BY sku) AS status_versions,
                 ROW_NUMBER() OVER (PARTITION BY sku ORDER BY as_of_date DESC NULLS LAST, as_of_date DESC NULLS LAST,
                                    status DESC NULLS LAST) AS rn FROM st) WHERE rn = 1)
SELECT k.sku, first_sale_date, last_sale_date, round(lifetime_units, 4) AS lifetime_units, current_status,
       status_versions, first_sale_date IS NOT NULL AS has_sales
FROM keys k LEFT JOIN prof USING (sku) LEFT JOIN cur USING (sku)
"""

M4_SQL = f"""
WITH {PAIRS_CTE},
daily AS (SELECT work_date, store_code, employee_id, SUM(minutes_worked) / 60.0 AS hours_worked
          FROM pm GROUP BY 1, 2, 3),
prof AS (SELECT employee_id, min(work_date) AS first_work_date, max(work_date) AS last_work_date,
                COUNT(DISTINCT work_date) AS days_worked, SUM(hours_worked) AS total_hours FROM daily GROUP BY 1),
pc AS (SELECT employee_id, COUNT(*) AS punch_count FROM punches GROUP BY 1),
ls AS (SELECT employee_id, store_code AS last_store_code FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY work_date DESC NULLS LAST,
                                      store_code DESC NULLS LAST) AS rn FROM daily) WHERE rn = 1),
keys AS (SELECT employee_id FROM daily UNION SELECT employee_id FROM punches)
SELECT k.employee_id, first_work_date, last_work_date, days_worked, round(total_hours, 4) AS total_hours,
       punch_count, last_store_code, round(total_hours / NULLIF(CAST(days_worked AS DOUBLE), 0), 4) AS avg_hours_per_day
FROM keys k LEFT JOIN prof USING (employee_id) LEFT JOIN pc USING (employee_id) LEFT JOIN ls USING (employee_id)
"""

M6_SQL = """
WITH spine AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY))
              AS DATE) AS full_date FROM orders),
b AS (SELECT full_date, CAST(month(full_date) AS INTEGER) AS m, CAST(year(full_date) AS INTEGER) AS y FROM spine),
f AS (SELECT *, CASE WHEN m >= 4 THEN y + 1 ELSE y END AS fy, ((m - 4 + 12) % 12) + 1 AS fm FROM b)
SELECT full_date,
       CAST(y * 10000 + m * 100 + day(full_date) AS INTEGER) AS date_key, y AS year_num,
       CAST(quarter(full_date) AS INTEGER) AS quarter_num, m AS month_num, monthname(full_date) AS month_name,
       strftime(full_date, '%b') AS month_abbr, dayname(full_date) AS day_name,
       CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS iso_day_of_week_num,
       isodow(full_date) IN (6, 7) AS is_weekend,
       CAST(date_trunc('week', full_date) AS DATE) AS week_start_date,
       CAST(date_trunc('week', full_date) + INTERVAL 6 DAY AS DATE) AS week_end_date,
       CAST(date_trunc('month', full_date) AS DATE) AS month_start_date, last_day(full_date) AS month_end_date,
       CAST(date_trunc('quarter', full_date) AS DATE) AS quarter_start_date,
       CAST(date_trunc('year', full_date) AS DATE) AS year_start_date,
       CAST(weekofyear(full_date) AS INTEGER) AS iso_week_num, CAST(isoyear(full_date) AS INTEGER) AS iso_year_num,
       CAST(isoyear(full_date) AS VARCHAR) || '-W' || lpad(CAST(weekofyear(full_date) AS VARCHAR), 2, '0') AS iso_year_week,
       strftime(full_date, '%Y-%m') AS year_month,
       CAST(y AS VARCHAR) || 'Q' || CAST(quarter(full_date) AS VARCHAR) AS year_quarter,
       full_date = CAST(date_trunc('month', full_date) AS DATE) AS is_month_start,
       full_date = last_day(full_date) AS is_month_end,
       4 AS fiscal_start_month, fy AS fiscal_year, fm AS fiscal_month,
       CAST(ceil(fm / 3.0) AS INTEGER) AS fiscal_quarter, 'FY' || CAST(fy AS VARCHAR) AS fiscal_year_label,
       'FY' || CAST(fy AS VARCHAR) || '-P' || lpad(CAST(fm AS VARCHAR), 2, '0') AS fiscal_period_label,
       full_date = DATE '2001-06-30' AS is_today,
       date_trunc('month', full_date) = date_trunc('month', DATE '2001-06-30') AND full_date <= DATE '2001-06-30' AS is_mtd,
       year(full_date) = 2001 AND full_date <= DATE '2001-06-30' AS is_ytd
FROM f
"""

M13_SQL = f"""
WITH {INVENTORY}
SELECT snapshot_date, site_id, sku, round(on_hand_units, 4) AS on_hand_units, round(received_units, 4) AS received_units,
       dup_group_size
FROM (SELECT *, COUNT(*) OVER (PARTITION BY snapshot_date, site_id, sku) AS dup_group_size,
             ROW_NUMBER() OVER (PARTITION BY snapshot_date, site_id, sku ORDER BY COALESCE(on_hand_units < 0, FALSE),
                                on_hand_units DESC NULLS LAST, received_units DESC NULLS LAST) AS rn
      FROM inventory WHERE snapshot_date IS NOT NULL AND site_id IS NOT NULL AND sku IS NOT NULL) WHERE rn = 1
"""

FIN_CTE = """
fx AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
              ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END AS month_start_raw,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Gross Sales' WHEN '2-HIGH' THEN 'net sales total'
              WHEN '3-MEDIUM' THEN 'COGS - product' WHEN '4-NOT SPECIFIED' THEN 'Labor Cost'
              WHEN '5-LOW' THEN 'Other income' END AS metric_name_norm,
         CASE WHEN o_orderkey % 3 = 0 THEN '$' ELSE '' END
           || CAST(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) AS VARCHAR) AS actual_amount_raw
  FROM orders),
s AS (
  SELECT CAST(date_trunc('month',
           CASE WHEN regexp_matches(trim(month_start_raw), '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(try_strptime(trim(month_start_raw), '%Y-%m-%d') AS DATE)
                WHEN regexp_matches(trim(month_start_raw), '^\\d{2}/\\d{2}/\\d{4}$') THEN CAST(try_strptime(trim(month_start_raw), '%m/%d/%Y') AS DATE) END)
           AS DATE) AS period_month,
         lower(NULLIF(trim(metric_name_norm), '')) AS metric_name,
         TRY_CAST(NULLIF(regexp_replace(trim(actual_amount_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4)) AS actual_amount
  FROM fx),
k AS (SELECT *, CASE WHEN metric_name IS NULL THEN 'unknown'
                     WHEN lower(trim(metric_name)) LIKE '%gross%sales%' THEN 'gross_sales'
                     WHEN lower(trim(metric_name)) LIKE '%net%sales%' THEN 'net_sales'
                     WHEN lower(trim(metric_name)) LIKE '%cogs%' THEN 'cogs'
                     WHEN lower(trim(metric_name)) LIKE '%cost%of%goods%' THEN 'cogs'
                     WHEN lower(trim(metric_name)) LIKE '%gross%margin%' THEN 'gross_margin'
                     WHEN lower(trim(metric_name)) LIKE '%labor%cost%' THEN 'labor_cost'
                     ELSE 'unknown' END AS kpi_category FROM s)"""

M18_SQL = f"""
WITH {FIN_CTE}
SELECT period_month, kpi_category, round(SUM(actual_amount), 4) AS actual_amount, COUNT(*) AS source_rows,
       count(*) FILTER (WHERE kpi_category = 'unknown') AS unmapped_rows
FROM k GROUP BY 1, 2
"""

M20_SQL = """
WITH s AS (SELECT r_name AS region, n_name AS state, lower(c_mktsegment) AS channel, CAST(c_acctbal AS DECIMAL(18,4)) AS acct_balance
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT region, state, channel,
       CASE grouping(region, state, channel) WHEN 0 THEN 'region+state+channel' WHEN 1 THEN 'region+state'
            WHEN 3 THEN 'region' WHEN 7 THEN 'total' END AS summary_level,
       COUNT(*) AS accounts, round(SUM(acct_balance), 4) AS total_balance,
       count(*) FILTER (WHERE acct_balance < 0) AS negative_balance_accounts
FROM s GROUP BY GROUPING SETS ((region, state, channel), (region, state), (region), ())
"""
