"""Quarterly text extracts beyond retail sales (H11) and canonical feeds.

The extracts: finance actuals, inventory, trade adjustments, wholesale sales.

Each is rendered as text from the test tables (blank keys by key parity, so that trimming has work to do) and typed
by ``staging.stage_text_casts``; the SQL spells the same rendering and the same casts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import staging, standardize
from ..sources.testdata import Tables
from .registry import query, rounded


def _quarter(d):
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def _quarter_sql(d):
    return f"CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR)"


def _week_end(d):
    return F.date_format(F.date_add(F.date_trunc("week", d).cast("date"), 6), "yyyy-MM-dd")


def _week_end_sql(d):
    return f"strftime(CAST(date_trunc('week', {d}) + INTERVAL 6 DAY AS DATE), '%Y-%m-%d')"


def _whole(c):
    return c.cast("int").cast("string")


def _whole_sql(c):
    return f"CAST(CAST({c} AS INTEGER) AS VARCHAR)"


def _typed_sql(texts=(), dates=(), whole=(), amounts=()):
    t = [f"NULLIF(trim({c}), '') AS {c}" for c in texts]
    t += [f"TRY_CAST(NULLIF(trim({c}), '') AS DATE) AS {c}" for c in dates]
    t += [f"TRY_CAST(NULLIF(trim({c}), '') AS INTEGER) AS {c}" for c in whole]
    return ", ".join(t + [f"round(TRY_CAST(NULLIF(trim({c}), '') AS DOUBLE), 4) AS {c}" for c in amounts])


FINANCE_SQL = f"""
WITH x AS (
  SELECT CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE {_quarter_sql('o_orderdate')} END AS quarter_id,
         ' ' || left(o_orderpriority, 1) || '000 ' AS account_code, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS department_code,
         {_whole_sql('floor(o_totalprice)')} || '.50' AS actual_amount, o_orderpriority || ' ' AS reporting_category FROM orders)
SELECT {_typed_sql(('quarter_id', 'account_code', 'department_code', 'reporting_category'), amounts=('actual_amount',))} FROM x
"""


@query("h11_stage_finance_quarterly", FINANCE_SQL)
def q_finance(spark, d):
    k = F.col("o_orderkey")
    x = Tables(spark, d).orders.select(
        F.when(k % 17 == 0, F.lit(" ")).otherwise(_quarter(F.col("o_orderdate"))).alias("quarter_id"),
        F.concat(F.lit(" "), F.substring("o_orderpriority", 1, 1), F.lit("000 ")).alias("account_code"),
        F.when(k % 5 != 0, F.col("o_orderstatus")).alias("department_code"),
        F.concat(_whole(F.floor("o_totalprice")), F.lit(".50")).alias("actual_amount"),
        F.concat("o_orderpriority", F.lit(" ")).alias("reporting_category"))
    return rounded(staging.stage_text_casts(x, {"actual_amount": "double"}))


INVENTORY_Q_SQL = f"""
WITH x AS (
  SELECT {_quarter_sql('l_shipdate')} || ' ' AS quarter_id, CASE WHEN l_orderkey % 19 = 0 THEN '' ELSE {_week_end_sql('l_shipdate')} END AS week_end_date,
         'W' || CAST(l_suppkey AS VARCHAR) AS warehouse_id, CASE WHEN l_linenumber = 7 THEN ' ' ELSE CAST(l_partkey AS VARCHAR) END AS sku_id,
         {_whole_sql('l_quantity')} AS on_hand_units, CASE WHEN l_orderkey % 23 = 0 THEN 'n/a' ELSE {_whole_sql('l_quantity - 5')} END AS available_units,
         {_whole_sql('l_quantity')} || '.25' AS inventory_value FROM lineitem)
SELECT {_typed_sql(('quarter_id', 'warehouse_id', 'sku_id'), ('week_end_date',), ('on_hand_units', 'available_units'), ('inventory_value',))} FROM x
"""


@query("h11_stage_inventory_quarterly", INVENTORY_Q_SQL)
def q_inventory(spark, d):
    k, ship = F.col("l_orderkey"), F.col("l_shipdate")
    x = Tables(spark, d).lineitem.select(
        F.concat(_quarter(ship), F.lit(" ")).alias("quarter_id"), F.when(k % 19 == 0, F.lit("")).otherwise(_week_end(ship)).alias("week_end_date"),
        F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("warehouse_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.col("l_partkey").cast("string")).alias("sku_id"),
        _whole(F.col("l_quantity")).alias("on_hand_units"),
        F.when(k % 23 == 0, F.lit("n/a")).otherwise(_whole(F.col("l_quantity") - 5)).alias("available_units"),
        F.concat(_whole(F.col("l_quantity")), F.lit(".25")).alias("inventory_value"))
    return rounded(staging.stage_text_casts(x, {"week_end_date": "date", "on_hand_units": "int", "available_units": "int",
                                                "inventory_value": "double"}))


TRADE_SQL = f"""
WITH x AS (
  SELECT {_quarter_sql('o_orderdate')} AS quarter_id, 'ADJ-' || CAST(o_orderkey AS VARCHAR) AS adjustment_id,
         CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS account_id, ' ' || o_orderstatus AS adjustment_type,
         '-' || CAST(o_orderkey % 900 AS VARCHAR) || '.75' AS adjustment_amount,
         CASE WHEN o_orderkey % 13 = 0 THEN 'soon' ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS adjustment_date,
         o_orderpriority AS reason_code FROM orders)
SELECT {_typed_sql(('quarter_id', 'adjustment_id', 'account_id', 'adjustment_type', 'reason_code'), ('adjustment_date',), amounts=('adjustment_amount',))} FROM x
"""


@query("h11_stage_trade_adjustments", TRADE_SQL)
def q_trade(spark, d):
    k, date = F.col("o_orderkey"), F.col("o_orderdate")
    x = Tables(spark, d).orders.select(
        _quarter(date).alias("quarter_id"), F.concat(F.lit("ADJ-"), k.cast("string")).alias("adjustment_id"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("account_id"),
        F.concat(F.lit(" "), "o_orderstatus").alias("adjustment_type"),
        F.concat(F.lit("-"), (k % 900).cast("string"), F.lit(".75")).alias("adjustment_amount"),
        F.when(k % 13 == 0, F.lit("soon")).otherwise(F.date_format(date, "yyyy-MM-dd")).alias("adjustment_date"),
        F.col("o_orderpriority").alias("reason_code"))
    return rounded(staging.stage_text_casts(x, {"adjustment_amount": "double", "adjustment_date": "date"}))


WHOLESALE_SQL = f"""
WITH x AS (
  SELECT CASE WHEN l_orderkey % 17 = 0 THEN ' ' ELSE {_quarter_sql('o_orderdate')} END AS quarter_id, {_week_end_sql('o_orderdate')} AS week_end_date,
         CAST(o_custkey AS VARCHAR) AS wholesale_account_id, CAST(l_partkey AS VARCHAR) || ' ' AS sku_id,
         CASE WHEN l_orderkey % 29 = 0 THEN '' ELSE {_whole_sql('l_quantity')} END AS cases_sold, {_whole_sql('l_quantity * 10')} AS gross_sales,
         {_whole_sql('l_quantity * 9')} || '.10' AS net_sales FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT {_typed_sql(('quarter_id', 'wholesale_account_id', 'sku_id'), ('week_end_date',), ('cases_sold',), ('gross_sales', 'net_sales'))} FROM x
"""


@query("h11_stage_wholesale_quarterly", WHOLESALE_SQL)
def q_wholesale(spark, d):
    t = Tables(spark, d)
    k, date, qty = F.col("l_orderkey"), F.col("o_orderdate"), F.col("l_quantity")
    x = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity") \
        .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), k == F.col("o_orderkey")).select(
        F.when(k % 17 == 0, F.lit(" ")).otherwise(_quarter(date)).alias("quarter_id"), _week_end(date).alias("week_end_date"),
        F.col("o_custkey").cast("string").alias("wholesale_account_id"), F.concat(F.col("l_partkey").cast("string"), F.lit(" ")).alias("sku_id"),
        F.when(k % 29 == 0, F.lit("")).otherwise(_whole(qty)).alias("cases_sold"), _whole(qty * 10).alias("gross_sales"),
        F.concat(_whole(qty * 9), F.lit(".10")).alias("net_sales"))
    return rounded(staging.stage_text_casts(x, {"week_end_date": "date", "cases_sold": "int", "gross_sales": "double", "net_sales": "double"}))


# Feeds with drifted headers. Sales come as POS-like text without net amounts, the ledger with debit and credit.
C26_SALES_SQL = """
WITH x AS (
  SELECT CASE WHEN l_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') ELSE strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') END AS d,
         CAST(o_custkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS sku,
         CASE l_linenumber WHEN 7 THEN 'n/a' WHEN 5 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' ea' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS q,
         '$1,0' || lpad(CAST(l_partkey % 50 AS VARCHAR), 2, '0') || '.50' AS p, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE '0.25' END AS r,
         CAST(l_orderkey AS VARCHAR) AS transaction_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
t AS (
  SELECT CAST(CASE WHEN regexp_matches(d, '^\\d{4}') THEN try_strptime(d, '%Y-%m-%d') ELSE try_strptime(d, '%m/%d/%Y') END AS DATE) AS sale_date,
         store_id, sku, TRY_CAST(NULLIF(trim(regexp_replace(q, '[$,]', '', 'g')), '') AS DECIMAL(18,4)) AS qty, CAST(regexp_replace(p, '[$,]', '', 'g') AS DECIMAL(18,4)) AS unit_list_price,
         CAST(r AS DECIMAL(9,4)) AS discount_rate, transaction_id FROM x),
u AS (SELECT *, unit_list_price * (1 - COALESCE(discount_rate, 0)) AS unit_net_price FROM t),
v AS (SELECT *, qty * unit_net_price AS net_sales_amount, qty * unit_list_price AS gross_sales_amount FROM u)
SELECT sale_date, store_id, sku, CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS VARCHAR) AS channel, round(qty, 4) AS qty,
       round(unit_list_price, 4) AS unit_list_price, round(discount_rate, 4) AS discount_rate, round(unit_net_price, 4) AS unit_net_price,
       round(gross_sales_amount, 4) AS gross_sales_amount, round(gross_sales_amount - net_sales_amount, 4) AS discount_amount,
       round(net_sales_amount, 4) AS net_sales_amount, CAST(NULL AS DOUBLE) AS cogs_amount, CAST(NULL AS VARCHAR) AS order_count,
       CAST(NULL AS VARCHAR) AS customer_count, transaction_id, CAST(NULL AS VARCHAR) AS transaction_ts, 'pos' AS source_system FROM v
"""


@query("c26_standard_sales", C26_SALES_SQL)
def q_c26_sales(spark, d):
    t = Tables(spark, d)
    k, date = F.col("l_orderkey"), F.col("o_orderdate")
    feed = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity") \
        .join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), k == F.col("o_orderkey")).select(
        F.when(k % 2 == 0, F.date_format(date, "yyyy-MM-dd")).otherwise(F.date_format(date, "MM/dd/yyyy")).alias("Txn Date"),
        F.col("o_custkey").alias("Store Code"), F.col("l_partkey").alias("Product-SKU"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).when(F.col("l_linenumber") == 5, F.concat(_whole(F.col("l_quantity")), F.lit(" ea")))
         .otherwise(_whole(F.col("l_quantity"))).alias("UNITS SOLD"),
        F.concat(F.lit("$1,0"), F.lpad((F.col("l_partkey") % 50).cast("string"), 2, "0"), F.lit(".50")).alias("unit price"),
        F.when(k % 5 != 0, F.lit("0.25")).alias("discount_pct"), k.alias("TXN_ID"))
    return rounded(standardize.standardize(feed, "sales", "pos"))


C26_GL_SQL = """
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS period, CAST(o_orderdate AS DATE) AS posting_date, 'L' || CAST(o_custkey % 8 AS VARCHAR) AS location_code,
       left(o_orderpriority, 1) AS account_code, CAST(NULL AS VARCHAR) AS account_name,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(floor(o_totalprice) AS DOUBLE) END AS debit_amount,
       CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS DOUBLE) END AS credit_amount,
       round(COALESCE(CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice) END, 0) - COALESCE(CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) END, 0), 4) AS net_amount,
       'gl' AS source_system FROM orders
"""


@query("c26_standard_gl", C26_GL_SQL)
def q_c26_gl(spark, d):
    date, paid = F.col("o_orderdate"), F.col("o_orderstatus") == "F"
    amount = F.concat(F.lit("$"), _whole(F.floor("o_totalprice")))
    feed = Tables(spark, d).orders.select(
        F.date_format(date, "yyyy-MM").alias("Period"), F.date_format(date, "MM/dd/yyyy").alias("Posting Date"),
        F.concat(F.lit("L"), (F.col("o_custkey") % 8).cast("string")).alias("LocationCode"),
        F.substring("o_orderpriority", 1, 1).alias("account code"), F.when(~paid, amount).alias("Debit Amount"), F.when(paid, amount).alias("Credit-Amount"))
    return rounded(standardize.standardize(feed, "gl", "gl"))
