"""Reference data, key universes, ordered exports and the other canonical feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reference, staging, standardize
from ..sources import files
from ..sources.testdata import Tables
from . import model
from .q_extra import H9_SQL, payroll_extract
from .q_io import _scratch
from .q_quarterly import _whole
from .registry import query, rounded

AS_OF = "2000-01-01"
# Fixed license wording by order priority and market segment (exercises the group words).
LICENSES_TEXT = {"1-URGENT": " Recreational Retail ", "2-HIGH": "RECREATIONAL wholesaler", "3-MEDIUM": "Medical retail",
                 "4-NOT SPECIFIED": "Recreational", "5-LOW": "recreational producer"}
TYPE_TEXT = {"AUTOMOBILE": "Retailer", "BUILDING": " Wholesaler", "FURNITURE": "Lab", "MACHINERY": "Retailer and wholesaler"}


def license_extract(t):
    """One license row per order: number by customer (renewed with every order), words by priority and segment."""
    words = lambda m, c: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[c]
    k = F.col("o_orderkey")
    j = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority") \
        .join(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")) \
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.when(k % 97 != 0, F.concat(F.lit("L"), F.col("c_custkey").cast("string"))).alias("license_number"),
        F.concat(F.lit(" "), F.col("c_name")).alias("business_name"), words(LICENSES_TEXT, F.col("o_orderpriority")).alias("business_licenses"),
        words(TYPE_TEXT, F.col("c_mktsegment")).alias("license_type"),
        F.when(k % 13 == 0, F.lit("nan")).otherwise(F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))).alias("county"),
        F.when(k % 11 == 0, F.lit("soon")).otherwise(F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 365), "yyyy-MM-dd"))
         .alias("expiration_date"))


def _case(column: str, words: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + " END"


_LICENSE_CTE = f"""
x AS (SELECT CASE WHEN o_orderkey % 97 <> 0 THEN 'L' || CAST(c_custkey AS VARCHAR) END AS license_number, c_name AS business_name,
             trim({_case("o_orderpriority", LICENSES_TEXT)}) AS business_licenses, trim({_case("c_mktsegment", TYPE_TEXT)}) AS license_type,
             CASE WHEN o_orderkey % 13 <> 0 THEN upper(left(n_name, 1)) || lower(substr(n_name, 2)) END AS county,
             CASE WHEN o_orderkey % 11 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS DATE) END AS expiration_date
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
y AS (SELECT *, lower(COALESCE(business_licenses, '') || ' | ' || COALESCE(license_type, '')) AS txt FROM x),
z AS (SELECT license_number, business_name, CASE WHEN txt LIKE '%retail%' AND txt LIKE '%wholesal%' THEN 'Recreational Retailer/Wholesaler'
             WHEN txt LIKE '%wholesal%' THEN 'Recreational Wholesaler' ELSE 'Recreational Retailer' END AS license_group,
             business_licenses, license_type, county, expiration_date FROM y
      WHERE txt LIKE '%recreat%' AND (txt LIKE '%retail%' OR txt LIKE '%wholesal%')),
lic AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY license_number ORDER BY expiration_date DESC NULLS FIRST,
        business_name DESC NULLS LAST, license_group DESC NULLS LAST, business_licenses DESC NULLS LAST, license_type DESC NULLS LAST,
        county DESC NULLS LAST) = 1)"""


@query("m20_license_reference", f"WITH {_LICENSE_CTE} SELECT * FROM lic")
def q_m20_licenses(spark, d):
    return reference.license_reference(license_extract(Tables(spark, d)))


M20_SUMMARY_SQL = f"""
WITH {_LICENSE_CTE},
s AS (SELECT *, CASE WHEN expiration_date IS NULL THEN 'Unknown' WHEN expiration_date >= DATE '{AS_OF}' THEN 'Active/Unexpired'
                     ELSE 'Expired' END AS license_status FROM lic)
SELECT license_group, NULL::VARCHAR AS county, NULL::VARCHAR AS license_status, 'license_group' AS summary_level, COUNT(*) AS location_count FROM s GROUP BY 1
UNION ALL SELECT license_group, county, NULL, 'county_license_group', COUNT(*) FROM s GROUP BY 1, 2
UNION ALL SELECT license_group, NULL, license_status, 'license_group_status', COUNT(*) FROM s GROUP BY 1, license_status
"""


@query("m20_license_summary", M20_SUMMARY_SQL)
def q_m20_summary(spark, d):
    return reference.license_summary(reference.license_reference(license_extract(Tables(spark, d))), AS_OF)


def store_sources(t):
    """The five sources' store ids: orders as sales, orders with a retail segment as POS, suppliers as inventory sites and
    shippers, punch stores as payroll sites."""
    text = lambda c: F.col(c).cast("string").alias("store_id")
    return {
        "sales": t.orders.select(text("o_custkey")),
        "pos": t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(text("c_custkey")),
        "inventory": t.lineitem.select(text("l_suppkey")),
        "shipments": t.lineitem.filter(F.col("l_returnflag") == "R").select(text("l_suppkey")),
        "payroll": model.punches(t).select(F.col("store_code").alias("store_id")),
    }


_SOURCES = ("sales", "pos", "inventory", "shipments", "payroll")
M19_STORES_SQL = f"""
WITH u AS (
  SELECT CAST(o_custkey AS VARCHAR) AS store_id, 0 AS i FROM orders
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 1 FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
  UNION ALL SELECT CAST(l_suppkey AS VARCHAR), 2 FROM lineitem
  UNION ALL SELECT CAST(l_suppkey AS VARCHAR), 3 FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT 'S' || lpad(CAST(user_id % 8 AS VARCHAR), 2, '0'), 4 FROM events)
SELECT store_id, left(store_id, 2) AS state_code, 'Account ' || store_id AS store_name, CAST(SUM(1 << i) AS BIGINT) AS source_bits,
       string_agg(['{"', '".join(_SOURCES)}'][i + 1], ',' ORDER BY i) AS known_in, CAST(COUNT(*) AS INTEGER) AS source_count
FROM (SELECT DISTINCT store_id, i FROM u WHERE store_id IS NOT NULL) GROUP BY 1
"""


@query("m19_store_dimension", M19_STORES_SQL)
def q_m19_stores(spark, d):
    return reference.store_dimension_of(store_sources(Tables(spark, d)))


M19_LABOR_SQL = f"""
WITH h9 AS ({H9_SQL})
SELECT week_ending, site_code, department, round(SUM(hours_worked), 4) AS hours_worked, round(SUM(ot_hours), 4) AS ot_hours,
       CAST(SUM(employee_count) AS BIGINT) AS employee_count, round(SUM(labor_cost), 4) AS labor_cost
FROM h9 WHERE week_ending IS NOT NULL AND site_code IS NOT NULL GROUP BY 1, 2, 3
"""


@query("m19_labor_weekly", M19_LABOR_SQL)
def q_m19_labor(spark, d):
    return rounded(reference.labor_weekly(staging.stage_labor_payroll(payroll_extract(Tables(spark, d)))))


# Stated presentation order of priorities; the others come last.
PRIORITY_ORDER = ("3-MEDIUM", "1-URGENT", "5-LOW")
T1_SQL = f"""
SELECT o_orderkey, o_orderpriority, round(o_totalprice, 4) AS o_totalprice,
       row_number() OVER (ORDER BY CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 2 ELSE 3 END,
                          o_totalprice DESC NULLS LAST, o_orderkey) AS position
FROM orders
"""


@query("t1_sorted_export", T1_SQL)
def q_t1(spark, d):
    """All orders written in presentation order over part files, read back with their place."""
    path = _scratch(spark, "sorted")
    orders = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    files.export_sorted(orders, path, [files.ranked("o_orderpriority", PRIORITY_ORDER), F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")])
    return rounded(files.read_positions(spark, path))


# The other five feeds, with drifted headers, money signs, thousands separators and unreadable numbers.
C26_INVENTORY_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS snapshot_date, CAST(l_suppkey AS VARCHAR) AS site_code, CAST(l_partkey AS VARCHAR) AS sku,
       CAST(1000 + CAST(l_quantity AS INTEGER) AS DOUBLE) AS on_hand_units, CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS received_units,
       CAST(NULL AS DOUBLE) AS shipped_units, CASE WHEN l_linenumber <> 2 THEN 10.0::DOUBLE END AS requested_units, CAST(NULL AS DOUBLE) AS backordered_units,
       'erp' AS source_system FROM lineitem
"""


@query("c26_standard_inventory", C26_INVENTORY_SQL)
def q_c26_inventory(spark, d):
    ln, q = F.col("l_linenumber"), _whole(F.col("l_quantity"))
    feed = Tables(spark, d).lineitem.select(
        F.when(ln % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise(F.date_format("l_shipdate", "MM/dd/yyyy")).alias("Snapshot Date"),
        F.col("l_suppkey").alias("Site-Code"), F.col("l_partkey").alias("SKU"), F.concat(F.lit("1,0"), F.lpad(q, 2, "0")).alias("On Hand"),
        F.when(ln == 3, F.concat(q, F.lit(" ea"))).otherwise(q).alias("receipts"), F.when(ln == 2, F.lit("10%")).otherwise(F.lit(" 10 ")).alias("Requested Units"))
    return rounded(standardize.standardize(feed, "inventory", "erp"))


C26_SHIPMENTS_SQL = """
SELECT CAST(l_shipdate AS DATE) AS ship_date, CASE WHEN l_linenumber <> 1 THEN 'SH' || CAST(l_orderkey AS VARCHAR) END AS shipment_id,
       CAST(l_suppkey AS VARCHAR) AS site_code, CAST(l_partkey AS VARCHAR) AS sku,
       CASE WHEN l_linenumber <> 4 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS units_shipped, ' ' || l_returnflag AS carrier, 'wms' AS source_system
FROM lineitem
"""


@query("c26_standard_shipments", C26_SHIPMENTS_SQL)
def q_c26_shipments(spark, d):
    ln, q = F.col("l_linenumber"), _whole(F.col("l_quantity"))
    feed = Tables(spark, d).lineitem.select(
        F.concat(F.lit(" "), F.col("l_returnflag")).alias("Carrier"), F.when(ln == 4, F.lit("-")).otherwise(q).alias("UNITS_SHIPPED"),
        F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("site code"),
        F.when(ln != 1, F.concat(F.lit("SH"), F.col("l_orderkey").cast("string"))).alias("Shipment ID"), F.date_format("l_shipdate", "MM/dd/yyyy").alias("ship date"))
    return rounded(standardize.standardize(feed, "shipments", "wms"))


C26_PAYROLL_SQL = """
SELECT CAST(ts AS DATE) AS work_date, 'S' || CAST(user_id % 8 AS VARCHAR) AS site_code, upper(event_type) AS department, CAST(NULL AS VARCHAR) AS team,
       round(CAST(value AS DECIMAL(18,2)), 4) AS hours_worked, CASE WHEN user_id % 3 <> 0 THEN 1.5::DOUBLE END AS overtime_hours,
       CAST(user_id % 5 AS DOUBLE) AS employee_count, round(1000 + CAST(value AS DECIMAL(18,2)), 4) AS labor_cost_amount, 'payroll' AS source_system
FROM events
"""


@query("c26_standard_payroll", C26_PAYROLL_SQL)
def q_c26_payroll(spark, d):
    value = F.col("value").cast("decimal(18,2)")
    feed = Tables(spark, d).events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("Week Ending"), F.concat(F.lit("S"), (F.col("user_id") % 8).cast("string")).alias("Site Code"),
        F.upper("event_type").alias("DEPARTMENT"), value.cast("string").alias("Hours-Worked"),
        F.when(F.col("user_id") % 3 != 0, F.lit("1.5")).otherwise(F.lit("1.5 h")).alias("OT Hours"), (F.col("user_id") % 5).alias("employee count"),
        F.concat(F.lit("$"), F.format_number(1000 + value, 2)).alias("Labor Cost"))
    return rounded(standardize.standardize(feed, "payroll", "payroll"))


C26_TIMECLOCK_SQL = """
SELECT CASE WHEN event_id % 9 <> 0 THEN date_trunc('second', ts) END AS punch_ts, CASE WHEN event_id % 9 <> 0 THEN CAST(ts AS DATE) END AS punch_date,
       CAST(user_id AS VARCHAR) AS employee_id, 'S' || CAST(user_id % 8 AS VARCHAR) AS site_code, event_type AS action, 'timeclock' AS source_system
FROM events
"""


@query("c26_standard_timeclock", C26_TIMECLOCK_SQL)
def q_c26_timeclock(spark, d):
    feed = Tables(spark, d).events.select(
        F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(F.lit("yesterday")).alias("Punch TS"),
        F.col("user_id").alias("Employee-ID"), F.concat(F.lit("S"), (F.col("user_id") % 8).cast("string")).alias("site_code"), F.col("event_type").alias("Action"))
    return standardize.standardize(feed, "timeclock", "timeclock")


C26_FINANCE_SQL = f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, o_orderpriority AS metric_name,
       CASE WHEN o_orderkey % 6 <> 0 THEN CAST(floor(o_totalprice) AS DOUBLE) END AS actual_amount, 'usd' AS currency_code, 'finance' AS source_system FROM orders
"""


@query("c26_standard_finance", C26_FINANCE_SQL)
def q_c26_finance(spark, d):
    k, amount = F.col("o_orderkey"), F.format_number(F.floor("o_totalprice"), 0)
    feed = Tables(spark, d).orders.select(
        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "MM/dd/yyyy").alias("Month Start"), F.col("o_orderpriority").alias("Metric Name"),
        F.when(k % 6 == 0, F.concat(amount, F.lit(" USD"))).otherwise(F.concat(F.lit("$"), amount)).alias("Actual Amount"), F.lit("usd").alias("CURRENCY"))
    return rounded(standardize.standardize(feed, "finance_actuals", "finance"))
