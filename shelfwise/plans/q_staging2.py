"""More staging queries: fuel usage text (E5), inventory ERP (H6), header drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import emissions as E
from ..operators import staging
from ..sources.testdata import Tables
from . import ghg
from .registry import query, rounded

# Fixed text renderings for the fuel extract (exercise parsers and synonyms).
FUEL_TEXT = {"O": "Diesel", "F": "Natural Gas"}
UNIT_TEXT = {0: "gal", 1: "Gallons", 2: "therms", 3: "THERM"}


def fuel_text_extract(t):
    """Fuel usage as text: month in three formats, amounts with junk, unit spellings, by key parity."""
    li = t.lineitem.filter(F.col("l_returnflag") == "N")
    k = F.col("l_orderkey")
    d = F.trunc(F.col("l_shipdate").cast("date"), "month")
    month = (F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(d, "MMM-yyyy"))
             .otherwise(F.date_format(d, "M/d/yyyy")))
    amount = (F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.concat(F.lit("1,"), F.col("l_quantity").cast("int").cast("string")))
              .otherwise(F.col("l_quantity").cast("int").cast("string")))
    fuel = F.when(F.col("l_linestatus") == "O", F.lit(" Diesel")).when(k % 2 == 0, F.lit("Natural Gas")).otherwise(F.lit("NATURAL_GAS"))
    unit = (F.when(F.col("l_linestatus") == "O", F.when(k % 2 == 0, F.lit("gal")).otherwise(F.lit("Gallons")))
            .otherwise(F.when(k % 2 == 0, F.lit("therms")).otherwise(F.lit("THERM"))))
    unit = F.when(k % 23 == 0, F.lit("liters")).otherwise(unit)
    return li.select(F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
                     .alias("source_record_id"), month.alias("activity_month"),
                     F.concat(F.lit(" f"), F.col("l_suppkey").cast("string")).alias("facility_id"),
                     fuel.alias("fuel_type"), amount.alias("activity_amount"), unit.alias("activity_unit"))


E5_SQL = """
WITH fx AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_record_id,
         CASE WHEN l_orderkey % 3 = 0 THEN strftime(CAST(date_trunc('month', l_shipdate) AS DATE), '%Y-%m-%d')
              WHEN l_orderkey % 3 = 1 THEN strftime(CAST(date_trunc('month', l_shipdate) AS DATE), '%b-%Y')
              ELSE CAST(month(l_shipdate) AS VARCHAR) || '/1/' || CAST(year(l_shipdate) AS VARCHAR) END AS month_raw,
         upper(trim(' f' || CAST(l_suppkey AS VARCHAR))) AS facility_id,
         CASE WHEN l_linestatus = 'O' THEN 'diesel' ELSE 'natural_gas' END AS fuel_type,
         CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' WHEN l_orderkey % 17 = 0 THEN '1,' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS amount_raw,
         CASE WHEN l_orderkey % 23 = 0 THEN 'liters'
              WHEN l_linestatus = 'O' THEN CASE WHEN l_orderkey % 2 = 0 THEN 'gal' ELSE 'Gallons' END
              ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'therms' ELSE 'THERM' END END AS unit_raw
  FROM lineitem WHERE l_returnflag = 'N'),
s AS (
  SELECT source_record_id, month_raw AS activity_month_raw, facility_id, fuel_type,
         CAST(date_trunc('month', CASE WHEN regexp_matches(trim(month_raw), '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(try_strptime(trim(month_raw), '%Y-%m-%d') AS DATE)
              WHEN regexp_matches(trim(month_raw), '^[A-Za-z]{3}-\\d{4}$') THEN CAST(try_strptime(trim(month_raw), '%b-%Y') AS DATE)
              WHEN regexp_matches(trim(month_raw), '^\\d{1,2}/\\d{1,2}/\\d{4}$') THEN CAST(try_strptime(trim(month_raw), '%m/%d/%Y') AS DATE) END) AS DATE)
           AS activity_month,
         CAST(CASE WHEN regexp_matches(trim(amount_raw), '^-?\\d+(\\.\\d+)?$') THEN TRY_CAST(trim(amount_raw) AS DECIMAL(18,4)) END AS DOUBLE)
           AS activity_amount,
         COALESCE(CASE lower(NULLIF(trim(unit_raw), '')) WHEN 'gal' THEN 'gallon' WHEN 'gallons' THEN 'gallon'
                    WHEN 'therms' THEN 'therm' END,
                  lower(NULLIF(trim(unit_raw), ''))) AS activity_unit
  FROM fx),
f AS (
  SELECT *,
    CASE WHEN fuel_type = 'natural_gas' AND activity_unit = 'therm' THEN 'natural_gas_therm'
         WHEN fuel_type = 'diesel' AND activity_unit = 'gallon' THEN 'diesel_gallon'
         WHEN fuel_type = 'gasoline' AND activity_unit = 'gallon' THEN 'gasoline_gallon' END AS factor_type
  FROM s)
SELECT source_record_id, activity_month, facility_id, fuel_type, round(activity_amount, 4) AS activity_amount,
       activity_unit, activity_month_raw, factor_type,
       COALESCE((fuel_type = 'natural_gas' AND activity_unit <> 'therm')
                OR (fuel_type IN ('diesel', 'gasoline') AND activity_unit <> 'gallon'), FALSE) AS has_invalid_fuel_unit,
       'Scope 1' AS scope, activity_amount < 0 AS has_negative_activity,
       (facility_id IS NULL OR facility_id = '') AS has_missing_facility_id, activity_month IS NULL AS has_invalid_activity_month,
       activity_amount IS NULL AS has_unparsed_amount,
       factor_type IS NULL AS has_unknown_fuel_type
FROM f
"""


@query("e5_stage_fuel_usage", E5_SQL)
def q_e5(spark, d):
    return rounded(E.stage_fuel_usage(fuel_text_extract(Tables(spark, d))))


def inventory_erp_extract(t):
    """H6 input: snapshot text per line; on hand = quantity − 10, receipts / shipments as text."""
    li = t.lineitem
    k = F.col("l_orderkey")
    d = F.col("l_shipdate").cast("date")
    on_hand = (F.col("l_quantity") - 10).cast("int")
    return li.select(
        F.when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy")).alias("snapshot_date_raw"),
        F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("site_code_norm"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.when(k % 5 == 0, F.concat(on_hand.cast("string"), F.lit(" ea"))).otherwise(on_hand.cast("string")).alias("on_hand_raw"),
        F.when(k % 5 != 0, on_hand).alias("on_hand"),
        F.col("l_quantity").cast("int").cast("string").alias("receipts_raw"),
        F.floor(F.col("l_quantity") / 2).cast("int").cast("string").alias("shipments_raw"))


H6_SQL = """
WITH x AS (
  SELECT CASE WHEN l_orderkey % 2 = 0 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')
              ELSE strftime(CAST(l_shipdate AS DATE), '%m/%d/%Y') END AS snapshot_date_raw,
         'W' || CAST(l_suppkey AS VARCHAR) AS site_code_norm, CAST(l_partkey AS VARCHAR) AS sku,
         CAST(l_quantity - 10 AS INTEGER) AS oh,
         CASE WHEN l_orderkey % 5 = 0 THEN CAST(CAST(l_quantity - 10 AS INTEGER) AS VARCHAR) || ' ea'
              ELSE CAST(CAST(l_quantity - 10 AS INTEGER) AS VARCHAR) END AS on_hand_raw,
         CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_quantity - 10 AS INTEGER) END AS on_hand,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS receipts_raw,
         CAST(CAST(floor(l_quantity / 2) AS INTEGER) AS VARCHAR) AS shipments_raw
  FROM lineitem),
s AS (
  SELECT CASE WHEN regexp_matches(trim(snapshot_date_raw), '^\\d{4}-\\d{2}-\\d{2}$') THEN CAST(try_strptime(trim(snapshot_date_raw), '%Y-%m-%d') AS DATE)
              WHEN regexp_matches(trim(snapshot_date_raw), '^\\d{2}/\\d{2}/\\d{4}$') THEN CAST(try_strptime(trim(snapshot_date_raw), '%m/%d/%Y') AS DATE) END
           AS snapshot_date,
         NULLIF(trim(site_code_norm), '') AS site_code, NULLIF(trim(sku), '') AS sku,
         COALESCE(on_hand, TRY_CAST(NULLIF(regexp_replace(trim(on_hand_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)) AS on_hand_units_raw,
         TRY_CAST(NULLIF(regexp_replace(trim(receipts_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER) AS received_units,
         TRY_CAST(NULLIF(regexp_replace(trim(shipments_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER) AS shipped_units,
         CAST(NULL AS INTEGER) AS requested_units, CAST(NULL AS INTEGER) AS backordered_units,
         CAST(NULL AS VARCHAR) AS load_id, CAST(NULL AS TIMESTAMP) AS ingested_at
  FROM x)
SELECT *, CASE WHEN on_hand_units_raw IS NOT NULL THEN greatest(on_hand_units_raw, 0) END AS on_hand_units,
       COALESCE(on_hand_units_raw < 0, FALSE) AS is_negative_on_hand, on_hand_units_raw IS NULL AS is_missing_units,
       COALESCE(on_hand_units_raw > 0, FALSE) AS in_stock_flag,
       (snapshot_date IS NULL OR site_code IS NULL OR sku IS NULL) AS is_missing_key
FROM s
"""


@query("h6_stage_inventory_erp", H6_SQL)
def q_h6(spark, d):
    return staging.stage_inventory_erp(inventory_erp_extract(Tables(spark, d)))


# Fixed header aliases for the drifted customer extract.
HEADER_ALIASES = {"cust_key": "c_custkey", "customer_name": "c_name", "nation_key": "c_nationkey",
                  "account_balance": "c_acctbal", "segment": "c_mktsegment"}

C23_SQL = """
SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone,
       c_name AS display_name, round(c_acctbal, 4) AS gross_sales, round(c_acctbal * 0.1, 4) AS discount_amount,
       round(c_acctbal - c_acctbal * 0.1, 4) AS net_sales,
       round((c_acctbal - c_acctbal * 0.1) / NULLIF(CAST(c_nationkey + 1 AS DOUBLE), 0), 4) AS unit_net_price,
       round(COALESCE(c_acctbal, 0) - COALESCE(c_acctbal * 0.1, 0), 4) AS gl_net
FROM customer
"""


@query("c23_header_drift", C23_SQL)
def q_c23(spark, d):
    """C23 header drift (snake_case, alias rename, missing required column), C24 coalesced
    alternate headers, C25 derived measures, C27 debit − credit."""
    c = Tables(spark, d).customer
    drifted = c.select(F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("CustomerName"),
                       F.col("c_nationkey").alias("nation-key"), F.col("c_acctbal").alias("Account Balance"),
                       F.col("c_mktsegment").alias("SEGMENT"))
    n = C.normalise_headers(drifted, HEADER_ALIASES, required=["c_phone"])
    n = n.withColumn("store_label", F.lit(None).cast("string"))
    n = C.coalesce_headers(n, "display_name", ["store_label", "dba_name", "c_name"])
    m = C.derive_measures(qty=F.col("c_nationkey") + 1, unit_price=F.lit(None).cast("double"),
                          discount_rate=F.lit(0.1), gross=F.col("c_acctbal"), discount=F.lit(None).cast("double"),
                          net=F.lit(None).cast("double"))
    n = n.withColumns(m).withColumn("gl_net", C.gl_net(F.col("gross_sales"), F.col("discount_amount")))
    return rounded(n.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_phone", "display_name",
                            "gross_sales", "discount_amount", "net_sales", "unit_net_price", "gl_net"))


# E5 inputs as text, rendered from the test tables by key parity; the same renderings are spelled in the SQL.
def _month_text(k, d):
    return (F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(d, "MMM-yyyy"))
            .when(k % 31 == 0, F.lit("n/a")).otherwise(F.date_format(d, "M/d/yyyy")))


def _int_text(c):
    return c.cast("int").cast("string")


MONTH_TEXT_SQL = """CASE WHEN {k} % 3 = 0 THEN strftime({d}, '%Y-%m-%d') WHEN {k} % 3 = 1 THEN strftime({d}, '%b-%Y')
     WHEN {k} % 31 = 0 THEN 'n/a' ELSE CAST(month({d}) AS VARCHAR) || '/1/' || CAST(year({d}) AS VARCHAR) END"""
MONTH_PARSE_SQL = """CAST(CASE WHEN regexp_matches(trim({c}), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime(trim({c}), '%Y-%m-%d')
     WHEN regexp_matches(trim({c}), '^[A-Za-z]{{3}}-\\d{{4}}$') THEN try_strptime(trim({c}), '%b-%Y')
     WHEN regexp_matches(trim({c}), '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime(trim({c}), '%m/%d/%Y') END AS DATE)"""


def _num_sql(c, scale=4):
    return f"CAST(CASE WHEN regexp_matches(trim({c}), '^-?\\d+(\\.\\d+)?$') THEN TRY_CAST(trim({c}) AS DECIMAL(18,{scale})) END AS DOUBLE)"


def _code_sql(c):
    return f"upper(NULLIF(trim({c}), ''))"


def electricity_extract(t):
    li = t.lineitem.filter(F.col("l_returnflag") == "A")
    k = F.col("l_orderkey")
    d = F.trunc(F.col("l_shipdate").cast("date"), "month")
    qty = _int_text(F.col("l_quantity"))
    unit = (F.when(k % 4 == 0, F.lit("kWh")).when(k % 4 == 1, F.lit(" KW HRS")).when(k % 4 == 2, F.lit("kilowatt hours")).otherwise(F.lit("therm")))
    return li.select(
        _month_text(k, d).alias("bill_month"), F.when(k % 9 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" f"), F.col("l_suppkey").cast("string"))).alias("facility_id"),
        F.concat(F.lit(" Power "), F.col("l_linestatus")).alias("utility_provider"), F.concat(F.lit("m"), F.col("l_partkey").cast("string")).alias("meter_number"),
        F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.concat(F.lit("-"), qty)).otherwise(qty).alias("usage_amount"),
        unit.alias("usage_unit"), F.when(k % 11 == 0, F.lit("$5")).otherwise(F.concat(qty, F.lit(".25"))).alias("invoice_amount_usd"),
        F.concat(F.lit("inv-"), k.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("invoice_number"))


E5E_SQL = f"""
WITH x AS (
  SELECT l_orderkey AS k, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, * FROM lineitem
  WHERE l_returnflag = 'A'),
r AS (
  SELECT {MONTH_TEXT_SQL.format(k='k', d='d')} AS bill_month,
         CASE WHEN k % 9 = 0 THEN ' ' ELSE ' f' || CAST(l_suppkey AS VARCHAR) END AS facility_id, ' Power ' || l_linestatus AS utility_provider,
         'm' || CAST(l_partkey AS VARCHAR) AS meter_number, CASE WHEN k % 13 = 0 THEN 'n/a' WHEN k % 17 = 0 THEN '-' || q ELSE q END AS usage_amount,
         CASE k % 4 WHEN 0 THEN 'kWh' WHEN 1 THEN ' KW HRS' WHEN 2 THEN 'kilowatt hours' ELSE 'therm' END AS usage_unit,
         CASE WHEN k % 11 = 0 THEN '$5' ELSE q || '.25' END AS invoice_amount_usd,
         'inv-' || CAST(k AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS invoice_number FROM x),
s AS (
  SELECT {MONTH_PARSE_SQL.format(c='bill_month')} AS activity_month, {_code_sql('facility_id')} AS facility_id, trim(utility_provider) AS utility_provider,
         {_code_sql('meter_number')} AS meter_number, {_num_sql('usage_amount')} AS activity_amount,
         CASE WHEN lower(trim(usage_unit)) IN ('kwh', 'kw hrs', 'kwhrs', 'kilowatt hour', 'kilowatt hours') THEN 'kwh' ELSE lower(trim(usage_unit)) END AS activity_unit,
         {_num_sql('invoice_amount_usd', 2)} AS invoice_amount_usd, {_code_sql('invoice_number')} AS invoice_number, 'Scope 2' AS scope,
         'electricity_kwh' AS factor_type, 'electricity_bills' AS source_system FROM r)
SELECT * REPLACE (round(activity_amount, 4) AS activity_amount, round(invoice_amount_usd, 4) AS invoice_amount_usd),
       activity_amount < 0 AS has_negative_activity, facility_id IS NULL AS has_missing_facility_id,
       activity_month IS NULL AS has_invalid_activity_month FROM s
"""


@query("e5_stage_electricity_bills", E5E_SQL)
def q_e5_electricity(spark, d):
    return rounded(E.stage_electricity_bills(electricity_extract(Tables(spark, d))))


def shipping_extract(t):
    li = t.lineitem.filter(F.col("l_returnflag") == "R")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    d = F.col("l_shipdate").cast("date")
    qty = _int_text(F.col("l_quantity"))
    mode = F.when(n % 3 == 0, F.lit(" Truck")).when(n % 3 == 1, F.lit("AIR")).otherwise(F.lit("rail"))
    return li.select(
        F.concat(F.lit(" sh"), k.cast("string"), F.lit("-"), n.cast("string")).alias("shipment_id"),
        F.when(k % 19 == 0, F.lit("tbd")).when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy")).alias("shipment_date"),
        F.when(k % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("f"), F.col("l_suppkey").cast("string"))).alias("origin_facility_id"),
        F.lit(" ny ").alias("destination_state"),
        F.when(k % 5 != 0, F.concat(F.lit("pl-"), (F.col("l_partkey") % 20).cast("string"))).alias("product_line_id"),
        mode.alias("shipping_mode"), F.concat(F.lit("Carrier "), F.col("l_linestatus"), F.lit(" ")).alias("carrier"),
        F.concat(qty, F.lit("0")).alias("distance_miles"), F.when(k % 7 == 0, F.lit("1,000")).otherwise(qty).alias("shipment_weight_lb"),
        F.when(k % 13 == 0, F.lit("-5.5")).otherwise(F.concat(qty, F.lit(".75"))).alias("ton_miles"), qty.alias("freight_cost_usd"))


E5S_SQL = f"""
WITH x AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_shipdate AS DATE) AS d, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q, * FROM lineitem
           WHERE l_returnflag = 'R'),
r AS (
  SELECT ' sh' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS shipment_id,
         CASE WHEN k % 19 = 0 THEN 'tbd' WHEN k % 2 = 0 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%m/%d/%Y') END AS shipment_date,
         CASE WHEN k % 9 = 0 THEN '' ELSE 'f' || CAST(l_suppkey AS VARCHAR) END AS origin_facility_id, ' ny ' AS destination_state,
         CASE WHEN k % 5 <> 0 THEN 'pl-' || CAST(l_partkey % 20 AS VARCHAR) END AS product_line_id,
         CASE n % 3 WHEN 0 THEN ' Truck' WHEN 1 THEN 'AIR' ELSE 'rail' END AS shipping_mode, 'Carrier ' || l_linestatus || ' ' AS carrier,
         q || '0' AS distance_miles, CASE WHEN k % 7 = 0 THEN '1,000' ELSE q END AS shipment_weight_lb,
         CASE WHEN k % 13 = 0 THEN '-5.5' ELSE q || '.75' END AS ton_miles, q AS freight_cost_usd FROM x),
p AS (SELECT *, CAST(CASE WHEN regexp_matches(trim(shipment_date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime(trim(shipment_date), '%Y-%m-%d')
                         WHEN regexp_matches(trim(shipment_date), '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$') THEN try_strptime(trim(shipment_date), '%m/%d/%Y') END AS DATE) AS sd FROM r),
s AS (
  SELECT {_code_sql('shipment_id')} AS shipment_id, sd AS shipment_date, CAST(date_trunc('month', sd) AS DATE) AS activity_month,
         {_code_sql('origin_facility_id')} AS facility_id, {_code_sql('destination_state')} AS destination_state,
         {_code_sql('product_line_id')} AS product_line_id, lower(trim(shipping_mode)) AS shipping_mode, trim(carrier) AS carrier,
         {_num_sql('distance_miles')} AS distance_miles, {_num_sql('shipment_weight_lb')} AS shipment_weight_lb, {_num_sql('ton_miles')} AS activity_amount,
         'ton_mile' AS activity_unit, {_num_sql('freight_cost_usd', 2)} AS freight_cost_usd, 'Scope 3' AS scope,
         CASE lower(trim(shipping_mode)) WHEN 'truck' THEN 'freight_truck_ton_mile' WHEN 'air' THEN 'freight_air_ton_mile' END AS factor_type,
         'shipping_miles' AS source_system FROM p)
SELECT * REPLACE (round(distance_miles, 4) AS distance_miles, round(shipment_weight_lb, 4) AS shipment_weight_lb,
                  round(activity_amount, 4) AS activity_amount, round(freight_cost_usd, 4) AS freight_cost_usd),
       activity_amount < 0 AS has_negative_activity, facility_id IS NULL AS has_missing_facility_id,
       product_line_id IS NULL AS has_missing_product_line_id, shipment_date IS NULL AS has_invalid_shipment_date,
       factor_type IS NULL AS has_unknown_shipping_mode FROM s
"""


@query("e5_stage_shipping_miles", E5S_SQL)
def q_e5_shipping(spark, d):
    return rounded(E.stage_shipping_miles(shipping_extract(Tables(spark, d))))


# Fixed material words by order priority.
PRIORITY_MATERIAL = {"1-URGENT": " Paper", "2-HIGH": "PLASTIC", "3-MEDIUM": "glass", "4-NOT SPECIFIED": "Wood", "5-LOW": "paper "}


def packaging_extract(t):
    k = F.col("o_orderkey")
    d = F.trunc(F.col("o_orderdate").cast("date"), "month")
    qty = (k % 500).cast("string")
    material = F.create_map(*[F.lit(x) for kv in PRIORITY_MATERIAL.items() for x in kv])[F.col("o_orderpriority")]
    return t.orders.select(
        _month_text(k, d).alias("invoice_month"), F.concat(F.lit(" f"), (k % 100).cast("string")).alias("facility_id"),
        F.when(k % 4 != 0, F.concat(F.lit("pl-"), (k % 20).cast("string"))).alias("product_line_id"), material.alias("material_type"),
        F.concat(F.lit("Supplier "), F.col("o_orderstatus")).alias("supplier_name"), qty.alias("units_purchased"),
        F.when(k % 13 == 0, F.lit("?")).when(k % 17 == 0, F.lit("-3")).otherwise(F.concat(qty, F.lit(".5"))).alias("material_weight_kg"),
        F.concat(F.lit("p"), k.cast("string")).alias("invoice_number"), F.concat(qty, F.lit(".10")).alias("cost_usd"))


E5P_SQL = f"""
WITH x AS (SELECT o_orderkey AS k, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, CAST(o_orderkey % 500 AS VARCHAR) AS q, * FROM orders),
r AS (
  SELECT {MONTH_TEXT_SQL.format(k='k', d='d')} AS invoice_month, ' f' || CAST(k % 100 AS VARCHAR) AS facility_id,
         CASE WHEN k % 4 <> 0 THEN 'pl-' || CAST(k % 20 AS VARCHAR) END AS product_line_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN ' Paper' WHEN '2-HIGH' THEN 'PLASTIC' WHEN '3-MEDIUM' THEN 'glass'
              WHEN '4-NOT SPECIFIED' THEN 'Wood' WHEN '5-LOW' THEN 'paper ' END AS material_type, 'Supplier ' || o_orderstatus AS supplier_name,
         q AS units_purchased, CASE WHEN k % 13 = 0 THEN '?' WHEN k % 17 = 0 THEN '-3' ELSE q || '.5' END AS material_weight_kg,
         'p' || CAST(k AS VARCHAR) AS invoice_number, q || '.10' AS cost_usd FROM x),
s AS (
  SELECT {MONTH_PARSE_SQL.format(c='invoice_month')} AS activity_month, {_code_sql('facility_id')} AS facility_id,
         {_code_sql('product_line_id')} AS product_line_id, lower(trim(material_type)) AS material_type, trim(supplier_name) AS supplier_name,
         {_num_sql('units_purchased')} AS units_purchased, {_num_sql('material_weight_kg')} AS activity_amount, 'kg' AS activity_unit,
         {_code_sql('invoice_number')} AS invoice_number, {_num_sql('cost_usd', 2)} AS cost_usd, 'Scope 3' AS scope,
         CASE lower(trim(material_type)) WHEN 'paper' THEN 'packaging_paper_kg' WHEN 'plastic' THEN 'packaging_plastic_kg'
              WHEN 'glass' THEN 'packaging_glass_kg' END AS factor_type, 'packaging_materials' AS source_system FROM r)
SELECT * REPLACE (round(units_purchased, 4) AS units_purchased, round(activity_amount, 4) AS activity_amount, round(cost_usd, 4) AS cost_usd),
       activity_amount < 0 AS has_negative_activity, facility_id IS NULL AS has_missing_facility_id,
       product_line_id IS NULL AS has_missing_product_line_id, activity_month IS NULL AS has_invalid_activity_month,
       factor_type IS NULL AS has_unknown_material_type FROM s
"""


@query("e5_stage_packaging_materials", E5P_SQL)
def q_e5_packaging(spark, d):
    return rounded(E.stage_packaging_materials(packaging_extract(Tables(spark, d))))
