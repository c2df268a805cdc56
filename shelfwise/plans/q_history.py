"""Dedup, latest-record, effective-dating and event-pairing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, history, staging
from ..sources.testdata import Tables
from . import model, raw
from .oracle import PUNCHES
from .q_clean import H1_SQL
from .registry import query, rounded

LINE_PAYLOAD = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]
_desc = ", ".join(f"{c} DESC NULLS LAST" for c in LINE_PAYLOAD)

D1_SQL = f"""
SELECT l_orderkey, l_linenumber, {", ".join(LINE_PAYLOAD)}, dup_group_size
FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_group_size,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY (l_linestatus = 'F') DESC NULLS LAST, l_shipdate DESC NULLS LAST, {_desc}) AS rn
  FROM lineitem
) WHERE rn = 1
"""


@query("d1_keep_best_lines", D1_SQL)
def q_d1(spark, d):
    li = Tables(spark, d).lineitem
    return dedup.keep_best(li, ["l_orderkey", "l_linenumber"],
                           [(F.col("l_linestatus") == "F", "desc"), ("l_shipdate", "desc")])


STATUS_PAYLOAD = ["load_id", "drop_date", "status_date", "status_date_raw", "account_status",
                  "account_status_raw", "status_reason", "is_missing_key", "is_duplicate_candidate"]

D2_SQL = f"""
WITH staged AS ({H1_SQL})
SELECT store_code, {", ".join(STATUS_PAYLOAD)}, version_count
FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY store_code) AS version_count,
         ROW_NUMBER() OVER (PARTITION BY store_code ORDER BY COALESCE(status_date, drop_date) DESC NULLS LAST,
                            drop_date DESC NULLS LAST, load_id DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in STATUS_PAYLOAD)}) AS rn
  FROM staged WHERE store_code IS NOT NULL
) WHERE rn = 1
"""


def staged_status(t):
    return staging.stage_account_status(raw.account_status_extract(t))


@query("d2_latest_account_status", D2_SQL)
def q_d2(spark, d):
    s = staged_status(Tables(spark, d)).filter(F.col("store_code").isNotNull())
    s = s.select("store_code", *STATUS_PAYLOAD)
    return dedup.latest_per_key(s, ["store_code"], F.coalesce("status_date", "drop_date"))


D10_SQL = f"""
WITH staged AS ({H1_SQL}),
v AS (
  SELECT store_code, status_date, account_status, status_reason,
         COUNT(*) OVER (PARTITION BY store_code, status_date) AS rows_on_date,
         ROW_NUMBER() OVER (PARTITION BY store_code, status_date
                            ORDER BY account_status DESC NULLS LAST, status_reason DESC NULLS LAST) AS rn
  FROM staged WHERE store_code IS NOT NULL AND status_date IS NOT NULL
)
SELECT store_code, status_date, account_status, status_reason, rows_on_date,
       status_date AS valid_from,
       CAST(LEAD(status_date) OVER w - INTERVAL 1 DAY AS DATE) AS valid_to,
       LEAD(status_date) OVER w IS NULL AS is_current,
       CAST(ROW_NUMBER() OVER w AS INTEGER) AS version_number
FROM v WHERE rn = 1
WINDOW w AS (PARTITION BY store_code ORDER BY status_date)
"""


@query("d10_account_status_ranges", D10_SQL)
def q_d10(spark, d):
    s = staged_status(Tables(spark, d)).filter(F.col("store_code").isNotNull() & F.col("status_date").isNotNull())
    s = s.select("store_code", "status_date", "account_status", "status_reason")
    return history.effective_ranges(s, ["store_code"], "status_date")


PAIRS_CTE = f"""
{PUNCHES},
ev AS (SELECT * FROM punches WHERE punch_ts IS NOT NULL AND action IS NOT NULL AND work_date IS NOT NULL
                                 AND store_code IS NOT NULL AND employee_id IS NOT NULL),
o AS (SELECT *, LEAD(action) OVER w AS next_action, LEAD(punch_ts) OVER w AS next_ts
      FROM ev WINDOW w AS (PARTITION BY store_code, employee_id ORDER BY punch_ts, action)),
p AS (SELECT *, (action = 'IN' AND next_action = 'OUT' AND next_ts IS NOT NULL AND next_ts >= punch_ts) AS is_pair
      FROM o),
pm AS (SELECT *, CASE WHEN is_pair THEN greatest((epoch_us(next_ts) - epoch_us(punch_ts)) / 60000000.0, 0.0) END
                   AS minutes_worked FROM p)"""

M16_CORE = f"""
WITH {PAIRS_CTE}
SELECT work_date, store_code, employee_id,
       SUM(minutes_worked) AS minutes_worked, SUM(minutes_worked) / 60.0 AS hours_worked,
       CAST(count(*) FILTER (WHERE is_pair) AS BIGINT) AS n_shift_pairs,
       CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(*) FILTER (WHERE action = 'IN' AND (next_action IS DISTINCT FROM 'OUT' OR next_ts IS NULL)) AS BIGINT)
         AS n_unpaired_in,
       CAST(count(*) FILTER (WHERE action = 'OUT') AS BIGINT) AS n_out_events
FROM pm GROUP BY 1, 2, 3
HAVING count(*) FILTER (WHERE is_pair) > 0
"""

M16_SQL = f"""
SELECT work_date, store_code, employee_id, round(minutes_worked, 4) AS minutes_worked,
       round(hours_worked, 4) AS hours_worked, n_shift_pairs, n_events, n_unpaired_in, n_out_events
FROM ({M16_CORE})
"""


@query("m16_labor_daily_employee", M16_SQL)
def q_m16(spark, d):
    return rounded(history.labor_daily_employee(model.punches(Tables(spark, d))))


M21_SQL = f"""
WITH {PAIRS_CTE}
SELECT work_date, store_code, employee_id, punch_ts AS clock_in_at, next_ts AS clock_out_at,
       round(minutes_worked, 4) AS minutes_worked
FROM pm WHERE is_pair
"""


@query("m21_punch_intervals", M21_SQL)
def q_m21(spark, d):
    return rounded(history.punch_intervals(model.punches(Tables(spark, d))))


M17_SQL = f"""
SELECT work_date, store_code, round(SUM(hours_worked), 4) AS labor_hours,
       CAST(COUNT(DISTINCT employee_id) AS BIGINT) AS employees_worked,
       CAST(SUM(n_shift_pairs) AS BIGINT) AS shift_pairs, CAST(SUM(n_unpaired_in) AS BIGINT) AS unpaired_in
FROM ({M16_CORE}) GROUP BY 1, 2
"""


@query("m17_labor_store_daily", M17_SQL)
def q_m17(spark, d):
    daily = history.labor_daily_employee(model.punches(Tables(spark, d)))
    return rounded(history.labor_store_daily(daily))


D7_SQL = f"""
WITH {PUNCHES}
SELECT punch_ts, store_code, employee_id, action, punch_id, work_date, action NOT IN ('IN', 'OUT') AS is_bad_action,
       dup_group_size, md5(concat_ws('|', CAST(punch_ts AS VARCHAR), store_code, CAST(employee_id AS VARCHAR), action)) AS record_id
FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY punch_ts, store_code, employee_id, action) AS dup_group_size,
         ROW_NUMBER() OVER (PARTITION BY punch_ts, store_code, employee_id, action
                            ORDER BY action NOT IN ('IN', 'OUT'), punch_id DESC NULLS LAST, work_date DESC NULLS LAST) AS rn
  FROM punches WHERE punch_ts IS NOT NULL AND store_code IS NOT NULL AND employee_id IS NOT NULL AND action IS NOT NULL
) WHERE rn = 1
"""


@query("d7_punch_dedup", D7_SQL)
def q_d7(spark, d):
    p = model.punches(Tables(spark, d)).select("punch_ts", "store_code", "employee_id", "action", "punch_id", "work_date")
    p = p.withColumn("is_bad_action", ~F.col("action").isin("IN", "OUT"))
    return dedup.dedup_with_id(p, ["punch_ts", "store_code", "employee_id", "action"])


SHIPMENTS_CTE = """
shipments AS (
  SELECT CASE WHEN l_linenumber <> 1 THEN 'SH' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END
           AS shipment_id,
         'L' || CAST(l_orderkey AS VARCHAR) AS load_id, CAST(l_shipdate AS DATE) AS ship_date,
         l_suppkey AS site_id, l_partkey AS sku, l_quantity AS units_shipped, l_returnflag AS carrier
  FROM lineitem
)"""

M14_SQL = f"""
WITH {SHIPMENTS_CTE},
k AS (SELECT *, COALESCE(shipment_id, load_id) AS dedup_key FROM shipments),
best AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY dedup_key, ship_date, site_id, sku
                                 ORDER BY COALESCE(units_shipped < 0, FALSE), load_id DESC NULLS LAST,
                                          shipment_id DESC NULLS LAST, units_shipped DESC NULLS LAST,
                                          carrier DESC NULLS LAST) AS rn
    FROM k WHERE dedup_key IS NOT NULL AND ship_date IS NOT NULL AND site_id IS NOT NULL AND sku IS NOT NULL) WHERE rn = 1
)
SELECT ship_date, site_id, CAST(COUNT(DISTINCT dedup_key) AS BIGINT) AS shipments,
       round(SUM(units_shipped), 4) AS units_shipped, MAX(carrier) AS any_carrier
FROM best GROUP BY 1, 2
"""


@query("m14_shipments_daily", M14_SQL)
def q_m14(spark, d):
    s = model.shipments(Tables(spark, d))
    best = dedup.dedup_fallback_key(s, "shipment_id", "load_id", ["ship_date", "site_id", "sku"], "units_shipped")
    out = best.groupBy("ship_date", "site_id").agg(
        F.count_distinct("dedup_key").alias("shipments"),
        F.sum("units_shipped").alias("units_shipped"),
        F.max("carrier").alias("any_carrier"))
    return rounded(out)
