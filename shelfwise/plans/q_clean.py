"""Cleaning and staging queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..operators import staging
from ..operators.dedup import duplicate_candidates
from ..sources.testdata import Tables
from . import model, raw
from .oracle import ACCOUNT_STATUS_EXTRACT, ORDERS_TEXT, SALES_DISTRIBUTOR_EXTRACT, TIMECLOCK_EXTRACT
from .registry import query, rounded

PRIORITY_RULES = (("%urgent%", "urgent"), ("%high%", "high"), ("%low%", "low"))

_ISO = r"'^\d{4}-\d{2}-\d{2}$'"
_US = r"'^\d{2}/\d{2}/\d{4}$'"


def sql_parse_date(typed: str, raw_: str) -> str:
    r = f"trim({raw_})"
    txt = (f"CASE WHEN regexp_matches({r}, {_ISO}) THEN CAST(try_strptime({r}, '%Y-%m-%d') AS DATE) "
           f"WHEN regexp_matches({r}, {_US}) THEN CAST(try_strptime({r}, '%m/%d/%Y') AS DATE) END")
    return txt if typed == "NULL" else f"COALESCE({typed}, {txt})"


ORDERS_TEXT_SQL = f"""
WITH {ORDERS_TEXT},
c AS (
  SELECT TRY_CAST(NULLIF(trim(order_id_raw), '') AS BIGINT) AS order_id,
         {sql_parse_date('NULL', 'order_date_raw')} AS order_date,
         TRY_CAST(NULLIF(trim(regexp_replace(total_raw, '[$,]', '', 'g')), '') AS DECIMAL(18,4)) AS total_amount,
         TRY_CAST(NULLIF(regexp_replace(trim(total_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4)) AS total_lenient,
         CAST(CASE WHEN regexp_matches(trim(total_raw), '^-?\\d+(\\.\\d+)?$')
                   THEN TRY_CAST(trim(total_raw) AS DECIMAL(18,2)) END AS DOUBLE) AS total_strict,
         TRY_CAST(NULLIF(regexp_replace(trim(customer_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER) AS customer_lenient,
         NULLIF(trim(upper(regexp_replace(trim(customer_raw), '[\\s\\-]', '', 'g'))), '') AS customer_code,
         NULLIF(trim(upper(regexp_replace(customer_raw, '[^A-Za-z0-9]', '', 'g'))), '') AS customer_alnum,
         NULLIF(trim(regexp_replace(customer_raw, '[^0-9]', '', 'g')), '') AS customer_digits,
         upper(NULLIF(trim(priority_raw), '')) AS priority,
         CASE WHEN priority_raw IS NULL THEN NULL
              WHEN lower(trim(priority_raw)) LIKE '%urgent%' THEN 'urgent'
              WHEN lower(trim(priority_raw)) LIKE '%high%' THEN 'high'
              WHEN lower(trim(priority_raw)) LIKE '%low%' THEN 'low'
              ELSE NULLIF(trim(lower(trim(priority_raw))), '') END AS priority_bucket,
         NULLIF(trim(status_raw), '') AS status,
         order_id_raw, order_date_raw, customer_raw
  FROM orders_text
)
SELECT order_id, order_date, round(total_amount, 4) AS total_amount, round(total_lenient, 4) AS total_lenient,
       round(total_strict, 4) AS total_strict, customer_lenient, customer_code, customer_alnum, customer_digits,
       priority, priority_bucket, status,
       concat_ws('|', COALESCE(order_id_raw, 'MISSING'), COALESCE(CAST(order_date AS VARCHAR), 'MISSING'),
                 COALESCE(customer_code, 'MISSING')) AS record_key,
       COALESCE(CASE WHEN order_date IS NULL THEN 'order_date' END,
                CASE WHEN total_amount IS NULL THEN 'total_amount' END) AS first_missing_field,
       md5(concat_ws('|', order_id_raw, customer_code, priority)) AS row_hash,
       md5(concat_ws('|', COALESCE(CAST(order_date AS VARCHAR), '<null>'), COALESCE(customer_code, '<null>'))) AS row_hash_nullsafe,
       (order_date IS NULL OR total_amount IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY customer_code, order_date) > 1 AS is_duplicate_candidate
FROM c
"""


@query("c_orders_text_cleaning", ORDERS_TEXT_SQL)
def q_orders_text(spark, d):
    """C1, C2, C6–C10, C13–C15, C17, C30–C33, G1, G2 on an all-text orders extract."""
    r = model.raw_orders_text(Tables(spark, d))
    c = r.select(
        C.cast_trim("order_id_raw", "bigint").alias("order_id"),
        C.parse_date(None, "order_date_raw").alias("order_date"),
        C.money("total_raw").alias("total_amount"),
        C.lenient_decimal(None, "total_raw").alias("total_lenient"),
        C.strict_decimal("total_raw", 18, 2).cast("double").alias("total_strict"),
        C.lenient_int(None, "customer_raw").alias("customer_lenient"),
        C.norm_code("customer_raw").alias("customer_code"),
        C.alnum_code("customer_raw").alias("customer_alnum"),
        C.digits("customer_raw").alias("customer_digits"),
        C.canon("priority_raw", "upper").alias("priority"),
        C.classify_like("priority_raw", PRIORITY_RULES).alias("priority_bucket"),
        C.blank_to_null("status_raw").alias("status"),
        "order_id_raw", "order_date_raw", "customer_raw",
    )
    c = c.select(
        "*",
        C.record_key("order_id_raw", "order_date", "customer_code").alias("record_key"),
        C.first_null_label([("order_date", "order_date"), ("total_amount", "total_amount")]).alias("first_missing_field"),
        C.hash_key("order_id_raw", "customer_code", "priority").alias("row_hash"),
        C.hash_key_nullsafe("order_date", "customer_code").alias("row_hash_nullsafe"),
        staging.is_missing_key(["order_date", "total_amount"]).alias("is_missing_key"),
    )
    c = duplicate_candidates(c, ["customer_code", "order_date"])
    return rounded(c.drop("order_id_raw", "order_date_raw", "customer_raw"))


H1_SQL = f"""
WITH {ACCOUNT_STATUS_EXTRACT},
s AS (
  SELECT load_id, CAST(NULL AS DATE) AS drop_date,
         {sql_parse_date('status_date', 'status_date_raw')} AS status_date,
         status_date_raw,
         NULLIF(trim(store_code_norm), '') AS store_code,
         CASE WHEN account_status_raw IS NULL THEN NULL
              WHEN lower(trim(account_status_raw)) LIKE '%inactive%' THEN 'inactive'
              WHEN lower(trim(account_status_raw)) LIKE '%suspend%' THEN 'suspended'
              WHEN lower(trim(account_status_raw)) LIKE '%pending%' THEN 'pending'
              WHEN lower(trim(account_status_raw)) LIKE '%active%' THEN 'active'
              ELSE NULLIF(trim(lower(trim(account_status_raw))), '') END AS account_status,
         account_status_raw,
         NULLIF(trim(status_reason_norm), '') AS status_reason
  FROM account_status_extract
)
SELECT *, (status_date IS NULL OR store_code IS NULL OR account_status IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY load_id, status_date, store_code, account_status) > 1 AS is_duplicate_candidate
FROM s
"""


@query("h1_stage_account_status", H1_SQL)
def q_h1(spark, d):
    return staging.stage_account_status(raw.account_status_extract(Tables(spark, d)))


H4_SQL = f"""
WITH {SALES_DISTRIBUTOR_EXTRACT},
s AS (
  SELECT load_id, CAST(NULL AS DATE) AS drop_date, CAST(NULL AS TIMESTAMP) AS ingested_at,
         {sql_parse_date('sale_date', 'sale_date_raw')} AS sale_date,
         NULLIF(trim(store_id_norm), '') AS store_code,
         NULLIF(trim(sku), '') AS sku,
         CASE WHEN channel_norm IS NULL THEN NULL
              WHEN lower(trim(channel_norm)) LIKE '%retail%' THEN 'retail'
              WHEN lower(trim(channel_norm)) LIKE '%wholesale%' THEN 'wholesale'
              WHEN lower(trim(channel_norm)) LIKE '%distrib%' THEN 'distributor'
              ELSE NULLIF(trim(lower(trim(channel_norm))), '') END AS channel,
         COALESCE(qty, TRY_CAST(NULLIF(regexp_replace(trim(qty_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)) AS qty,
         unit_list_price, gross_sales, discount_amount, net_sales, cogs, NULLIF(trim(product_name_raw), '') AS product_name,
         COALESCE(discount_rate, TRY_CAST(NULLIF(regexp_replace(trim(discount_rate_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4))) AS discount_rate,
         COALESCE(unit_net_price, TRY_CAST(NULLIF(regexp_replace(trim(unit_net_price_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4))) AS unit_net_price,
         COALESCE(orders, TRY_CAST(NULLIF(regexp_replace(trim(orders_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)) AS orders,
         COALESCE(customers, TRY_CAST(NULLIF(regexp_replace(trim(customers_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER)) AS customers
  FROM sales_distributor_extract
)
SELECT load_id, drop_date, ingested_at, sale_date, store_code, sku, channel, qty,
       round(unit_list_price, 4) AS unit_list_price, round(gross_sales, 4) AS gross_sales,
       round(discount_amount, 4) AS discount_amount, round(net_sales, 4) AS net_sales, round(cogs, 4) AS cogs,
       product_name, round(discount_rate, 4) AS discount_rate, round(unit_net_price, 4) AS unit_net_price, orders, customers,
       COALESCE(gross_sales < 0 OR net_sales < 0 OR discount_amount < 0 OR cogs < 0, FALSE)
         OR COALESCE(net_sales > gross_sales + 0.01, FALSE)
         OR COALESCE(abs((net_sales + discount_amount) - gross_sales) > 0.50, FALSE) AS is_bad_amount,
       (sale_date IS NULL OR store_code IS NULL OR sku IS NULL OR channel IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY load_id, sale_date, store_code, sku, channel,
                      COALESCE(qty, -1), COALESCE(net_sales, -1.0)) > 1 AS is_duplicate_candidate
FROM s
"""


import re as _re  # noqa: E402

# Same query without output rounding, for reuse as an input CTE.
H4_CORE = _re.sub(r"round\((\w+), 4\) AS \1", r"\1", H4_SQL)


@query("h4_stage_sales_distributor", H4_SQL)
def q_h4(spark, d):
    return rounded(staging.stage_sales_distributor(raw.sales_distributor_extract(Tables(spark, d))))


_TS_ISO = r"'^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?$'"
_TS_US = r"'^\d{2}/\d{2}/\d{4} \d{2}:\d{2}(:\d{2})?$'"

H8_SQL = f"""
WITH {TIMECLOCK_EXTRACT},
p AS (
  SELECT *,
    CASE WHEN regexp_matches(trim(punch_ts_raw), {_TS_ISO})
              THEN COALESCE(try_strptime(replace(trim(punch_ts_raw), 'T', ' '), '%Y-%m-%d %H:%M:%S'),
                            try_strptime(replace(trim(punch_ts_raw), 'T', ' '), '%Y-%m-%d %H:%M'))
         WHEN regexp_matches(trim(punch_ts_raw), {_TS_US})
              THEN COALESCE(try_strptime(trim(punch_ts_raw), '%m/%d/%Y %H:%M:%S'),
                            try_strptime(trim(punch_ts_raw), '%m/%d/%Y %H:%M')) END AS punch_ts
  FROM timeclock_extract
),
s AS (
  SELECT punch_ts,
         COALESCE({sql_parse_date('NULL', 'left(trim(punch_ts_raw), 10)')}, CAST(punch_ts AS DATE)) AS punch_date,
         TRY_CAST(NULLIF(regexp_replace(trim(employee_id_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER) AS employee_id,
         NULLIF(trim(site_code_norm), '') AS store_code,
         COALESCE(CASE upper(NULLIF(trim(action_raw), ''))
                    WHEN 'IN' THEN 'IN' WHEN 'CLOCKIN' THEN 'IN' WHEN 'CLOCK_IN' THEN 'IN' WHEN 'START' THEN 'IN' WHEN 'PUNCHIN' THEN 'IN' WHEN 'PUNCH_IN' THEN 'IN'
                    WHEN 'OUT' THEN 'OUT' WHEN 'CLOCKOUT' THEN 'OUT' WHEN 'CLOCK_OUT' THEN 'OUT' WHEN 'END' THEN 'OUT' WHEN 'PUNCHOUT' THEN 'OUT' WHEN 'PUNCH_OUT' THEN 'OUT'
                    WHEN 'CLICK' THEN 'IN' WHEN 'VIEW' THEN 'OUT' END,
                  upper(NULLIF(trim(action_raw), ''))) AS action,
         load_id
  FROM p
)
SELECT *, COALESCE(action NOT IN ('IN', 'OUT'), FALSE) AS is_bad_action,
       (punch_ts IS NULL OR punch_date IS NULL OR employee_id IS NULL OR store_code IS NULL OR action IS NULL) AS is_missing_key,
       COUNT(*) OVER (PARTITION BY load_id, punch_ts, store_code, employee_id, action) > 1 AS is_duplicate_candidate
FROM s
"""


@query("h8_stage_timeclock", H8_SQL)
def q_h8(spark, d):
    syn = {**C.ACTION_SYNONYMS, **model.PUNCH_ACTIONS}
    return staging.stage_timeclock(raw.timeclock_extract(Tables(spark, d)), synonyms=syn)
