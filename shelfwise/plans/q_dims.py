"""Store master / dimension and distribution coverage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, facts, history, staging
from ..sources.testdata import Tables
from . import raw
from .q_clean import H1_SQL
from .q_history import D2_SQL, STATUS_PAYLOAD, staged_status
from .registry import query

INITCAP = "array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"

H2_CORE = f"""
sm AS (
  SELECT CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS as_of_date0,
         strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y') AS as_of_date_raw,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS drop_date,
         CAST(c_custkey AS VARCHAR) AS dispensary_id_norm, ' ' || CAST(c_custkey AS VARCHAR) || ' ' AS store_code_norm,
         CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE lower(c_name) END AS dispensary_name_norm,
         CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE n_name END AS state_norm, lower(r_name) AS city_norm,
         CASE WHEN o_orderkey % 11 = 0 THEN ' 123 ' ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS postal_code_norm,
         CASE WHEN o_orderkey % 6 <> 0 THEN ' lic-' || CAST(c_custkey AS VARCHAR) END AS license_id_norm,
         c_mktsegment AS account_type_norm
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
h2a AS (
  SELECT COALESCE(as_of_date0, CASE WHEN regexp_matches(trim(as_of_date_raw), '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')
                                    THEN CAST(try_strptime(trim(as_of_date_raw), '%m/%d/%Y') AS DATE) END) AS as_of_date,
         drop_date, NULLIF(trim(dispensary_id_norm), '') AS dispensary_id,
         NULLIF(trim(store_code_norm), '') AS store_code, NULLIF(trim(dispensary_name_norm), '') AS dispensary_name,
         upper(trim(state_norm)) AS state,
         {INITCAP.format(x="NULLIF(trim(city_norm), '')")} AS city,
         NULLIF(trim(postal_code_norm), '') AS postal_code, upper(NULLIF(trim(license_id_norm), '')) AS license_id,
         lower(NULLIF(trim(account_type_norm), '')) AS account_type
  FROM sm),
h2 AS (
  SELECT *, (dispensary_id IS NULL OR dispensary_name IS NULL) AS is_missing_key,
         COALESCE(length(state) <> 2, FALSE) AS is_bad_state_code, COALESCE(length(postal_code) < 5, FALSE) AS is_bad_postal_code,
         COUNT(*) OVER (PARTITION BY COALESCE(as_of_date, drop_date), dispensary_id) > 1 AS is_duplicate_candidate
  FROM h2a)"""

H2_SQL = f"WITH {H2_CORE} SELECT * FROM h2"


def staged_master(t):
    return staging.stage_store_master(raw.store_master_extract(t))


@query("h2_stage_store_master", H2_SQL)
def q_h2(spark, d):
    return staged_master(Tables(spark, d))


_H2_PAYLOAD = ["as_of_date", "drop_date", "dispensary_id", "dispensary_name", "state", "city", "postal_code",
               "license_id", "account_type", "is_missing_key", "is_bad_state_code", "is_bad_postal_code", "is_duplicate_candidate"]

D3_CORE = H2_CORE + f""",
d3 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY store_code) AS version_count,
         ROW_NUMBER() OVER (PARTITION BY store_code ORDER BY COALESCE(as_of_date, drop_date) DESC NULLS LAST,
                            is_missing_key, (dispensary_id IS NOT NULL) DESC, (dispensary_name IS NOT NULL) DESC,
                            drop_date DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in _H2_PAYLOAD)}) AS rn
  FROM h2 WHERE store_code IS NOT NULL) WHERE rn = 1)"""


def latest_master(t):
    s = staged_master(t).filter(F.col("store_code").isNotNull())
    return dedup.latest_complete(s, ["store_code"], ["dispensary_id", "dispensary_name"], F.coalesce("as_of_date", "drop_date"))


@query("d3_latest_store_master", f"WITH {D3_CORE} SELECT * FROM d3")
def q_d3(spark, d):
    return latest_master(Tables(spark, d))


M2_SQL = f"""
WITH {D3_CORE}, d2 AS ({D2_SQL})
SELECT d3.*, d2.account_status, d2.status_date AS account_status_date,
       COALESCE(d2.account_status = 'active', FALSE) AS is_active, d2.account_status IS NOT NULL AS has_status
FROM d3 LEFT JOIN d2 ON d3.store_code = d2.store_code
"""


def current_status(t):
    s = staged_status(t).filter(F.col("store_code").isNotNull()).select("store_code", *STATUS_PAYLOAD)
    return dedup.latest_per_key(s, ["store_code"], F.coalesce("status_date", "drop_date"))


@query("m2_store_dimension", M2_SQL)
def q_m2(spark, d):
    t = Tables(spark, d)
    return facts.store_dimension(latest_master(t), current_status(t))


H3_CORE = """
dx AS (
  SELECT CASE WHEN line_number % 4 <> 0 THEN sale_date END AS as_of_date0, strftime(sale_date, '%Y-%m-%d') AS as_of_date_raw,
         CAST(store_id AS VARCHAR) AS store_code_norm, CAST(sku AS VARCHAR) AS sku_norm,
         CASE WHEN units >= 40 THEN ' In_Distribution' WHEN units >= 20 THEN 'CARRIED' WHEN units >= 10 THEN 'available'
              WHEN units >= 5 THEN 'Pending_Launch' WHEN units >= 2 THEN 'not_listed' ELSE 'Retired ' END
           AS distribution_status_norm,
         order_priority AS status_reason_norm, 'L' || CAST(order_id % 2 AS VARCHAR) AS load_id
  FROM sales_lines),
h3a AS (
  SELECT COALESCE(as_of_date0, CASE WHEN regexp_matches(trim(as_of_date_raw), '^\\d{4}-\\d{2}-\\d{2}$')
                                    THEN CAST(try_strptime(trim(as_of_date_raw), '%Y-%m-%d') AS DATE) END) AS as_of_date,
         NULLIF(trim(store_code_norm), '') AS store_code, NULLIF(trim(sku_norm), '') AS sku,
         lower(NULLIF(trim(distribution_status_norm), '')) AS distribution_status,
         NULLIF(trim(status_reason_norm), '') AS status_reason, load_id
  FROM dx),
h3 AS (SELECT *, (as_of_date IS NULL OR store_code IS NULL OR sku IS NULL OR distribution_status IS NULL) AS is_missing_key,
              COUNT(*) OVER (PARTITION BY load_id, as_of_date, store_code, sku, distribution_status) > 1 AS is_duplicate_candidate FROM h3a),
d4 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY as_of_date, store_code, sku) AS dup_group_size,
         ROW_NUMBER() OVER (PARTITION BY as_of_date, store_code, sku ORDER BY is_missing_key, load_id DESC NULLS LAST,
                            distribution_status DESC NULLS LAST, status_reason DESC NULLS LAST, load_id DESC NULLS LAST,
                            is_missing_key DESC NULLS LAST, is_duplicate_candidate DESC NULLS LAST) AS rn
  FROM h3 WHERE as_of_date IS NOT NULL AND store_code IS NOT NULL AND sku IS NOT NULL) WHERE rn = 1)"""


def status_dedup(t):
    s = staging.stage_distribution_status(raw.distribution_status_extract(t))
    return dedup.one_per_grain(s, ["as_of_date", "store_code", "sku"])


from .oracle import SALES_LINES  # noqa: E402

M15_SQL = f"""
WITH {SALES_LINES}, {H3_CORE}
SELECT as_of_date, store_code, sku, distribution_status, status_reason, load_id, is_missing_key, is_duplicate_candidate,
       dup_group_size FROM d4
"""


@query("m15_distribution_status_daily", M15_SQL)
def q_m15(spark, d):
    return status_dedup(Tables(spark, d))


M12_COLS = ["as_of_date", "store_code", "sku", "distribution_status", "coverage_status", "is_carried", "is_pending",
            "is_not_carried", "is_discontinued", "version_count", "effective_start_date", "effective_end_date",
            "is_current", "is_missing_store_dim", "account_status", "is_active_account", "is_inactive_or_suspended"]

M12_SQL = f"""
WITH {SALES_LINES}, {H3_CORE}, {D3_CORE.replace("sm AS", "sm AS", 1)}, d2 AS ({D2_SQL}),
c AS (
  SELECT d4.*,
         CASE WHEN distribution_status IN ('carried','listed','active','in_distribution','available') THEN 'carried'
              WHEN distribution_status IN ('pending','pending_launch','onboarding') THEN 'pending'
              WHEN distribution_status IN ('not_carried','not_listed','inactive') THEN 'not_carried'
              WHEN distribution_status IN ('discontinued','retired') THEN 'discontinued'
              ELSE distribution_status END AS coverage_status,
         distribution_status IN ('carried','listed','active','in_distribution','available') AS is_carried,
         distribution_status IN ('pending','pending_launch','onboarding') AS is_pending,
         distribution_status IN ('not_carried','not_listed','inactive') AS is_not_carried,
         distribution_status IN ('discontinued','retired') AS is_discontinued,
         COUNT(*) OVER (PARTITION BY store_code, sku) AS version_count, as_of_date AS effective_start_date,
         CAST(LEAD(as_of_date) OVER w - INTERVAL 1 DAY AS DATE) AS effective_end_date,
         LEAD(as_of_date) OVER w IS NULL AS is_current
  FROM d4 WHERE as_of_date IS NOT NULL AND store_code IS NOT NULL AND sku IS NOT NULL
  WINDOW w AS (PARTITION BY store_code, sku ORDER BY as_of_date))
SELECT c.as_of_date, c.store_code, c.sku, c.distribution_status, c.coverage_status, c.is_carried, c.is_pending,
       c.is_not_carried, c.is_discontinued, c.version_count, c.effective_start_date, c.effective_end_date, c.is_current,
       d3.store_code IS NULL AS is_missing_store_dim, d2.account_status,
       lower(d2.account_status) = 'active' AS is_active_account,
       lower(d2.account_status) IN ('inactive', 'suspended') AS is_inactive_or_suspended
FROM c LEFT JOIN d3 ON c.store_code = d3.store_code LEFT JOIN d2 ON c.store_code = d2.store_code
"""


@query("m12_coverage_conformed", M12_SQL)
def q_m12(spark, d):
    t = Tables(spark, d)
    # Only the winning status goes on: neither the duplicate flag nor the columns behind the status decide which one that is.
    staged = staging.stage_distribution_status(raw.distribution_status_extract(t), flag_duplicates=False)
    status = dedup.one_per_grain(staged, ["as_of_date", "store_code", "sku"], count_col=None, columns=["distribution_status"])
    out = history.coverage_conformed(status, stores=latest_master(t), accounts=current_status(t))
    return out.select(*M12_COLS)
