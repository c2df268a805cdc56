"""Further controls: continuity, row-level exceptions, duplicate source records, certification gaps,
exception resolution, upsert (Q8, Q12, Q29, Q34, Q35, Q39, D9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions.clean import hash_key, hash_key_nullsafe, round_to
from ..operators import dedup, dq, staging
from ..operators import emissions as E
from ..session import materialized
from ..sources.testdata import Tables
from . import ghg, model, raw
from .oracle import GHG, INVENTORY, SALES_LINES
from .q_dims import H2_CORE, staged_master
from .q_dq import Q4_SQL, RETAIL_RULES, staged_retail
from .registry import query, rounded
from .q_clean import H8_SQL
from .sql_facts import POS_CTE

Q8_SQL = f"""
WITH {SALES_LINES},
a AS (SELECT DISTINCT store_id, CAST(date_trunc('week', sale_date) AS DATE) AS period_start FROM sales_lines),
s AS (SELECT store_id, min(period_start) AS lo, max(period_start) AS hi, COUNT(*) AS active_periods FROM a GROUP BY 1),
g AS (SELECT store_id, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS period_start FROM s),
m AS (SELECT store_id, COUNT(*) AS missing FROM g
      WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.store_id = g.store_id AND a.period_start = g.period_start) GROUP BY 1)
SELECT s.store_id, lo AS first_period, hi AS last_period, active_periods, COALESCE(missing, 0) AS missing_periods,
       round(CAST(active_periods AS DOUBLE) / (active_periods + COALESCE(missing, 0)), 4) AS continuity_pct
FROM s LEFT JOIN m USING (store_id)
"""


@query("q8_weekly_continuity", Q8_SQL)
def q_q8(spark, d):
    return rounded(dq.continuity(model.sales_lines(Tables(spark, d)), "store_id", "sale_date"))


def _row_exceptions(t):
    sales = raw.sales_distributor_extract(t)
    inv = model.inventory(t)
    pos = raw.pos_transactions(t).filter(F.col("txn_id").isNotNull()).groupBy("txn_id").agg(F.count(F.lit(1)).alias("n"))
    clock = staging.stage_timeclock(raw.timeclock_extract(t), synonyms={**C.ACTION_SYNONYMS, **model.PUNCH_ACTIONS})
    ship = model.shipments(t).withColumn("sku", F.when(F.col("sku") % 97 != 0, F.col("sku").cast("string")).otherwise(F.lit("")))
    key = dq.or_unknown
    return dq.row_exceptions([
        ("missing_store_id", "std.sales_distributor_extract", "error", "store_id is null/blank",
         sales.filter(F.coalesce("store_id_norm", F.lit("")) == ""), key("sku", "sale_date")),
        ("negative_on_hand", "std.inventory_erp_snapshot", "error", "on_hand < 0",
         inv.filter(F.col("on_hand_units") < 0), key("site_id", "sku", "snapshot_date")),
        ("duplicate_txn_id", "std.pos_transactions", "warn", "txn_id appears more than once", pos.filter("n > 1"), F.col("txn_id")),
        ("bad_punch_timestamp", "std.timeclock_punches", "warn", "punch_ts is null after parsing",
         clock.filter(F.col("punch_ts").isNull()), key("employee_id", "store_code")),
        ("missing_sku", "std.wms_shipments", "warn", "sku is null/blank",
         ship.filter(F.coalesce("sku", F.lit("")) == ""), key("shipment_id")),
    ], run_id=1)


def _q(cols):
    return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '?')" for c in cols) + ")"


Q12_CORE = f"""
{SALES_LINES}, {INVENTORY}, {POS_CTE}, tc AS ({H8_SQL}),
ex AS (SELECT 'missing_store_id' AS rule_name, 'std.sales_distributor_extract' AS table_name,
              {_q(['sku', 'CASE WHEN line_number % 2 = 0 THEN sale_date END'])} AS record_key, 'error' AS severity,
              'store_id is null/blank' AS details FROM sales_lines WHERE COALESCE(CAST(store_id AS VARCHAR), '') = ''
       UNION ALL SELECT 'negative_on_hand', 'std.inventory_erp_snapshot', {_q(['site_id', 'sku', 'snapshot_date'])}, 'error',
              'on_hand < 0' FROM inventory WHERE on_hand_units < 0
       UNION ALL SELECT 'duplicate_txn_id', 'std.pos_transactions', txn_id, 'warn', 'txn_id appears more than once'
              FROM pos WHERE txn_id IS NOT NULL GROUP BY txn_id HAVING COUNT(*) > 1
       UNION ALL SELECT 'bad_punch_timestamp', 'std.timeclock_punches', {_q(['employee_id', 'store_code'])}, 'warn',
              'punch_ts is null after parsing' FROM tc WHERE punch_ts IS NULL
       UNION ALL SELECT 'missing_sku', 'std.wms_shipments',
              COALESCE(CASE WHEN l_linenumber <> 1 THEN 'SH' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END, '?'),
              'warn', 'sku is null/blank' FROM lineitem WHERE l_partkey % 97 = 0)"""

Q12_SQL = f"WITH {Q12_CORE} SELECT CAST(1 AS BIGINT) AS run_id, rule_name, table_name, record_key, severity, details FROM ex"
Q12S_SQL = f"WITH {Q12_CORE} SELECT CAST(1 AS BIGINT) AS run_id, table_name, rule_name, COUNT(*) AS exception_count FROM ex GROUP BY 2, 3"


@query("q12_row_exceptions", Q12_SQL)
def q_q12(spark, d):
    return _row_exceptions(Tables(spark, d))


@query("q12_exception_summary", Q12S_SQL)
def q_q12s(spark, d):
    return dq.exception_summary(_row_exceptions(Tables(spark, d)))


def _amount_key(c):
    return round_to(c, 4).cast("decimal(18,4)").cast("string")


Q29_SQL = f"""
WITH {GHG},
c AS (SELECT *, md5(concat_ws('|', COALESCE(source_system, '<null>'), COALESCE(CAST(activity_month AS VARCHAR), '<null>'),
                                COALESCE(facility_id, '<null>'), COALESCE(factor_type, '<null>'),
                                COALESCE(CAST(CAST(round(activity_amount, 4) AS DECIMAL(18,4)) AS VARCHAR), '<null>'),
                                COALESCE(activity_unit, '<null>'))) AS duplicate_business_key FROM act),
g AS (SELECT source_system, duplicate_business_key, COUNT(*) AS duplicate_record_count,
             min(activity_month) AS first_activity_month, max(activity_month) AS last_activity_month,
             SUM(activity_amount) AS duplicate_group_activity_amount, SUM(cost_usd) AS duplicate_group_cost_usd
      FROM c GROUP BY 1, 2 HAVING COUNT(*) > 1),
det AS (SELECT c.source_system, c.duplicate_business_key, g.duplicate_record_count, g.first_activity_month,
               g.last_activity_month, g.duplicate_group_activity_amount, g.duplicate_group_cost_usd, c.source_record_id,
               c.activity_id, c.activity_month, c.facility_id, c.factor_type, c.activity_amount, f.metric_tons_co2e,
               f.is_reportable_emissions_row
        FROM c JOIN g ON c.source_system = g.source_system AND c.duplicate_business_key = g.duplicate_business_key
        LEFT JOIN fact f ON c.source_system = f.source_system AND c.source_record_id = f.source_record_id),
gt AS (SELECT source_system, duplicate_business_key, SUM(metric_tons_co2e) AS duplicate_group_metric_tons_co2e
       FROM det GROUP BY 1, 2)
SELECT det.source_system, det.duplicate_business_key, duplicate_record_count, first_activity_month, last_activity_month,
       round(duplicate_group_activity_amount, 4) AS duplicate_group_activity_amount,
       round(duplicate_group_cost_usd, 4) AS duplicate_group_cost_usd,
       round(duplicate_group_metric_tons_co2e, 4) AS duplicate_group_metric_tons_co2e, source_record_id, activity_id,
       activity_month, facility_id, factor_type, round(activity_amount, 4) AS activity_amount,
       round(metric_tons_co2e, 4) AS metric_tons_co2e, is_reportable_emissions_row
FROM det JOIN gt ON det.source_system = gt.source_system AND det.duplicate_business_key = gt.duplicate_business_key
"""


def duplicate_source_records(t):
    """Q29: duplicate business keys per source (C31 null-safe hash, A10 HAVING), detail rows with group totals joined back
    by key (not a window over a possibly hot group). The emissions fact carries the activity's own columns: it is written once
    and keys, totals and details are read from it; a record id that stands in several fact rows gives a detail row for each."""
    record, keys = ["source_system", "source_record_id"], ["source_system", "__key"]
    own = ["metric_tons_co2e", "is_reportable_emissions_row"]
    fact = materialized(ghg.fact(t).select(
        *record, "activity_month", "facility_id", "factor_type", "activity_amount", "activity_unit", "cost_usd", *own), "emissions_fact")
    # A record that stands once is its own fact row; only the others are met with all rows of their record.
    repeated = materialized(fact.filter(F.col("source_record_id").isNotNull()).groupBy(*record).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum("metric_tons_co2e").alias("__tons")).filter("__rows > 1"), "repeated_records")
    known, more = F.col("source_record_id").isNotNull(), F.col("__rows").isNotNull()
    # The business key moves as 16 bytes; the activity id follows from the record (E1) and is made at the end.
    c = materialized(fact.join(repeated, record, "left").withColumns({
        "__key": F.unhex(hash_key_nullsafe("source_system", "activity_month", "facility_id", "factor_type",
                                           _amount_key(F.col("activity_amount")), "activity_unit")),
        **{x: F.when(known, F.col(x)) for x in own}}), "keyed")
    g = c.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("duplicate_record_count"), F.min("activity_month").alias("first_activity_month"),
        F.max("activity_month").alias("last_activity_month"),
        F.sum("activity_amount").alias("duplicate_group_activity_amount"),
        F.sum("cost_usd").alias("duplicate_group_cost_usd"),
        F.sum(F.when(more, F.col("__tons")).otherwise(F.col("metric_tons_co2e"))).alias("duplicate_group_metric_tons_co2e")) \
        .filter(F.col("duplicate_record_count") > 1)
    det = c.drop("cost_usd", "__tons").join(g, keys)
    if not repeated.isEmpty():
        det = det.filter(~more).unionByName(det.filter(more).drop(*own).join(c.filter(more).select(*record, *own), record))
    return det.select(
        "source_system", F.lower(F.hex("__key")).alias("duplicate_business_key"), "duplicate_record_count", "first_activity_month",
        "last_activity_month", "duplicate_group_activity_amount", "duplicate_group_cost_usd", "duplicate_group_metric_tons_co2e",
        "source_record_id", hash_key(*record).alias("activity_id"), "activity_month", "facility_id", "factor_type", "activity_amount",
        "metric_tons_co2e", "is_reportable_emissions_row")


@query("q29_duplicate_source_records", Q29_SQL)
def q_q29(spark, d):
    return rounded(duplicate_source_records(Tables(spark, d)))


Q32_SQL = f"""
WITH dup AS ({Q29_SQL}), {GHG},
b AS (SELECT COUNT(*) AS total_rows, count(*) FILTER (WHERE NOT is_reportable_emissions_row) AS nr,
             count(*) FILTER (WHERE has_missing_factor_join) AS mf, count(*) FILTER (WHERE has_negative_activity) AS na,
             count(*) FILTER (WHERE has_unknown_activity_type) AS ut,
             count(*) FILTER (WHERE has_missing_facility_join OR has_missing_product_line_join) AS md FROM fact),
a AS (SELECT 'duplicate_source_records' AS control_name, COUNT(*) AS exception_rows FROM dup
      UNION ALL SELECT 'non_reportable_rows', nr FROM b UNION ALL SELECT 'missing_factor_joins', mf FROM b
      UNION ALL SELECT 'negative_activity_rows', na FROM b UNION ALL SELECT 'unknown_activity_type_rows', ut FROM b
      UNION ALL SELECT 'missing_dimension_joins', md FROM b),
th(control_name, warning_row_threshold, warning_pct_threshold, failure_pct_threshold, severity) AS (VALUES
  ('duplicate_source_records', 1, 0.01, 0.1, 'high'), ('non_reportable_rows', 1, 0.05, 0.2, 'high'),
  ('missing_factor_joins', 1, 0.001, 0.05, 'critical'), ('negative_activity_rows', 1, 0.001, 0.05, 'high'),
  ('unknown_activity_type_rows', 1, 0.001, 0.05, 'high'), ('missing_dimension_joins', 1, 0.001, 0.1, 'high')),
s AS (SELECT a.control_name, exception_rows, total_rows, CAST(exception_rows AS DOUBLE) / NULLIF(total_rows, 0) AS pct,
             CAST(warning_row_threshold AS BIGINT) AS warning_row_threshold, CAST(warning_pct_threshold AS DOUBLE) AS warning_pct_threshold,
             CAST(failure_pct_threshold AS DOUBLE) AS failure_pct_threshold, severity
      FROM a, b JOIN th ON a.control_name = th.control_name)
SELECT control_name, exception_rows, total_rows, round(pct, 4) AS exception_pct, warning_row_threshold,
       round(warning_pct_threshold, 4) AS warning_pct_threshold, round(failure_pct_threshold, 4) AS failure_pct_threshold, severity,
       CASE WHEN pct >= failure_pct_threshold THEN 'FAIL' WHEN exception_rows >= warning_row_threshold THEN 'WARN'
            WHEN pct >= warning_pct_threshold THEN 'WARN' ELSE 'PASS' END AS materiality_status
FROM s
"""


@query("q32_emissions_materiality", Q32_SQL)
def q_q32(spark, d):
    t = Tables(spark, d)
    return rounded(E.materiality(ghg.fact(t), duplicate_source_records(t)))


# Fixed certification register (owner sign-off per source system).
CERTIFICATIONS = (
    ("utility_bills", "Facilities / Sustainability", "Certified", "2026-12-31"),
    ("fuel_usage", "Operations / Sustainability", "certified", "2023-12-31"),
    ("shipping_logistics", "Logistics", "pending", "2026-12-31"),
)
CERTIFIED_AS_OF = "2024-03-31"

Q34_SQL = f"""
WITH {GHG},
cert(source_system, owner_team, certification_status, certified_through) AS (VALUES
  ('utility_bills', 'Facilities / Sustainability', 'Certified', DATE '2026-12-31'),
  ('fuel_usage', 'Operations / Sustainability', 'certified', DATE '2023-12-31'),
  ('shipping_logistics', 'Logistics', 'pending', DATE '2026-12-31'))
SELECT source_system, 'missing' AS gap FROM (SELECT DISTINCT source_system FROM fact EXCEPT SELECT source_system FROM cert)
UNION ALL SELECT source_system, CASE WHEN lower(certification_status) <> 'certified' THEN 'not certified' ELSE 'expired' END
FROM cert WHERE lower(certification_status) <> 'certified' OR certified_through < DATE '{CERTIFIED_AS_OF}'
"""


@query("q34_certification_gaps", Q34_SQL)
def q_q34(spark, d):
    cert = spark.createDataFrame(list(CERTIFICATIONS), "source_system string, owner_team string, certification_status string, "
                                 "certified_through string").withColumn("certified_through", F.col("certified_through").cast("date"))
    expected = ghg.fact(Tables(spark, d)).select("source_system").distinct()
    return dq.certification_gaps(expected, cert, "source_system", CERTIFIED_AS_OF)


Q35_SQL = f"""
WITH e AS ({Q4_SQL}),
x AS (SELECT *, md5(concat_ws('|', CAST(rule_id AS VARCHAR), COALESCE(quarter_id, '<null>'), record_key)) AS exception_id FROM e),
log AS (SELECT exception_id, 'resolved' AS resolution_status FROM x WHERE rule_id = 4 AND quarter_id < '1998')
SELECT rule_id, COUNT(*) AS exceptions, count(*) FILTER (WHERE resolution_status = 'resolved') AS resolved,
       count(*) FILTER (WHERE resolution_status IS NULL OR resolution_status <> 'resolved') AS still_open,
       round(CAST(count(*) FILTER (WHERE resolution_status = 'resolved') AS DOUBLE) / COUNT(*), 4) AS resolution_rate
FROM x LEFT JOIN log USING (exception_id) GROUP BY 1
"""


@query("q35_exception_resolution", Q35_SQL)
def q_q35(spark, d):
    """Q35: exception hash ids (C30) vs a resolution log; the log here marks pre-1998 negative-unit
    exceptions as resolved (derived from the data)."""
    # The rules read the staged text once parsed; the exceptions are found once, for themselves and for the log.
    exc = dq.exceptions(materialized(staged_retail(Tables(spark, d)), "staged_retail"), RETAIL_RULES, run_id=1)
    exc = materialized(exc.select("rule_id", "quarter_id", hash_key(
        F.col("rule_id").cast("string"), F.coalesce("quarter_id", F.lit("<null>")), F.col("record_key")).alias("exception_id")), "exceptions")
    log = exc.filter((F.col("rule_id") == 4) & (F.col("quarter_id") < "1998")) \
        .select("exception_id", F.lit("resolved").alias("resolution_status"))
    return rounded(dq.resolution_status(exc, log))


CUT = "1998-12-31"
_UP_COLS = ["store_code", "as_of_date", "dispensary_name", "state", "postal_code"]
_H2P = ["as_of_date", "drop_date", "dispensary_id", "dispensary_name", "state", "city", "postal_code", "license_id", "account_type",
        "is_missing_key", "is_bad_state_code", "is_bad_postal_code", "is_duplicate_candidate"]

Q39_SQL = f"""
WITH {H2_CORE},
old AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_code ORDER BY
          as_of_date DESC NULLS LAST, is_missing_key, (dispensary_id IS NOT NULL) DESC, (dispensary_name IS NOT NULL) DESC,
          drop_date DESC NULLS LAST,
          {", ".join(c + " DESC NULLS LAST" for c in _H2P)}) AS rn
        FROM h2 WHERE store_code IS NOT NULL AND as_of_date <= DATE '{CUT}') WHERE rn = 1),
upd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY store_code ORDER BY as_of_date DESC NULLS LAST,
          {", ".join(c + " DESC NULLS LAST" for c in _H2P)}) AS rn
        FROM h2 WHERE store_code IS NOT NULL AND as_of_date > DATE '{CUT}') WHERE rn = 1)
SELECT {", ".join(_UP_COLS)} FROM old WHERE store_code NOT IN (SELECT store_code FROM upd)
UNION ALL SELECT {", ".join(_UP_COLS)} FROM upd
"""


@query("q39_upsert_store_master", Q39_SQL)
def q_q39(spark, d):
    """Current master (latest complete as of the cut-off) upserted with the last-wins
    newer snapshots (anti join + union)."""
    s = staged_master(Tables(spark, d)).filter(F.col("store_code").isNotNull())
    old = dedup.latest_complete(s.filter(F.col("as_of_date") <= F.lit(CUT).cast("date")), ["store_code"],
                                ["dispensary_id", "dispensary_name"], F.col("as_of_date"))
    upd = dedup.last_wins(s.filter(F.col("as_of_date") > F.lit(CUT).cast("date")), ["store_code"], "as_of_date")
    return dq.upsert(old.select(*_UP_COLS), upd.select(*_UP_COLS), ["store_code"])
