"""Data-quality queries (Q1–Q15, Q40) on the quarterly retail extract and staged sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.clean import ratio
from ..operators import dedup, dq, recon, staging
from ..session import materialized
from ..sources.testdata import Tables
from . import model, raw
from .oracle import RETAIL_QUARTERLY, SALES_LINES
from .q_clean import H4_SQL
from .registry import query, rounded

KEYS = ("quarter_id", "week_end_date", "dispensary_account_id", "sku_id")
TABLE = "stg.retail_account_sales_quarterly"

# Fixed rule catalogue for the retail quarterly extract.
RETAIL_RULES = (
    dq.Rule(1, "Required key present - retail sales", "completeness", TABLE, "required", cols=KEYS,
            severity="critical", owner_team="Sales Operations", record_key_cols=KEYS),
    dq.Rule(2, "Unique retail grain", "uniqueness", TABLE, "unique",
            cols=("week_end_date", "dispensary_account_id", "sku_id"), severity="high",
            owner_team="Sales Operations", record_key_cols=KEYS),
    dq.Rule(3, "Week end date within quarter", "validity", TABLE, "predicate",
            fail_when="week_end_date IS NOT NULL AND quarter_id IS NOT NULL AND "
                      "concat(year(week_end_date), 'Q', quarter(week_end_date)) <> quarter_id",
            issue="week_end_date outside quarter", severity="medium", owner_team="Sales Operations",
            record_key_cols=KEYS),
    dq.Rule(4, "Non-negative units sold", "validity", TABLE, "predicate", fail_when="units_sold < 0",
            issue="negative units_sold", severity="high", owner_team="Sales Operations", record_key_cols=KEYS),
    dq.Rule(5, "Net sales not above gross", "validity", TABLE, "predicate",
            fail_when="net_sales > gross_sales + 0.01", issue="net above gross", severity="medium",
            owner_team="Finance", record_key_cols=KEYS),
    dq.Rule(6, "Negative rows need a week end date", "completeness", TABLE, "predicate",
            fail_when="units_sold < 0 AND week_end_date IS NULL", issue="negative row without week_end_date",
            severity="low", owner_team="Sales Operations", record_key_cols=KEYS),
)


def staged_retail(t):
    return staging.stage_text_casts(raw.retail_quarterly_extract(t), raw.RETAIL_QUARTERLY_TYPES)


_R3 = "week_end_date IS NOT NULL AND quarter_id IS NOT NULL AND concat(CAST(year(week_end_date) AS VARCHAR), 'Q', CAST(quarter(week_end_date) AS VARCHAR)) <> quarter_id"
_R1 = "quarter_id IS NULL OR week_end_date IS NULL OR dispensary_account_id IS NULL OR sku_id IS NULL"
_META = """meta(rule_id, rule_name, rule_category, target_table, severity) AS (VALUES
  (1, 'Required key present - retail sales', 'completeness', 'stg.retail_account_sales_quarterly', 'critical'),
  (2, 'Unique retail grain', 'uniqueness', 'stg.retail_account_sales_quarterly', 'high'),
  (3, 'Week end date within quarter', 'validity', 'stg.retail_account_sales_quarterly', 'medium'),
  (4, 'Non-negative units sold', 'validity', 'stg.retail_account_sales_quarterly', 'high'),
  (5, 'Net sales not above gross', 'validity', 'stg.retail_account_sales_quarterly', 'medium'),
  (6, 'Negative rows need a week end date', 'completeness', 'stg.retail_account_sales_quarterly', 'low'))"""

RESULTS_CORE = f"""
WITH {RETAIL_QUARTERLY},
rr AS (SELECT quarter_id, COUNT(*) AS checked,
              count(*) FILTER (WHERE {_R1}) AS f1,
              count(*) FILTER (WHERE COALESCE({_R3}, FALSE)) AS f3,
              count(*) FILTER (WHERE COALESCE(units_sold < 0, FALSE)) AS f4,
              count(*) FILTER (WHERE COALESCE(net_sales > gross_sales + 0.01, FALSE)) AS f5,
              count(*) FILTER (WHERE COALESCE(units_sold < 0 AND week_end_date IS NULL, FALSE)) AS f6
       FROM rq GROUP BY quarter_id),
u AS (SELECT quarter_id, SUM(n) AS checked, count(*) FILTER (WHERE n > 1) AS f
      FROM (SELECT quarter_id, week_end_date, dispensary_account_id, sku_id, COUNT(*) AS n FROM rq GROUP BY ALL)
      GROUP BY quarter_id),
res AS (SELECT quarter_id, 1 AS rule_id, checked, f1 AS failed FROM rr UNION ALL
        SELECT quarter_id, 3, checked, f3 FROM rr UNION ALL SELECT quarter_id, 4, checked, f4 FROM rr UNION ALL
        SELECT quarter_id, 5, checked, f5 FROM rr UNION ALL SELECT quarter_id, 6, checked, f6 FROM rr UNION ALL
        SELECT quarter_id, 2, checked, f FROM u),
{_META}
SELECT CAST(1 AS BIGINT) AS run_id, quarter_id, CAST(rule_id AS BIGINT) AS rule_id, rule_name, rule_category,
       target_table, CAST(checked AS BIGINT) AS checked_count, CAST(failed AS BIGINT) AS failed_count,
       CASE WHEN checked = 0 THEN 0.0 ELSE CAST(failed AS DOUBLE) / checked END AS failed_pct, severity,
       CASE WHEN failed > 0 THEN 'fail' ELSE 'pass' END AS status
FROM res JOIN meta USING (rule_id)
"""

Q3_SQL = f"""
SELECT run_id, quarter_id, rule_id, rule_name, rule_category, target_table, checked_count, failed_count,
       round(failed_pct, 4) AS failed_pct, severity, status
FROM ({RESULTS_CORE})
"""


def rule_results(t):
    return dq.evaluate_rules(staged_retail(t), RETAIL_RULES, run_id=1, by=["quarter_id"])


@query("q3_dq_rule_results", Q3_SQL)
def q_q3(spark, d):
    return rounded(rule_results(Tables(spark, d)))


_RK = ("concat_ws('|', COALESCE(quarter_id, 'MISSING'), COALESCE(CAST(week_end_date AS VARCHAR), 'MISSING'), "
       "COALESCE(dispensary_account_id, 'MISSING'), COALESCE(sku_id, 'MISSING'))")


def _exc(rule_id, name, team, where, issue):
    return (f"SELECT quarter_id, {rule_id} AS rule_id, {_RK} AS record_key, {issue} AS issue_value, "
            f"'{name}' AS issue_description, '{team}' AS assigned_team FROM rq WHERE COALESCE({where}, FALSE)")


Q4_SQL = f"""
WITH {RETAIL_QUARTERLY},
e AS (
  {_exc(1, 'Required key present - retail sales', 'Sales Operations', _R1,
        "COALESCE(CASE WHEN quarter_id IS NULL THEN 'quarter_id is null' END, "
        "CASE WHEN week_end_date IS NULL THEN 'week_end_date is null' END, "
        "CASE WHEN dispensary_account_id IS NULL THEN 'dispensary_account_id is null' END, "
        "CASE WHEN sku_id IS NULL THEN 'sku_id is null' END)")}
  UNION ALL
  SELECT quarter_id, 2, concat_ws('|', COALESCE(CAST(week_end_date AS VARCHAR), 'MISSING'),
         COALESCE(dispensary_account_id, 'MISSING'), COALESCE(sku_id, 'MISSING')),
         'duplicate count = ' || CAST(COUNT(*) AS VARCHAR), 'Unique retail grain', 'Sales Operations'
  FROM rq GROUP BY quarter_id, week_end_date, dispensary_account_id, sku_id HAVING COUNT(*) > 1
  UNION ALL
  {_exc(3, 'Week end date within quarter', 'Sales Operations', _R3, "'week_end_date outside quarter'")}
  UNION ALL
  {_exc(4, 'Non-negative units sold', 'Sales Operations', 'units_sold < 0', "'negative units_sold'")}
  UNION ALL
  {_exc(5, 'Net sales not above gross', 'Finance', 'net_sales > gross_sales + 0.01', "'net above gross'")}
  UNION ALL
  {_exc(6, 'Negative rows need a week end date', 'Sales Operations', 'units_sold < 0 AND week_end_date IS NULL',
        "'negative row without week_end_date'")}
)
SELECT CAST(1 AS BIGINT) AS run_id, quarter_id, CAST(rule_id AS BIGINT) AS rule_id,
       'stg.retail_account_sales_quarterly' AS target_table, record_key, issue_value, issue_description,
       assigned_team, 'open' AS remediation_status
FROM e
"""


@query("q4_dq_exceptions", Q4_SQL)
def q_q4(spark, d):
    return dq.exceptions(staged_retail(Tables(spark, d)), RETAIL_RULES, run_id=1)


def ledger_quarterly(t):
    lg = model.ledger(t)
    return lg.select(F.concat(F.year("posting_date").cast("string"), F.lit("Q"),
                              F.quarter("posting_date").cast("string")).alias("quarter_id"), "amount")


def sales_finance_recon(t, staged=None):
    s = (staged or staged_retail(t)).filter(F.col("quarter_id").isNotNull())
    return recon.reconcile_totals(s, ledger_quarterly(t), ["quarter_id"], "net_sales", "amount",
                                  rel_tol=0.02, run_id=1)


RECON_CORE = f"""
WITH {RETAIL_QUARTERLY},
s AS (SELECT quarter_id, SUM(net_sales) AS source_amount FROM rq WHERE quarter_id IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_id,
             SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS target_amount FROM orders GROUP BY 1),
j AS (SELECT COALESCE(s.quarter_id, t.quarter_id) AS quarter_id, source_amount, target_amount,
             COALESCE(source_amount, 0) AS sa, COALESCE(target_amount, 0) AS ta
      FROM s FULL OUTER JOIN t ON s.quarter_id = t.quarter_id),
k AS (SELECT *, CASE WHEN ta <> 0 THEN abs(sa - ta) / abs(ta) END AS rel FROM j)
SELECT quarter_id, source_amount, target_amount, sa - ta AS difference_amount, rel AS difference_pct,
       CASE WHEN COALESCE(rel > 0.02, TRUE) THEN 'fail' ELSE 'pass' END AS recon_status, CAST(1 AS BIGINT) AS run_id
FROM k
"""

Q9_SQL = f"""
SELECT quarter_id, round(source_amount, 4) AS source_amount, round(target_amount, 4) AS target_amount,
       round(difference_amount, 4) AS difference_amount, round(difference_pct, 4) AS difference_pct, recon_status, run_id
FROM ({RECON_CORE})
"""


@query("q9_sales_finance_recon", Q9_SQL)
def q_q9(spark, d):
    return rounded(sales_finance_recon(Tables(spark, d)))


def run_log(t):
    """Two runs per ledger quarter; the second run of a fourth quarter has not ended."""
    q = ledger_quarterly(t).select("quarter_id").distinct()
    runs = q.withColumn("run_id", F.explode(F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint"))))
    return runs.withColumns({
        "run_status": F.when((F.col("run_id") == 2) & F.col("quarter_id").endswith("Q4"), F.lit("started")).otherwise(F.lit("completed")),
        "run_ts": F.when(F.col("run_id") == 2, F.lit("2024-04-02 06:00:00")).otherwise(F.lit("2024-04-01 06:00:00")).cast("timestamp_ntz")})


def governed_recon(t, staged=None):
    """Reconciliation results as logged: third quarters were reconciled in the first run only."""
    r = sales_finance_recon(t, staged).drop("run_id").withColumnRenamed("recon_status", "status")
    return r.withColumn("run_id", F.when(F.col("quarter_id").endswith("Q3"), 1).otherwise(2).cast("bigint"))


def governed_exceptions(t, staged=None, log=None):
    exc = dq.exceptions(staged or staged_retail(t), RETAIL_RULES, run_id=2)
    return dq.open_exceptions(exc, dq.rules_df(t.spark, RETAIL_RULES), log or run_log(t))


RUN_LOG_CTE = """
runs AS (SELECT quarter_id, run_id, CASE WHEN run_id = 2 AND quarter_id LIKE '%Q4' THEN 'started' ELSE 'completed' END AS run_status,
                CASE WHEN run_id = 2 THEN TIMESTAMP '2024-04-02 06:00:00' ELSE TIMESTAMP '2024-04-01 06:00:00' END AS run_ts
         FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_id FROM orders),
              (SELECT CAST(unnest([1, 2]) AS BIGINT) AS run_id)),
latest AS (SELECT quarter_id, max(run_id) AS run_id FROM runs GROUP BY 1)"""

OPEN_CORE = f"""
WITH e AS ({Q4_SQL}), {RUN_LOG_CTE}, {_META},
owner(rule_id, owner_team) AS (VALUES (1, 'Sales Operations'), (2, 'Sales Operations'), (3, 'Sales Operations'),
  (4, 'Sales Operations'), (5, 'Finance'), (6, 'Sales Operations'))
SELECT latest.run_id, e.quarter_id, e.rule_id, rule_name, rule_category, severity, owner_team, e.target_table, record_key,
       issue_value, issue_description, assigned_team, remediation_status
FROM e JOIN meta ON meta.rule_id = e.rule_id JOIN owner ON owner.rule_id = e.rule_id
JOIN latest ON latest.quarter_id = e.quarter_id AND latest.run_id = 2
WHERE remediation_status = 'open'
"""


@query("q10_open_exceptions", OPEN_CORE)
def q_q10_open(spark, d):
    return governed_exceptions(Tables(spark, d))


RECON_LATEST = f"""
WITH rec AS (SELECT *, CAST(CASE WHEN quarter_id LIKE '%Q3' THEN 1 ELSE 2 END AS BIGINT) AS own_run FROM ({RECON_CORE})), {RUN_LOG_CTE}
SELECT rec.quarter_id, own_run AS run_id, source_amount, target_amount, difference_amount, difference_pct, recon_status AS status
FROM rec JOIN latest ON rec.quarter_id = latest.quarter_id AND own_run = latest.run_id
"""

Q10R_SQL = f"""
SELECT quarter_id, run_id, round(source_amount, 4) AS source_amount, round(target_amount, 4) AS target_amount,
       round(difference_amount, 4) AS difference_amount, round(difference_pct, 4) AS difference_pct, status FROM ({RECON_LATEST})
"""


@query("q10_reconciliation_summary", Q10R_SQL)
def q_q10_recon(spark, d):
    t = Tables(spark, d)
    return rounded(dq.reconciliation_summary(governed_recon(t), run_log(t)))


Q11_SQL = f"""
WITH {RUN_LOG_CTE}, oe AS ({OPEN_CORE}), rc AS ({RECON_LATEST}),
x AS (SELECT quarter_id, run_id, count(*) AS n, count(*) FILTER (WHERE severity = 'critical') AS c FROM oe GROUP BY 1, 2),
r AS (SELECT quarter_id, run_id, CASE max(CASE status WHEN 'fail' THEN 3 WHEN 'warn' THEN 2 ELSE 1 END)
             WHEN 3 THEN 'fail' WHEN 2 THEN 'warn' ELSE 'pass' END AS status FROM rc GROUP BY 1, 2),
g AS (SELECT runs.quarter_id, runs.run_id, run_status, run_ts, COALESCE(n, 0) AS open_exception_count,
             COALESCE(c, 0) AS open_critical_exception_count, COALESCE(r.status, 'not_run') AS reconciliation_status
      FROM runs JOIN latest ON runs.quarter_id = latest.quarter_id AND runs.run_id = latest.run_id
      LEFT JOIN x ON x.quarter_id = runs.quarter_id AND x.run_id = runs.run_id
      LEFT JOIN r ON r.quarter_id = runs.quarter_id AND r.run_id = runs.run_id)
SELECT *, CASE WHEN run_status <> 'completed' OR reconciliation_status <> 'pass' OR open_critical_exception_count > 0
               THEN 'hold' ELSE 'certified' END AS certification_status,
       CASE WHEN run_status <> 'completed' THEN 'latest dq run not completed'
            WHEN reconciliation_status <> 'pass' THEN 'reconciliation failed or not run'
            WHEN open_critical_exception_count > 0 THEN 'open critical exceptions remain'
            ELSE 'ready for reporting' END AS certification_reason
FROM g
"""


@query("q11_certification", Q11_SQL)
def q_q11(spark, d):
    t = Tables(spark, d)
    # Rules and reconciliation read one staged table; the run log has two rows a quarter.
    staged, log = materialized(staged_retail(t), "staged_retail"), materialized(run_log(t), "run_log")
    return dq.certify(log, governed_exceptions(t, staged, log), dq.reconciliation_summary(governed_recon(t, staged), log))


THRESHOLDS = {"is_missing_key": (0.10, None), "is_duplicate_candidate": (0.05, 0.01),
              "is_bad_amount": (0.03, None), "is_bad_state_code": (0.01, None)}

Q13_SQL = f"""
WITH h4 AS ({H4_SQL}),
c AS (SELECT COUNT(*) AS row_count, count(*) FILTER (WHERE is_missing_key) AS m,
             count(*) FILTER (WHERE is_duplicate_candidate) AS d, count(*) FILTER (WHERE is_bad_amount) AS b FROM h4),
th(check_column, fail_rate, warn_rate, ex) AS (VALUES ('is_missing_key', 0.10, NULL, TRUE),
   ('is_duplicate_candidate', 0.05, 0.01, TRUE), ('is_bad_amount', 0.03, NULL, TRUE),
   ('is_bad_state_code', 0.01, NULL, FALSE)),
l AS (SELECT 'is_missing_key' AS check_column, row_count, m AS flagged_rows FROM c UNION ALL
      SELECT 'is_duplicate_candidate', row_count, d FROM c UNION ALL SELECT 'is_bad_amount', row_count, b FROM c),
j AS (SELECT th.check_column, CAST(fail_rate AS DOUBLE) AS fail_rate, CAST(warn_rate AS DOUBLE) AS warn_rate, ex,
             row_count, flagged_rows, CAST(flagged_rows AS DOUBLE) / NULLIF(row_count, 0) AS rate
      FROM th LEFT JOIN l ON th.check_column = l.check_column)
SELECT 'stg.sales_distributor' AS table_name, check_column, CAST(row_count AS BIGINT) AS row_count,
       CAST(flagged_rows AS BIGINT) AS flagged_rows, round(rate, 4) AS flagged_rate,
       round(fail_rate, 4) AS fail_rate, round(warn_rate, 4) AS warn_rate,
       CASE WHEN NOT ex THEN 'SKIPPED' WHEN row_count = 0 THEN 'FAIL' WHEN rate > fail_rate THEN 'FAIL'
            WHEN warn_rate IS NOT NULL AND rate > warn_rate THEN 'WARN' ELSE 'PASS' END AS status
FROM j
"""


@query("q13_threshold_rate_checks", Q13_SQL)
def q_q13(spark, d):
    staged = staging.stage_sales_distributor(raw.sales_distributor_extract(Tables(spark, d)))
    return rounded(dq.threshold_rate_checks(staged, "stg.sales_distributor", THRESHOLDS))


_LP = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
       "l_linestatus", "l_shipdate"]

Q14_SQL = f"""
WITH best AS (
  SELECT * FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS dup_group_size,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY (l_linestatus = 'F') DESC NULLS LAST,
                              l_shipdate DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in _LP)}) AS rn
    FROM lineitem) WHERE rn = 1),
c AS (SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS c0, count(*) FILTER (WHERE l_partkey IS NULL) AS c1,
             count(*) FILTER (WHERE COALESCE(l_discount < 0 OR l_discount > 0.1, FALSE)) AS c2,
             count(*) FILTER (WHERE COALESCE(l_quantity < 1 OR l_quantity > 50, FALSE)) AS c3,
             count(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R')) AS c4,
             count(*) FILTER (WHERE l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O', 'F')) AS c5,
             count(*) FILTER (WHERE COALESCE(dup_group_size > 1, FALSE)) AS c6 FROM best),
u AS (SELECT count(*) FILTER (WHERE n > 1) AS f FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM best GROUP BY ALL)),
r AS (SELECT 'non_empty' AS check_name, c0 AS failed_count, 'error' AS severity FROM c UNION ALL
      SELECT 'not_null:l_partkey', c1, 'error' FROM c UNION ALL SELECT 'range:l_discount', c2, 'error' FROM c UNION ALL
      SELECT 'range:l_quantity', c3, 'error' FROM c UNION ALL SELECT 'vocab:l_returnflag', c4, 'error' FROM c UNION ALL
      SELECT 'vocab:l_linestatus', c5, 'error' FROM c UNION ALL SELECT 'notice:dup_groups', c6, 'notice' FROM c UNION ALL
      SELECT 'unique_grain:l_orderkey,l_linenumber', f, 'error' FROM u)
SELECT 'int.lineitem_dedup' AS relation, check_name, CAST(failed_count AS BIGINT) AS failed_count, severity,
       CASE WHEN severity = 'notice' THEN 'NOTICE' WHEN failed_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM r
"""


@query("q14_contract_checks", Q14_SQL)
def q_q14(spark, d):
    li = Tables(spark, d).lineitem
    best = dedup.keep_best(li, ["l_orderkey", "l_linenumber"],
                           [(F.col("l_linestatus") == "F", "desc"), ("l_shipdate", "desc")])
    return dq.contract_checks(best, "int.lineitem_dedup", grain=["l_orderkey", "l_linenumber"],
                              not_null=["l_partkey"], ranges={"l_discount": (0, 0.1), "l_quantity": (1, 50)},
                              vocab={"l_returnflag": ["A", "N", "R"], "l_linestatus": ["O", "F"]},
                              notices={"dup_groups": "dup_group_size > 1"})


_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_NONKEY = [c for c in _ALL if c not in ("l_orderkey", "l_linenumber")]

Q15_SQL = f"""
WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS dup_count FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1)
SELECT * FROM (
  SELECT l.*, g.dup_count,
         CAST(ROW_NUMBER() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
                                 ORDER BY {", ".join("l." + c + " DESC NULLS LAST" for c in _NONKEY)}) AS INTEGER) AS sample_rank
  FROM lineitem l JOIN g ON l.l_orderkey = g.l_orderkey AND l.l_linenumber = g.l_linenumber
) WHERE sample_rank <= 2
"""


@query("q15_duplicate_triage", Q15_SQL)
def q_q15(spark, d):
    return dq.duplicate_triage(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"], sample_per_key=2)


Q40_SQL = f"""
WITH {SALES_LINES},
f AS (SELECT units, list_price AS unit_list_price, net_sales / NULLIF(units, 0) AS unit_net_price, gross_sales,
             net_sales, discount_amount, discount_amount / NULLIF(gross_sales, 0) AS discount_rate FROM sales_lines),
c AS (SELECT COUNT(*) AS rows_checked,
             count(*) FILTER (WHERE COALESCE(abs(gross_sales - units * unit_list_price) > 0.01, FALSE)) AS a,
             count(*) FILTER (WHERE COALESCE(abs(net_sales - units * unit_net_price) > 0.01, FALSE)) AS b,
             count(*) FILTER (WHERE COALESCE(abs(discount_amount - (gross_sales - net_sales)) > 0.01, FALSE)) AS c,
             count(*) FILTER (WHERE COALESCE(discount_rate < 0 OR discount_rate > 1, FALSE)) AS d,
             count(*) FILTER (WHERE COALESCE(units < 0, FALSE)) AS e FROM f),
r AS (SELECT rows_checked, 'gross_eq_units_x_list' AS check_name, a AS failed_rows FROM c UNION ALL
      SELECT rows_checked, 'net_eq_units_x_net_price', b FROM c UNION ALL
      SELECT rows_checked, 'discount_eq_gross_minus_net', c FROM c UNION ALL
      SELECT rows_checked, 'discount_rate_in_0_1', d FROM c UNION ALL SELECT rows_checked, 'units_non_negative', e FROM c)
SELECT rows_checked, check_name, failed_rows, CASE WHEN failed_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM r
"""


@query("q40_formula_integrity", Q40_SQL)
def q_q40(spark, d):
    s = model.sales_lines(Tables(spark, d))
    f = s.select("units", F.col("list_price").alias("unit_list_price"),
                 ratio("net_sales", "units").alias("unit_net_price"), "gross_sales", "net_sales", "discount_amount",
                 ratio("discount_amount", "gross_sales").alias("discount_rate"))
    return dq.formula_integrity(f)


Q10_SQL = f"""
SELECT quarter_id, rule_id, rule_name, rule_category, target_table, checked_count, failed_count,
       round(failed_pct, 4) AS failed_pct, severity, status, CAST(2 AS BIGINT) AS run_id
FROM ({RESULTS_CORE})
"""


@query("q10_scorecard_latest_run", Q10_SQL)
def q_q10(spark, d):
    """Two governed runs are logged and their results appended to an audit table;
    the scorecard reads the latest run per quarter (group max joined back)."""
    import uuid
    from ..session import checkpoint_dir
    root = f"{checkpoint_dir(spark).rstrip('/')}/shelfwise-dq/{uuid.uuid4().hex}"
    log, res = f"{root}/run_log", f"{root}/results"
    t = Tables(spark, d)
    # Both runs read one staged table.
    staged = materialized(staged_retail(t), "staged_retail")
    for _ in range(2):
        run_id = dq.open_run(spark, log, "ALL", "scheduled", "retail_quarterly", "v1")
        r = dq.evaluate_rules(staged, RETAIL_RULES, run_id=run_id, by=["quarter_id"]).drop("run_id")
        dq.append_results(r, res, run_id)
        dq.close_run(spark, log, run_id)
    done = dq.run_status(spark, log).filter(F.col("run_status") == "completed").select("run_id")
    results = spark.read.parquet(res).withColumn("run_id", F.col("run_id").cast("bigint")).join(done, "run_id", "left_semi")
    return rounded(dq.scorecard(results).select("quarter_id", "rule_id", "rule_name", "rule_category", "target_table",
                                                "checked_count", "failed_count", "failed_pct", "severity", "status",
                                                "run_id"))
