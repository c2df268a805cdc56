"""Finance / payroll staging, boolean-matrix pivot and intake log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, dq, history, staging
from ..sources.testdata import Tables
from . import model, raw
from .oracle import SALES_LINES
from .q_history import PAIRS_CTE
from .registry import query, rounded
from .sql_facts import FIN_CTE

H10_SQL = f"""
WITH {FIN_CTE}
SELECT period_month, metric_name, round(actual_amount, 4) AS actual_amount, 'USD' AS currency_code,
       CAST(NULL AS VARCHAR) AS store_code, kpi_category, kpi_category = 'unknown' AS is_unmapped_metric,
       (period_month IS NULL OR metric_name IS NULL) AS is_missing_key
FROM k
"""


@query("h10_stage_finance_actuals", H10_SQL)
def q_h10(spark, d):
    return rounded(staging.stage_finance_actuals(raw.finance_actuals_extract(Tables(spark, d))))


# Fixed payroll department / team wording by employee (exercises synonyms and canon).
DEPARTMENTS = ("Fulfilment", "retail ", "OPS")


def payroll_extract(t):
    """H9 input: weekly payroll export per store / department / team from paired punches."""
    daily = history.labor_daily_employee(model.punches(t))
    dept = F.element_at(F.array(*[F.lit(x) for x in DEPARTMENTS]), (F.col("employee_id") % 3 + 1).cast("int"))
    k = F.col("employee_id") % 4
    team = F.when(k == 0, F.lit(" Team A")).when(k == 1, F.lit(" Fulfilment")).otherwise(F.lit("team b"))
    w = daily.withColumns({"week_ending": F.date_add(F.date_trunc("week", "work_date").cast("date"), 6),
                           "department": dept, "team": team})
    g = w.groupBy("week_ending", "store_code", "department", "team").agg(
        F.sum("hours_worked").alias("hours"), F.count_distinct("employee_id").alias("employees"))
    return g.select(F.date_format("week_ending", "MM/dd/yyyy").alias("week_ending_raw"),
                    F.col("store_code").alias("site_code_norm"), F.col("department").alias("department_norm"),
                    F.col("team").alias("team_norm"), raw._txt(F.col("hours"), 2).alias("hours_worked_raw"),
                    raw._txt(F.greatest(F.col("hours") - 40.0, F.lit(0.0)), 2).alias("ot_hours_raw"),
                    raw._txt(F.col("hours") * model.LABOR_RATE_PER_HOUR, 2).alias("labor_cost_raw"),
                    F.col("employees").cast("string").alias("employee_count_raw"))


H9_SQL = f"""
WITH {PAIRS_CTE},
daily AS (SELECT work_date, store_code, employee_id, SUM(minutes_worked) / 60.0 AS hours_worked FROM pm
          GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE is_pair) > 0),
w AS (SELECT *, CAST(date_trunc('week', work_date) + INTERVAL 6 DAY AS DATE) AS week_ending,
             CASE employee_id % 3 WHEN 0 THEN 'Fulfilment' WHEN 1 THEN 'retail ' ELSE 'OPS' END AS department,
             CASE employee_id % 4 WHEN 0 THEN ' Team A' WHEN 1 THEN ' Fulfilment' ELSE 'team b' END AS team FROM daily),
g AS (SELECT week_ending, store_code, department, team, SUM(hours_worked) AS hours, COUNT(DISTINCT employee_id) AS employees
      FROM w GROUP BY 1, 2, 3, 4),
x AS (SELECT strftime(week_ending, '%m/%d/%Y') AS week_ending_raw, store_code AS site_code_norm,
             department AS department_norm, team AS team_norm,
             CAST(CAST(round(hours, 2) AS DECIMAL(18,2)) AS VARCHAR) AS hours_worked_raw,
             CAST(CAST(round(greatest(hours - 40.0, 0.0), 2) AS DECIMAL(18,2)) AS VARCHAR) AS ot_hours_raw,
             CAST(CAST(round(hours * 20.0, 2) AS DECIMAL(18,2)) AS VARCHAR) AS labor_cost_raw,
             CAST(employees AS VARCHAR) AS employee_count_raw FROM g)
SELECT CASE WHEN regexp_matches(trim(week_ending_raw), '^\\d{{2}}/\\d{{2}}/\\d{{4}}$')
            THEN CAST(try_strptime(trim(week_ending_raw), '%m/%d/%Y') AS DATE) END AS week_ending,
       NULLIF(trim(site_code_norm), '') AS site_code,
       lower(NULLIF(trim(department_norm), '')) AS department,
       COALESCE(CASE lower(NULLIF(trim(team_norm), '')) WHEN 'fulfilment' THEN 'fulfillment' END,
                lower(NULLIF(trim(team_norm), ''))) AS team,
       round(TRY_CAST(NULLIF(regexp_replace(trim(hours_worked_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4)), 4) AS hours_worked,
       round(TRY_CAST(NULLIF(regexp_replace(trim(ot_hours_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4)), 4) AS ot_hours,
       round(TRY_CAST(NULLIF(regexp_replace(trim(labor_cost_raw), '[^0-9.\\-]+', '', 'g'), '') AS DECIMAL(18,4)), 4) AS labor_cost,
       TRY_CAST(NULLIF(regexp_replace(trim(employee_count_raw), '[^0-9\\-]+', '', 'g'), '') AS INTEGER) AS employee_count,
       (NULLIF(trim(department_norm), '') IS NULL OR NULLIF(trim(team_norm), '') IS NULL) AS is_missing_department_or_team
FROM x
"""


@query("h9_stage_labor_payroll", H9_SQL)
def q_h9(spark, d):
    return rounded(staging.stage_labor_payroll(payroll_extract(Tables(spark, d))))


# Fixed category list of the test part table (column order of the matrix).
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

A12_SQL = f"""
WITH {SALES_LINES}
SELECT state, {", ".join(f"COALESCE(bool_or(category = '{c}'), FALSE) AS {c}" for c in CATEGORIES)}
FROM sales_lines WHERE units > 10 GROUP BY 1
"""


@query("a12_state_category_matrix", A12_SQL)
def q_a12(spark, d):
    """Which categories each state sells in lines above 10 units (boolean-matrix pivot)."""
    s = model.sales_lines(Tables(spark, d)).filter(F.col("units") > 10)
    return aggregates.bool_matrix(s, "state", "category", CATEGORIES)


Q37_SQL = f"""
WITH {SALES_LINES},
q AS (SELECT CAST(year(sale_date) AS VARCHAR) || 'Q' || CAST(quarter(sale_date) AS VARCHAR) AS quarter_id,
             max(sale_date) AS last_sale, CAST(date_trunc('quarter', max(sale_date)) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qend
      FROM sales_lines GROUP BY 1),
e AS (SELECT quarter_id, src AS source_name, CAST(qend + INTERVAL 10 DAY AS DATE) AS due_date, last_sale, qend
      FROM q, (VALUES ('retail_sales'), ('finance_actuals'), ('trade_adjustments')) s(src)),
r AS (SELECT quarter_id, 'retail_sales' AS source_name, CAST(last_sale + INTERVAL 3 DAY AS DATE) AS received_date FROM q
      UNION ALL SELECT quarter_id, 'finance_actuals', CAST(qend + INTERVAL 12 DAY AS DATE) FROM q)
SELECT e.quarter_id, e.source_name, due_date, received_date,
       CASE WHEN received_date IS NULL THEN 'missing' WHEN received_date <= due_date THEN 'on_time' ELSE 'late' END
         AS submission_status
FROM e LEFT JOIN r ON e.quarter_id = r.quarter_id AND e.source_name = r.source_name
"""

INTAKE_SOURCES = ("retail_sales", "finance_actuals", "trade_adjustments")


@query("q37_intake_submission_log", Q37_SQL)
def q_q37(spark, d):
    """Q37: expected submissions per quarter (from the data's quarters) vs received ones:
    retail arrives 3 days after the last sale, finance 12 days after quarter end, trade never."""
    s = model.sales_lines(Tables(spark, d))
    q = s.groupBy(F.concat(F.year("sale_date").cast("string"), F.lit("Q"), F.quarter("sale_date").cast("string"))
                  .alias("quarter_id")).agg(F.max("sale_date").alias("last_sale"))
    q = q.withColumn("qend", F.date_sub(F.add_months(F.trunc("last_sale", "quarter"), 3), 1))
    srcs = F.explode(F.array(*[F.lit(x) for x in INTAKE_SOURCES]))
    expected = q.select("quarter_id", srcs.alias("source_name"), F.date_add("qend", 10).alias("due_date"))
    received = q.select("quarter_id", F.lit("retail_sales").alias("source_name"),
                        F.date_add("last_sale", 3).alias("received_date")) \
        .unionByName(q.select("quarter_id", F.lit("finance_actuals").alias("source_name"),
                              F.date_add("qend", 12).alias("received_date")))
    return dq.intake_log(expected, received, ["quarter_id", "source_name"]) \
        .select("quarter_id", "source_name", "due_date", "received_date", "submission_status")


A8_SQL = f"""
WITH {SALES_LINES}
SELECT sku, string_agg(DISTINCT channel, ', ' ORDER BY channel) AS channels FROM sales_lines GROUP BY 1
"""


@query("a8_channels_of_sku", A8_SQL)
def q_a8(spark, d):
    """The channels that each SKU is sold in, as one ordered string (at most one entry per channel)."""
    return aggregates.distinct_string_agg(model.sales_lines(Tables(spark, d)), ["sku"], "channel", out="channels")
