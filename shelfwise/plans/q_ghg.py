"""Emissions queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import emissions as E
from ..sources.testdata import Tables
from . import ghg, model
from .oracle import GHG, SALES_LINES
from .registry import query, rounded

FACT_COLS = ["activity_id", "source_system", "source_record_id", "activity_month", "scope", "facility_id",
             "grid_region", "product_line_id", "product_line_name", "factor_type", "activity_amount", "activity_unit",
             "factor_id", "factor_version", "kg_co2e", "metric_tons_co2e", "has_missing_factor_join",
             "has_missing_facility_join", "has_missing_product_line_join", "is_reportable_emissions_row", "qa_status_label"]

E2_SQL = f"""
WITH {GHG}
SELECT activity_id, source_system, source_record_id, activity_month, scope, facility_id, grid_region, product_line_id,
       product_line_name, factor_type, round(activity_amount, 4) AS activity_amount, activity_unit, factor_id,
       factor_version, round(kg_co2e, 4) AS kg_co2e, round(metric_tons_co2e, 4) AS metric_tons_co2e,
       has_missing_factor_join, has_missing_facility_join, has_missing_product_line_join,
       is_reportable_emissions_row, qa_status_label
FROM fact
"""


@query("e2_emissions_with_factors", E2_SQL)
def q_e2(spark, d):
    return rounded(ghg.fact(Tables(spark, d)).select(*FACT_COLS))


Q28_SQL = f"""
WITH {GHG}
SELECT source_system, COUNT(*) AS row_count,
       count(*) FILTER (WHERE has_unknown_activity_type) AS unknown_activity_type_rows,
       count(*) FILTER (WHERE has_negative_activity) AS negative_activity_rows,
       count(*) FILTER (WHERE has_missing_facility_join OR has_missing_product_line_join) AS missing_dim_rows,
       count(*) FILTER (WHERE has_missing_factor_join) AS missing_factor_rows,
       round(SUM(CASE WHEN has_missing_factor_join THEN activity_amount END), 4) AS missing_factor_activity
FROM fact GROUP BY 1
"""


@query("q28_emissions_controls", Q28_SQL)
def q_q28(spark, d):
    return rounded(E.emissions_controls(ghg.fact(Tables(spark, d))))


Q30_SQL = f"""
WITH {GHG},
f AS (SELECT COUNT(*) - COUNT(DISTINCT activity_id) AS duplicate_activity_ids,
             count(*) FILTER (WHERE is_reportable_emissions_row AND kg_co2e IS NULL) AS reportable_without_emissions,
             count(*) FILTER (WHERE is_reportable_emissions_row AND factor_id IS NULL) AS clean_rows_without_factor,
             count(*) FILTER (WHERE abs(kg_co2e - activity_amount * factor_value_kg_co2e_per_unit) > 1e-4) AS math_mismatches,
             count(*) FILTER (WHERE is_reportable_emissions_row AND (has_negative_activity OR has_missing_factor_join))
               AS flag_logic_violations,
             count(*) FILTER (WHERE activity_id IS NULL OR source_system IS NULL OR scope IS NULL) AS required_field_nulls,
             COUNT(*) AS fact_rows FROM fact),
u AS (SELECT count(*) FILTER (WHERE n > 1) AS duplicate_factor_keys
      FROM (SELECT factor_type, activity_unit, region, effective_start, COUNT(*) AS n FROM factors GROUP BY ALL)),
s AS (SELECT COUNT(*) AS source_rows FROM act0)
SELECT check_name, CAST(failed_count AS BIGINT) AS failed_count,
       CASE WHEN failed_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (
  SELECT 'duplicate_activity_ids' AS check_name, duplicate_activity_ids AS failed_count FROM f UNION ALL
  SELECT 'reportable_without_emissions', reportable_without_emissions FROM f UNION ALL
  SELECT 'clean_rows_without_factor', clean_rows_without_factor FROM f UNION ALL
  SELECT 'math_mismatches', math_mismatches FROM f UNION ALL
  SELECT 'flag_logic_violations', flag_logic_violations FROM f UNION ALL
  SELECT 'required_field_nulls', required_field_nulls FROM f UNION ALL
  SELECT 'duplicate_factor_keys', duplicate_factor_keys FROM u UNION ALL
  SELECT 'rowcount_matches_sources', abs(fact_rows - source_rows) FROM f, s)
"""


@query("q30_emissions_hard_checks", Q30_SQL)
def q_q30(spark, d):
    t = Tables(spark, d)
    return E.hard_checks(ghg.fact(t), ghg.factors(spark), ghg.source_counts(t))


Q33_SQL = f"""
WITH {GHG}
SELECT source_system, COUNT(*) AS row_count, count(*) FILTER (WHERE product_line_id IS NULL) AS null_product_line_id,
       count(*) FILTER (WHERE factor_id IS NULL) AS null_factor_id, count(*) FILTER (WHERE kg_co2e IS NULL) AS null_kg_co2e,
       count(*) FILTER (WHERE grid_region IS NULL) AS null_grid_region
FROM fact GROUP BY 1
"""


@query("q33_emissions_null_profile", Q33_SQL)
def q_q33(spark, d):
    return E.null_profile(ghg.fact(Tables(spark, d)), ["product_line_id", "factor_id", "kg_co2e", "grid_region"])


Q38_SQL = f"""
WITH {GHG}
SELECT source_system, COUNT(*) AS row_count FROM act0 GROUP BY 1
"""


@query("q38_raw_rowcounts", Q38_SQL)
def q_q38(spark, d):
    return ghg.source_counts(Tables(spark, d))


K26_SQL = f"""
WITH {SALES_LINES}, {GHG},
e AS (SELECT activity_month,
             SUM(CASE WHEN is_reportable_emissions_row THEN metric_tons_co2e END) AS total_t_co2e,
             SUM(CASE WHEN is_reportable_emissions_row AND scope = 'Scope 1' THEN metric_tons_co2e END) AS scope1_t_co2e,
             SUM(CASE WHEN is_reportable_emissions_row AND scope = 'Scope 2' THEN metric_tons_co2e END) AS scope2_t_co2e,
             SUM(CASE WHEN is_reportable_emissions_row AND scope = 'Scope 3' THEN metric_tons_co2e END) AS scope3_t_co2e
      FROM fact GROUP BY 1),
r AS (SELECT month_start AS activity_month, SUM(net_sales) AS revenue_usd FROM sales_lines GROUP BY 1)
SELECT e.activity_month, round(total_t_co2e, 4) AS total_t_co2e, round(scope1_t_co2e, 4) AS scope1_t_co2e,
       round(scope2_t_co2e, 4) AS scope2_t_co2e, round(scope3_t_co2e, 4) AS scope3_t_co2e,
       round(revenue_usd, 4) AS revenue_usd, round(total_t_co2e / NULLIF(revenue_usd, 0), 4) AS t_co2e_per_usd,
       round(total_t_co2e * 1000.0 / NULLIF(revenue_usd, 0), 4) AS t_co2e_per_1k_usd
FROM e LEFT JOIN r ON e.activity_month = r.activity_month
"""


@query("k26_emissions_intensity", K26_SQL)
def q_k26(spark, d):
    t = Tables(spark, d)
    return rounded(E.intensity_monthly(ghg.fact(t), model.sales_lines(t)))


E6_SQL = f"""
WITH {GHG}
SELECT factor_version, source_system, activity_category, COUNT(*) AS row_count,
       count(*) FILTER (WHERE is_reportable_emissions_row) AS reportable_rows, round(SUM(metric_tons_co2e), 4) AS t_co2e
FROM fact GROUP BY 1, 2, 3
"""


@query("e6_emissions_by_factor_version", E6_SQL)
def q_e6(spark, d):
    return rounded(E.by_factor_version(ghg.fact(Tables(spark, d))))


_TRACE = ", ".join(f"round({c}, 4) AS {c}" if c in ("activity_amount", "metric_tons_co2e") else c for c in E.TRACE_COLUMNS)
E6_REPORTABLE_SQL = f"""
WITH {GHG}
SELECT {_TRACE}, source_authority, round(factor_value_kg_co2e_per_unit, 4) AS factor_value_kg_co2e_per_unit
FROM fact WHERE is_reportable_emissions_row
"""
E6_EXCLUDED_SQL = f"WITH {GHG} SELECT {_TRACE}, {', '.join(E.EXCLUSION_FLAGS)} FROM fact WHERE NOT is_reportable_emissions_row"
E6_FACTOR_SQL = f"""
WITH {GHG}
SELECT scope, factor_type, activity_unit, grid_region, factor_id, factor_version, source_authority, COUNT(*) AS rows_using_factor,
       round(SUM(metric_tons_co2e), 4) AS metric_tons_co2e
FROM fact WHERE is_reportable_emissions_row GROUP BY ALL
"""
E6_SOURCE_SQL = f"""
WITH {GHG}
SELECT source_system, scope, activity_category, activity_unit, COUNT(*) AS total_rows,
       count(*) FILTER (WHERE is_reportable_emissions_row) AS reportable_rows,
       count(*) FILTER (WHERE NOT is_reportable_emissions_row) AS non_reportable_rows,
       round(SUM(metric_tons_co2e) FILTER (WHERE is_reportable_emissions_row), 4) AS reportable_metric_tons_co2e
FROM fact GROUP BY ALL
"""


@query("e6_reportable_evidence", E6_REPORTABLE_SQL)
def q_e6_reportable(spark, d):
    return rounded(E.reportable_evidence(ghg.fact(Tables(spark, d))))


@query("e6_excluded_rows", E6_EXCLUDED_SQL)
def q_e6_excluded(spark, d):
    return rounded(E.excluded_rows(ghg.fact(Tables(spark, d))))


@query("e6_factor_usage", E6_FACTOR_SQL)
def q_e6_factor(spark, d):
    return rounded(E.factor_usage(ghg.fact(Tables(spark, d))))


@query("e6_source_activity", E6_SOURCE_SQL)
def q_e6_source(spark, d):
    return rounded(E.source_activity_summary(ghg.fact(Tables(spark, d))))
