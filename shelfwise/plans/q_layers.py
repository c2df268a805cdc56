"""Layer reconciliation on the latest common date (Q23)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from ..operators import dedup, facts, history, recon, staging
from ..operators.recon import Layer, LayerPair
from ..sources.testdata import Tables
from . import model, raw
from .oracle import INVENTORY
from .q_facts import pos_day_of
from .q_history import M16_CORE, M17_SQL
from .registry import query, rounded
from .sql_facts import CONF_CTE, FIN_CTE

_GRAIN = ["sale_date", "store_code", "sku", "channel"]


def _distributor(t, on):
    return dedup.distributor_sales(staging.stage_sales_distributor(raw.sales_distributor_extract(t, on), flag_duplicates=False), _GRAIN)


def _inventory(t, on):
    inv = model.inventory(t, on).select("snapshot_date", "site_id", "sku", "on_hand_units", "received_units")
    return facts.inventory_snapshot_fact(inv)


def _site_day(inv):
    return inv.groupBy("snapshot_date", "site_id").agg(
        F.sum(F.greatest("on_hand_units", F.lit(0))).alias("on_hand_safe"), F.sum("received_units").alias("received_units"))


def layer_pairs(t: Tables) -> list[LayerPair]:
    """Int against mart layers of sales, POS, labor and inventory, and staged against monthly finance.

    Dates: a dedup that keeps each day of its grain has the dates of its input, so those come from one stored column. All copies
    of a POS transaction have its order's date, so a day may be cut before the dedup; punches pair across days, so labor
    is cut after pairing.
    """
    order_dates = lambda c: t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi") \
        .select(F.col("o_orderdate").cast("date").alias(c))
    ship_dates = lambda: t.lineitem.select(F.col("l_shipdate").cast("date").alias("snapshot_date"))
    months = lambda: t.orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("period_month"))
    # Both layers of a pair share the frame below them: built once, and its shuffles are reused.
    distributor, inventory = cache(lambda on: _distributor(t, on)), cache(lambda on: _inventory(t, on))
    pos = cache(lambda on: dedup.pos_transactions(raw.pos_transactions(t, on)))
    employee_days, actuals = history.labor_daily_employee(model.punches(t)), staging.stage_finance_actuals(raw.finance_actuals_extract(t))
    daily, finance = lambda _: employee_days, lambda _: actuals
    sales = {"net_sales": "net_sales", "gross_sales": "gross_sales"}
    return [
        LayerPair("int_vs_mart:sales_distributor", "day",
                  Layer("int.sales_distributor_dedup", "sale_date", distributor, sales | {"cogs": "cogs"},
                        lambda: order_dates("sale_date")),
                  Layer("mart.fact_sales_distributor_daily", "sale_date", lambda on: facts.distributor_daily(distributor(on), _GRAIN),
                        sales | {"cogs": "cogs"}, lambda: order_dates("sale_date"))),
        LayerPair("int_vs_mart:pos", "day",
                  Layer("int.pos_dedup", "txn_date", pos,
                        {"net_sales": "net_amount", "gross_sales": "gross_amount"}, lambda: order_dates("txn_date")),
                  Layer("mart.fact_sales_pos_daily", "sale_date", lambda on: pos_day_of(pos(on)), sales, lambda: order_dates("sale_date"))),
        LayerPair("int_vs_mart:labor", "day",
                  Layer("int.labor_daily", "work_date", daily, {"labor_hours": "hours_worked", "shift_pairs": "n_shift_pairs"}),
                  Layer("mart.fact_labor_daily", "work_date", lambda on: history.labor_store_daily(daily(on)),
                        {"labor_hours": "labor_hours", "shift_pairs": "shift_pairs"})),
        LayerPair("int_vs_mart:inventory", "day",
                  Layer("int.inventory_snapshot_dedup", "snapshot_date", inventory,
                        {"on_hand_safe": F.greatest("on_hand_units", F.lit(0)), "received_units": "received_units"}, ship_dates),
                  Layer("mart.fact_inventory_snapshot_daily", "snapshot_date", lambda on: _site_day(inventory(on)),
                        {"on_hand_safe": "on_hand_safe", "received_units": "received_units"}, ship_dates)),
        LayerPair("stg_vs_mart:finance_actuals", "month",
                  Layer("stg.finance_actuals", "period_month", finance, {"actual_amount": "actual_amount"}, months),
                  Layer("mart.fact_actuals_monthly", "period_month", lambda on: facts.finance_monthly(finance(on)),
                        {"actual_amount": "actual_amount"}, months)),
    ]


def _pair_sql(check, grain, source, modeled, source_date, modeled_date, source_name, modeled_name, measures):
    """One row per measure: both totals on the lesser of the layers' latest dates."""
    rows = " UNION ALL ".join(
        f"""SELECT '{check}:{k}' AS check_name, '{grain}' AS grain, d.day AS check_date, '{source_name}' AS source_object,
        '{modeled_name}' AS modeled_object,
        (SELECT CAST(SUM(COALESCE({s}, 0)) AS DECIMAL(38,4)) FROM {source} WHERE {source_date} = d.day) AS source_total,
        (SELECT CAST(SUM(COALESCE({m}, 0)) AS DECIMAL(38,4)) FROM {modeled} WHERE {modeled_date} = d.day) AS modeled_total
        FROM (SELECT least((SELECT max({source_date}) FROM {source}), (SELECT max({modeled_date}) FROM {modeled})) AS day) d"""
        for k, s, m in measures)
    return rows


_SALES = [("net_sales", "net_sales", "net_sales"), ("gross_sales", "gross_sales", "gross_sales")]
Q23_LAYERS_SQL = f"""
WITH {CONF_CTE}, {INVENTORY}, {FIN_CTE.replace("s AS (", "fin_s AS (").replace("FROM s)", "FROM fin_s)").replace("k AS (", "fin AS (")},
labor_e AS ({M16_CORE}), labor_s AS ({M17_SQL.replace("round(", "(0 + ").replace(", 4) AS", ") AS")}),
inv AS (SELECT * FROM (
  SELECT snapshot_date, site_id, sku, on_hand_units, received_units,
         ROW_NUMBER() OVER (PARTITION BY snapshot_date, site_id, sku ORDER BY on_hand_units < 0, on_hand_units DESC, received_units DESC) AS rn
  FROM inventory) WHERE rn = 1),
site_day AS (SELECT snapshot_date, site_id, SUM(greatest(on_hand_units, 0)) AS on_hand_safe, SUM(received_units) AS received_units
             FROM inv GROUP BY 1, 2),
fin_month AS (SELECT period_month, kpi_category, SUM(actual_amount) AS actual_amount FROM fin GROUP BY 1, 2),
r AS (
  {_pair_sql("int_vs_mart:sales_distributor", "day", "best", "dist", "sale_date", "sale_date", "int.sales_distributor_dedup",
             "mart.fact_sales_distributor_daily", [*_SALES, ("cogs", "cogs", "cogs")])}
  UNION ALL {_pair_sql("int_vs_mart:pos", "day", "posb", "posd", "txn_date", "sale_date", "int.pos_dedup", "mart.fact_sales_pos_daily",
                       [("net_sales", "net_amount", "net_sales"), ("gross_sales", "gross_amount", "gross_sales")])}
  UNION ALL {_pair_sql("int_vs_mart:labor", "day", "labor_e", "labor_s", "work_date", "work_date", "int.labor_daily", "mart.fact_labor_daily",
                       [("labor_hours", "hours_worked", "labor_hours"), ("shift_pairs", "n_shift_pairs", "shift_pairs")])}
  UNION ALL {_pair_sql("int_vs_mart:inventory", "day", "inv", "site_day", "snapshot_date", "snapshot_date", "int.inventory_snapshot_dedup",
                       "mart.fact_inventory_snapshot_daily", [("on_hand_safe", "greatest(on_hand_units, 0)", "on_hand_safe"),
                                                              ("received_units", "received_units", "received_units")])}
  UNION ALL {_pair_sql("stg_vs_mart:finance_actuals", "month", "fin", "fin_month", "period_month", "period_month", "stg.finance_actuals",
                       "mart.fact_actuals_monthly", [("actual_amount", "actual_amount", "actual_amount")])})
SELECT 'recon' AS check_group, check_name, grain, check_date, source_object, modeled_object, round(source_total, 4) AS source_total,
       round(modeled_total, 4) AS modeled_total, round(COALESCE(modeled_total, 0) - COALESCE(source_total, 0), 4) AS delta_amount,
       round(COALESCE(abs(COALESCE(modeled_total, 0) - COALESCE(source_total, 0))
             / NULLIF(greatest(abs(COALESCE(source_total, 0)), abs(COALESCE(modeled_total, 0))), 0), 0), 4) AS delta_pct,
       CAST(0 AS DOUBLE) AS tolerance_pct,
       CASE WHEN source_total = modeled_total THEN 'Pass' ELSE 'Fail' END AS status,
       CASE WHEN source_total IS NULL THEN 'FAIL_missing_source' WHEN modeled_total IS NULL THEN 'FAIL_missing_modeled'
            WHEN source_total = modeled_total THEN 'PASS' ELSE 'FAIL_mismatch' END AS status_detail
FROM r
"""


@query("q23_layer_reconciliation", Q23_LAYERS_SQL)
def q_q23_layers(spark, d):
    return rounded(recon.layer_reconciliation(layer_pairs(Tables(spark, d))))
