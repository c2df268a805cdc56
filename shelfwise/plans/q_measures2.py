"""Measures and traces over time: aged inventory, launches, cannibalisation, mix change, end-to-end trace."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import emissions as E
from ..operators import semantic as S
from ..operators.calendar import latest_date
from ..sources.testdata import Tables
from . import ghg, model
from .oracle import GHG, INVENTORY, SALES_LINES
from .registry import query, rounded

# Stock role: a line is received at its ship date; of what is not sent back, four fifths are issued 45 days later.
ISSUE_SHARE, ISSUE_DAYS = 0.8, 45
AS_OF_LAUNCH = "1996-06-30"

X14_AGED_SQL = f"""
WITH {INVENTORY}, {SALES_LINES},
l AS (SELECT l_partkey AS sku, CAST(l_shipdate AS DATE) AS d, l_quantity AS q, l_returnflag AS f FROM lineitem),
cut_off AS (SELECT max(d) AS day FROM l),
r AS (SELECT sku, d, SUM(q) AS q FROM l WHERE q > 0 GROUP BY 1, 2),
i AS (SELECT sku, d, SUM(q) AS q FROM (SELECT sku, CAST(d + INTERVAL {ISSUE_DAYS} DAY AS DATE) AS d, floor(q * {ISSUE_SHARE}) AS q FROM l WHERE f <> 'R'), cut_off
      WHERE d <= day AND q > 0 GROUP BY 1, 2),
rc AS (SELECT sku, d, SUM(q) OVER w AS hi, SUM(q) OVER w - q AS lo FROM r WINDOW w AS (PARTITION BY sku ORDER BY d ROWS UNBOUNDED PRECEDING)),
ic AS (SELECT sku, d, SUM(q) OVER w AS hi, SUM(q) OVER w - q AS lo FROM i WINDOW w AS (PARTITION BY sku ORDER BY d ROWS UNBOUNDED PRECEDING)),
m AS (SELECT r.sku, r.d AS rd, ic.d AS id, least(r.hi, ic.hi) - greatest(r.lo, ic.lo) AS u
      FROM rc r JOIN ic ON r.sku = ic.sku AND r.lo < ic.hi AND ic.lo < r.hi),
layers AS (
  SELECT * FROM m
  UNION ALL SELECT sku, d, NULL, hi - greatest(lo, t) FROM rc JOIN (SELECT sku, SUM(COALESCE(q, 0)) AS t FROM (
      SELECT sku, q FROM i UNION ALL SELECT sku, 0 FROM r) GROUP BY 1) USING (sku) WHERE hi > t
  UNION ALL SELECT sku, NULL, d, hi - greatest(lo, t) FROM ic JOIN (SELECT sku, SUM(q) AS t FROM (
      SELECT sku, q FROM r UNION ALL SELECT sku, 0 FROM i) GROUP BY 1) USING (sku) WHERE hi > t),
c AS (SELECT p.p_type AS category, x.*, datediff('day', rd, day) AS age FROM layers x JOIN part p ON x.sku = p.p_partkey, cut_off),
a AS (SELECT category, SUM(CASE WHEN id IS NULL THEN u ELSE 0 END) AS on_hand_units,
             SUM(CASE WHEN id IS NULL AND age BETWEEN 0 AND 30 THEN u ELSE 0 END) AS units_0_30,
             SUM(CASE WHEN id IS NULL AND age BETWEEN 31 AND 60 THEN u ELSE 0 END) AS units_31_60,
             SUM(CASE WHEN id IS NULL AND age BETWEEN 61 AND 90 THEN u ELSE 0 END) AS units_61_90,
             SUM(CASE WHEN id IS NULL AND age > 90 THEN u ELSE 0 END) AS units_90_plus,
             SUM(CASE WHEN id IS NOT NULL AND rd IS NOT NULL THEN u ELSE 0 END) AS issued_units,
             SUM(CASE WHEN rd IS NULL THEN u ELSE 0 END) AS unreceived_units,
             SUM(CASE WHEN id IS NOT NULL AND rd IS NOT NULL THEN u * datediff('day', rd, id) END) AS unit_days FROM c GROUP BY 1),
v AS (SELECT category, AVG(h) AS avg_inventory_units FROM (
        SELECT category, snapshot_date, SUM(greatest(on_hand_units, 0)) AS h FROM inventory GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT category, SUM(units) AS volume_units FROM sales_lines GROUP BY 1)
SELECT category, round(on_hand_units, 4) AS on_hand_units, round(units_0_30, 4) AS units_0_30, round(units_31_60, 4) AS units_31_60,
       round(units_61_90, 4) AS units_61_90, round(units_90_plus, 4) AS units_90_plus, round(issued_units, 4) AS issued_units,
       round(unreceived_units, 4) AS unreceived_units, round(units_90_plus / NULLIF(on_hand_units, 0), 4) AS aged_share,
       round(unit_days / NULLIF(issued_units, 0), 4) AS mean_days_in_stock, round(avg_inventory_units, 4) AS avg_inventory_units,
       round(volume_units, 4) AS volume_units, round(volume_units / NULLIF(avg_inventory_units, 0), 4) AS inventory_turnover
FROM a LEFT JOIN v USING (category) LEFT JOIN s USING (category)
"""


@query("x14_aged_inventory", X14_AGED_SQL)
def q_x14_aged(spark, d):
    t = Tables(spark, d)
    day = F.col("l_shipdate").cast("date")
    li = t.lineitem
    as_of = latest_date(li, "l_shipdate")
    receipts = li.select(F.col("l_partkey").alias("sku"), day.alias("date"), F.col("l_quantity").alias("units"))
    issues = li.filter(F.col("l_returnflag") != "R").select(
        F.col("l_partkey").alias("sku"), F.date_add(day, ISSUE_DAYS).alias("date"),
        F.floor(F.col("l_quantity") * ISSUE_SHARE).cast("double").alias("units")).filter(F.col("date") <= F.lit(as_of).cast("date"))
    layers = S.fifo_layers(receipts, issues, ["sku"])
    category = t.part.select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("category"))
    aged = S.aged_inventory(layers.join(category, "sku"), ["category"], as_of)
    turnover = S.unit_turnover(model.inventory(t), model.sales_lines(t), ["category"])
    return rounded(aged.join(turnover, "category", "left"))


_LAUNCH = f"""{SALES_LINES},
s AS (SELECT * FROM sales_lines WHERE sale_date <= DATE '{AS_OF_LAUNCH}'),
st AS (SELECT sku, min(sale_date) AS launch_date FROM s GROUP BY 1)"""
X15_LAUNCH_SQL = f"""
WITH {_LAUNCH},
g AS (SELECT sku, launch_date, SUM(net_sales) FILTER (WHERE datediff('day', launch_date, sale_date) < 90) AS launch_revenue,
             SUM(net_sales) AS revenue_to_date FROM s JOIN st USING (sku) GROUP BY 1, 2)
SELECT sku, launch_date, round(launch_revenue, 4) AS launch_revenue, round(revenue_to_date, 4) AS revenue_to_date,
       round(f, 4) AS launch_forecast, round(launch_revenue / NULLIF(f, 0), 4) AS launch_success,
       launch_date + INTERVAL 90 DAY <= DATE '{AS_OF_LAUNCH}' AS window_complete
FROM g LEFT JOIN (SELECT p_partkey AS sku, CAST(p_retailprice AS DECIMAL(18,4)) * p_size AS f FROM part) USING (sku)
"""


@query("x15_launch_success", X15_LAUNCH_SQL)
def q_x15_launch(spark, d):
    """The launch forecast of a product is its list price times its pack size (stated role)."""
    t = Tables(spark, d)
    forecast = model.products(t).select("sku", (F.col("list_price") * F.col("pack_size")).alias("launch_forecast"))
    return rounded(S.launch_success(model.sales_lines(t), forecast, "sku", "sale_date", "net_sales", AS_OF_LAUNCH))


X15_RAMP_SQL = f"""
WITH {_LAUNCH}
SELECT CAST(datediff('day', launch_date, sale_date) // 7 AS INTEGER) AS weeks_since_launch, COUNT(DISTINCT sku) AS selling_products,
       round(SUM(net_sales), 4) AS new_product_revenue
FROM s JOIN st USING (sku) WHERE launch_date >= DATE '{AS_OF_LAUNCH}' - INTERVAL 6 MONTH GROUP BY 1
"""


@query("x15_new_product_ramp", X15_RAMP_SQL)
def q_x15_ramp(spark, d):
    return rounded(S.new_product_ramp(model.sales_lines(Tables(spark, d)), "sku", "sale_date", "net_sales", AS_OF_LAUNCH))


def _yoy_sql(grain: str, key: str, values: dict[str, str]) -> str:
    """CTE j: both years of every (period, key), 0 where one is missing, for periods that have a prior period."""
    sums = ", ".join(f"SUM({e}) AS {v}" for v, e in values.items())
    cols = ", ".join(f"COALESCE(n.{v}, 0) AS {v}, COALESCE(p.{v}, 0) AS prior_{v}" for v in values)
    return f"""{SALES_LINES},
g AS (SELECT CAST(date_trunc('{grain}', sale_date) AS DATE) AS period, {key}, {sums} FROM sales_lines GROUP BY 1, 2),
pr AS (SELECT CAST(period + INTERVAL 12 MONTH AS DATE) AS period, {key}, {", ".join(values)} FROM g),
j AS (SELECT COALESCE(n.period, p.period) AS period, COALESCE(n.{key}, p.{key}) AS {key}, {cols}
      FROM g n FULL JOIN pr p ON n.period = p.period AND n.{key} = p.{key}
      WHERE COALESCE(n.period, p.period) IN (SELECT period FROM g INTERSECT SELECT period FROM pr))"""


X21_CANNIBAL_SQL = f"""
WITH {_yoy_sql("year", "category", {"revenue": "net_sales"})},
k AS (SELECT *, greatest(prior_revenue - revenue, 0) AS revenue_loss, greatest(revenue - prior_revenue, 0) AS revenue_gain FROM j),
t AS (SELECT *, SUM(revenue_loss) OVER (PARTITION BY period) AS total_loss, SUM(revenue_gain) OVER (PARTITION BY period) AS total_gain FROM k)
SELECT period, category, round(revenue, 4) AS revenue, round(prior_revenue, 4) AS prior_revenue, round(revenue_loss, 4) AS revenue_loss,
       round(revenue_gain, 4) AS revenue_gain, round(total_loss, 4) AS total_loss, round(total_gain, 4) AS total_gain,
       round(CASE WHEN revenue_loss > 0 THEN CAST(revenue_loss AS DOUBLE) * least(total_loss, total_gain) / total_loss ELSE 0 END, 4) AS cannibalised_loss,
       round(CASE WHEN revenue_gain > 0 THEN CAST(revenue_gain AS DOUBLE) * least(total_loss, total_gain) / total_gain ELSE 0 END, 4) AS cannibalising_gain
FROM t
"""


def _periodic(t, grain):
    return model.sales_lines(t).withColumn("period", F.date_trunc(grain, "sale_date").cast("date"))


@query("x21_cannibalisation", X21_CANNIBAL_SQL)
def q_x21_cannibal(spark, d):
    return rounded(S.cannibalisation(_periodic(Tables(spark, d), "year"), "period", "category", "net_sales"))


X17_MIX_SQL = f"""
WITH {_yoy_sql("month", "category", {"revenue": "net_sales", "margin": "net_sales - cogs"})},
t AS (SELECT *, SUM(revenue) OVER w AS tr, SUM(prior_revenue) OVER w AS tp, SUM(margin) OVER w AS tm, SUM(prior_margin) OVER w AS tpm
      FROM j WINDOW w AS (PARTITION BY period)),
x AS (SELECT *, COALESCE(revenue / NULLIF(tr, 0), 0) AS mix, COALESCE(prior_revenue / NULLIF(tp, 0), 0) AS prior_mix,
             margin / NULLIF(revenue, 0) AS now, prior_margin / NULLIF(prior_revenue, 0) AS before,
             (COALESCE(tm / NULLIF(tr, 0), 0) + COALESCE(tpm / NULLIF(tp, 0), 0)) / 2 AS overall FROM t)
SELECT period, category, round(revenue, 4) AS revenue, round(prior_revenue, 4) AS prior_revenue, round(mix, 4) AS mix,
       round(prior_mix, 4) AS prior_mix, round(mix - prior_mix, 4) AS mix_change, round(now, 4) AS margin_rate,
       round(before, 4) AS prior_margin_rate,
       round((mix + prior_mix) / 2 * (COALESCE(now, before, 0) - COALESCE(before, now, 0)), 4) AS within_effect,
       round((mix - prior_mix) * ((COALESCE(now, before, 0) + COALESCE(before, now, 0)) / 2 - overall), 4) AS between_effect
FROM x
"""


@query("x17_mix_change", X17_MIX_SQL)
def q_x17_mix(spark, d):
    s = _periodic(Tables(spark, d), "month").withColumn("margin_amount", F.col("net_sales") - F.col("cogs"))
    return rounded(S.mix_change(s, "period", "category", "net_sales", "margin_amount"))


X17_LOW_SQL = f"""
WITH {SALES_LINES},
g AS (SELECT month_start, brand, SUM(net_sales) AS revenue, SUM(units) AS units, SUM(net_sales - cogs) AS gross_margin
      FROM sales_lines GROUP BY 1, 2),
x AS (SELECT *, units / NULLIF(SUM(units) OVER (PARTITION BY month_start), 0) AS volume_share, gross_margin / NULLIF(revenue, 0) AS gross_margin_pct FROM g)
SELECT month_start, brand, round(revenue, 4) AS revenue, round(units, 4) AS units, round(gross_margin, 4) AS gross_margin,
       round(volume_share, 4) AS volume_share, round(gross_margin_pct, 4) AS gross_margin_pct
FROM x WHERE gross_margin_pct < 0.5 AND volume_share > 0.05
"""


@query("x17_low_margin_high_volume", X17_LOW_SQL)
def q_x17_low(spark, d):
    return rounded(S.low_margin_high_volume(model.sales_lines(Tables(spark, d)), ["month_start"], "brand"))


_LI_SOURCES = ("utility_bills", "fuel_usage", "shipping_logistics")


def staged_sources(t):
    """Source rows with the amount as staged and the file they came from; the stored key columns stay for the walk back."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    q = F.col("l_quantity")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", name.alias("source_file"))
    of = {"A": q * 100.0 * F.when(F.col("l_tax") == 0, -1.0).otherwise(1.0), "N": q, "R": q * 12.5}
    staged = {s: li.filter(F.col("l_returnflag") == f).select("l_orderkey", "l_linenumber", e.alias("source_amount"), "source_file")
              for s, (f, e) in zip(_LI_SOURCES, of.items())}
    staged["packaging_procurement"] = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000.0).alias("source_amount"), name.alias("source_file"))
    part = lambda k, kind: F.split(F.col("source_record_id"), "-").getItem(k).cast(kind)
    keys = {s: {"l_orderkey": part(0, "long"), "l_linenumber": part(1, "int")} for s in _LI_SOURCES}
    keys["packaging_procurement"] = {"o_orderkey": F.col("source_record_id").cast("long")}
    return staged, keys


E6_TRACE_SQL = f"""
WITH {GHG},
last AS (SELECT source_system, max(activity_month) AS m FROM fact WHERE is_reportable_emissions_row GROUP BY 1),
ids AS (SELECT DISTINCT activity_id FROM fact f JOIN last l ON f.source_system = l.source_system AND f.activity_month = l.m
        WHERE f.is_reportable_emissions_row),
rows_ AS (SELECT f.*, ef.effective_start, ef.effective_end FROM fact f JOIN ids USING (activity_id)
          LEFT JOIN factors ef ON ef.factor_id = f.factor_id),
src AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'utility_bills' WHEN 'N' THEN 'fuel_usage' ELSE 'shipping_logistics' END AS ss,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rid,
         CASE l_returnflag WHEN 'A' THEN l_quantity * 100.0 * CASE WHEN l_tax = 0 THEN -1.0 ELSE 1.0 END WHEN 'N' THEN l_quantity
              ELSE l_quantity * 12.5 END AS source_amount, 'lineitem.parquet' AS source_file FROM lineitem
  UNION ALL SELECT 'packaging_procurement', CAST(o_orderkey AS VARCHAR), o_totalprice / 1000.0, 'orders.parquet' FROM orders)
SELECT activity_id, source_system, source_record_id, evidence_reference, activity_month, scope, facility_id, product_line_id, activity_category,
       round(activity_amount, 4) AS activity_amount, activity_unit, factor_id, factor_version, round(metric_tons_co2e, 4) AS metric_tons_co2e,
       qa_status_label, factor_type, round(kg_co2e, 4) AS kg_co2e, source_authority,
       round(factor_value_kg_co2e_per_unit, 4) AS factor_value_kg_co2e_per_unit, effective_start, effective_end,
       round(source_amount, 4) AS source_amount, source_file, round(source_amount * factor_value_kg_co2e_per_unit, 4) AS recomputed_kg_co2e,
       COALESCE(abs(source_amount * factor_value_kg_co2e_per_unit - kg_co2e) <= 1e-6, FALSE) AS ties_out
FROM rows_ LEFT JOIN src ON ss = source_system AND rid = source_record_id
"""


@query("e6_end_to_end_trace", E6_TRACE_SQL)
def q_e6_trace(spark, d):
    """The reported rows of each source's latest reported month, walked back to their source files."""
    t = Tables(spark, d)
    fact = ghg.fact(t)
    reported = fact.filter("is_reportable_emissions_row")
    last = reported.groupBy("source_system").agg(F.max("activity_month").alias("activity_month"))
    ids = reported.join(last, ["source_system", "activity_month"], "left_semi").select("activity_id")
    staged, keys = staged_sources(t)
    return rounded(E.trace(ids, fact, ghg.factors(spark), staged, keys))
