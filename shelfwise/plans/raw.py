"""Landing-layer extracts (reference schemas, FIXTURES.md §1) derived from the test tables.

Every derivation is a projection of a whole test table; defects (blank text,
mixed date formats, padded codes, text quantities) are placed by key parity so
the same rows are defective in the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..sources.testdata import Tables
from . import model

# Fixed channel wording per market segment (exercises the channel classifier).
SEGMENT_CHANNEL_TEXT = {
    "AUTOMOBILE": " Retail ",
    "BUILDING": "WHOLESALE club",
    "FURNITURE": "Distributor",
    "HOUSEHOLD": "retail",
    "MACHINERY": "eCommerce",
}


def _map(mapping: dict, col):
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[col]


def account_status_extract(t: Tables) -> DataFrame:
    """H1 input from orders: one status row per order."""
    o = t.orders
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    label = _map(model.STATUS_TEXT, F.col("o_orderstatus"))
    return o.select(
        F.concat(F.lit("L"), (k % 4).cast("string")).alias("load_id"),
        F.when(k % 5 != 0, d).alias("status_date"),
        F.when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy")).alias("status_date_raw"),
        F.when(k % 13 == 0, F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("store_code_norm"),
        F.when(k % 2 == 1, F.concat(F.lit("  "), label, F.lit(" "))).otherwise(label).alias("account_status_raw"),
        F.col("o_orderpriority").alias("status_reason_norm"),
    )


def sales_distributor_extract(t: Tables, on=None, carry=()) -> DataFrame:
    """H4 input from sales lines; returns carry negative net sales. With ``carry``, these columns of the orders and the stored
    product key (``sku_key``)."""
    s = model.sales_lines(t, on=on, carry=carry)
    seg_text = _map(SEGMENT_CHANNEL_TEXT, F.upper(F.col("channel")))
    ln = F.col("line_number")
    net = F.when(F.col("return_flag") == "R", -F.col("net_sales")).otherwise(F.col("net_sales"))
    return s.select(
        F.concat(F.lit("L"), (F.col("order_id") % 3).cast("string")).alias("load_id"),
        F.when(ln % 2 == 0, F.col("sale_date")).alias("sale_date"),
        F.date_format("sale_date", "MM/dd/yyyy").alias("sale_date_raw"),
        F.col("store_id").cast("string").alias("store_id_norm"),
        F.col("sku").cast("string").alias("sku"),
        seg_text.alias("channel_norm"),
        F.when(ln % 3 != 0, F.col("units").cast("int")).alias("qty"),
        F.concat(F.col("units").cast("int").cast("string"), F.lit(" units")).alias("qty_raw"),
        F.col("list_price").alias("unit_list_price"),
        F.col("gross_sales"), F.col("discount_amount"), net.alias("net_sales"), F.col("cogs"),
        F.concat(F.lit(" "), F.col("product_name")).alias("product_name_raw"),
        F.when(ln != 3, F.lit(0.05).cast(C.MONEY)).alias("discount_rate"), F.lit("0.25 off").alias("discount_rate_raw"),
        F.when(ln != 2, F.lit(9.75).cast(C.MONEY)).alias("unit_net_price"), F.concat(F.lit("$"), F.col("units").cast("int").cast("string"), F.lit(".50")).alias("unit_net_price_raw"),
        F.when(ln % 4 != 0, F.lit(1)).alias("orders"), F.lit("2 orders").alias("orders_raw"),
        F.when(ln % 5 != 0, F.lit(1)).alias("customers"), F.lit("n/a").alias("customers_raw"),
        *([*carry, F.col("sku").alias("sku_key")] if carry else []),
    )


def timeclock_extract(t: Tables) -> DataFrame:
    """H8 input from events: text timestamps in two formats, action words."""
    e = t.events
    k = F.col("event_id")
    ts = F.col("ts")
    return e.select(
        F.when(k % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
         .otherwise(F.date_format(ts, "MM/dd/yyyy HH:mm:ss")).alias("punch_ts_raw"),
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("employee_id_raw"),
        F.concat(F.lit("S"), F.lpad((F.col("user_id") % model.N_PUNCH_STORES).cast("string"), 2, "0")).alias("site_code_norm"),
        F.col("event_type").alias("action_raw"),
        F.concat(F.lit("L"), (k % 2).cast("string")).alias("load_id"),
    )


def _txt(c, scale: int = 4):
    """Number → fixed-scale text (rounded first so both engines render alike)."""
    return C.round_to(c, scale).cast(f"decimal(18,{scale})").cast("string")


def forecast_weekly_extract(t: Tables) -> DataFrame:
    """H12 input: weekly actuals full-outer-joined with a seasonal-naive forecast.

    forecast(week) = actuals of the same store / SKU 364 days earlier; rows with
    a forecast but no actual are partial actuals.  Everything is text.
    """
    s = model.sales_lines(t)
    dims = ["store_id", "state", "region", "sku", "product_name", "category", "channel"]
    a = s.groupBy("week_start", *dims).agg(F.sum("units").alias("actual_units"),
                                           F.sum("net_sales").alias("actual_net_sales"))
    f = a.select(F.date_add("week_start", 364).alias("week_start"), *dims,
                 F.col("actual_units").alias("forecast_units"), F.col("actual_net_sales").alias("forecast_net_sales"))
    j = a.join(f, ["week_start", *dims], "full")
    au, an, fu, fn = F.col("actual_units"), F.col("actual_net_sales"), F.col("forecast_units"), F.col("forecast_net_sales")
    return j.select(
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start_date"),
        F.col("store_id").cast("string").alias("store_code"), "state", "region",
        F.col("sku").cast("string").alias("sku"), "product_name", F.col("category").alias("product_family"),
        F.when(F.col("store_id") % 2 == 1, F.concat(F.lit(" "), F.upper("channel"))).otherwise(F.col("channel")).alias("channel"),
        _txt(fu).alias("forecast_units"), _txt(au).alias("actual_units"),
        _txt(fn).alias("forecast_net_sales"), _txt(an).alias("actual_net_sales"),
        _txt(fn / fu).alias("forecast_unit_price"), _txt(an / au).alias("actual_unit_price"),
        F.when(F.col("category") == "PROMO", F.lit("Yes")).otherwise(F.lit("no")).alias("promo_flag"),
        F.when(au < 5, F.lit("Y")).when(au.isNotNull(), F.lit("N")).alias("stockout_flag"),
        F.when(an.isNull(), F.lit("true")).otherwise(F.lit("false")).alias("is_partial_actual"),
        F.date_format("week_start", "MMMM").alias("seasonality_label"),
        F.when(F.col("category") == "PROMO", F.lit(" Promo Week ")).when(F.month("week_start") == 12, F.lit("HOLIDAY")).alias("business_event"),
        F.lit("baseline").alias("plan_version"),
    )


RETAIL_QUARTERLY_TYPES = {"week_end_date": "date", "units_sold": "double", "gross_sales": "double",
                          "discount_amount": "double", "net_sales": "double"}


def retail_quarterly_extract(t: Tables) -> DataFrame:
    """Quarterly retail account sales extract (all text) from sales lines.

    Returns carry negative units; some keys are blank so completeness rules fire.
    """
    s = model.sales_lines(t)
    q = F.concat(F.year("sale_date").cast("string"), F.lit("Q"), F.quarter("sale_date").cast("string"))
    units = F.when(F.col("return_flag") == "R", -F.col("units")).otherwise(F.col("units"))
    return s.select(
        F.when(F.col("order_id") % 17 == 0, F.lit(" ")).otherwise(q).alias("quarter_id"),
        F.when(F.col("order_id") % 19 == 0, F.lit("")).otherwise(
            F.date_format(F.date_add("week_start", 6), "yyyy-MM-dd")).alias("week_end_date"),
        F.when(F.col("line_number") == 7, F.lit(None)).otherwise(F.col("store_id").cast("string")).alias("dispensary_account_id"),
        F.col("sku").cast("string").alias("sku_id"),
        _txt(units, 2).alias("units_sold"), _txt(F.col("gross_sales"), 2).alias("gross_sales"),
        _txt(F.col("discount_amount"), 2).alias("discount_amount"), _txt(F.col("net_sales"), 2).alias("net_sales"),
    )


def pos_lines(t: Tables, on=None, carry=()) -> DataFrame:
    """POS transaction lines: order = transaction, line = basket line (keys repeat → D5 dedup)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = model.on_day(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", *carry), "o_orderdate", on)
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(F.col("l_orderkey").alias("txn_id"), F.col("l_linenumber").alias("line_number"),
                    F.col("o_orderdate").cast("date").alias("txn_date"),
                    F.col("o_custkey").cast("string").alias("store_code"), F.col("l_partkey").cast("string").alias("sku"),
                    F.col("l_quantity").alias("qty"), C.exact("l_extendedprice").alias("gross_amount"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(C.MONEY).alias("net_amount"),
                    *([*carry, F.col("l_partkey").alias("sku_key")] if carry else []))


def pos_transactions(t: Tables, on=None, order_key: str | None = None, carry=()) -> DataFrame:
    """POS transactions, one per line item. Every seventh order is sent again a day later with corrected amounts; half of
    those came without a readable timestamp at first (D5 picks the second copy). ``order_key`` names a column for the order
    that a transaction id begins with; with ``carry``, these columns of the orders and the stored product key (``sku_key``)."""
    p = pos_lines(t, on, carry)
    k = F.col("txn_id")
    base = p.withColumns({"k": k, "txn_id": F.concat(k.cast("string"), F.lit("-"), F.col("line_number").cast("string"))}) \
        .drop("line_number")
    # Both copies come from one pass over the lines.
    lower = (F.col("net_amount") * F.lit("0.9").cast("decimal(2,1)")).cast(C.MONEY)
    first = F.struct(F.when(F.col("k") % 14 != 0, F.col("txn_date")).alias("txn_date"), F.col("net_amount").alias("net_amount"),
                     F.col("txn_date").alias("drop_date"), F.lit("P1").alias("load_id"))
    again = F.struct(F.col("txn_date").alias("txn_date"), lower.alias("net_amount"), F.date_add("txn_date", 1).alias("drop_date"),
                     F.lit("P2").alias("load_id"))
    copies = F.when(F.col("k") % 7 == 0, F.array(first, again)).otherwise(F.array(first))
    sent = base.withColumn("__copy", F.explode(copies))
    return sent.select("txn_id", "__copy.txn_date", "store_code", "sku", "qty", "gross_amount", "__copy.net_amount", "__copy.drop_date",
                       "__copy.load_id", *([F.col("k").alias(order_key)] if order_key else []), *([*carry, "sku_key"] if carry else []))


# Fixed finance labels by order priority (exercise the KPI-category classifier).
PRIORITY_METRIC = {"1-URGENT": "Gross Sales", "2-HIGH": "net sales total", "3-MEDIUM": "COGS - product",
                   "4-NOT SPECIFIED": "Labor Cost", "5-LOW": "Other income"}


def finance_actuals_extract(t: Tables) -> DataFrame:
    """H10 input: one GL-like actual per order with text month and amount."""
    o = t.orders
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        F.when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "MM/dd/yyyy")).alias("month_start_raw"),
        _map(PRIORITY_METRIC, F.col("o_orderpriority")).alias("metric_name_norm"),
        F.when(k % 3 == 0, F.concat(F.lit("$"), _txt(F.col("o_totalprice"), 2))).otherwise(_txt(F.col("o_totalprice"), 2))
         .alias("actual_amount_raw"),
        F.lit("usd").alias("currency_code_norm"))


def store_master_extract(t: Tables) -> DataFrame:
    """H2 input: one master snapshot per order (as-of = order date) of the ordering customer."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.join(model.geography(t).withColumnsRenamed({"state": "n_name", "region": "r_name"}), F.col("c_nationkey") == F.col("n_nationkey"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    return j.select(
        F.when(k % 3 != 0, d).alias("as_of_date"), F.date_format(d, "MM/dd/yyyy").alias("as_of_date_raw"),
        F.date_add(d, 1).alias("drop_date"),
        F.col("c_custkey").cast("string").alias("dispensary_id_norm"),
        F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")).alias("store_code_norm"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.lower("c_name")).alias("dispensary_name_norm"),
        F.when(k % 7 == 0, F.lit("x")).otherwise(F.col("n_name")).alias("state_norm"),
        F.lower("r_name").alias("city_norm"),
        F.when(k % 11 == 0, F.lit(" 123 ")).otherwise(F.lpad(F.col("c_custkey").cast("string"), 5, "0")).alias("postal_code_norm"),
        F.when(k % 6 != 0, F.concat(F.lit(" lic-"), F.col("c_custkey").cast("string"))).alias("license_id_norm"),
        F.when(k % 2 == 0, F.col("c_mktsegment")).alias("account_type_norm"), F.col("c_mktsegment").alias("account_type_raw"))


def distribution_status_extract(t: Tables) -> DataFrame:
    """H3 input: one status row per sale line (status text by units sold)."""
    s = model.sales_lines(t)
    u = F.col("units")
    status = (F.when(u >= 40, F.lit(" In_Distribution")).when(u >= 20, F.lit("CARRIED")).when(u >= 10, F.lit("available"))
              .when(u >= 5, F.lit("Pending_Launch")).when(u >= 2, F.lit("not_listed")).otherwise(F.lit("Retired ")))
    return s.select(
        F.when(F.col("line_number") % 4 != 0, F.col("sale_date")).alias("as_of_date"),
        F.date_format("sale_date", "yyyy-MM-dd").alias("as_of_date_raw"),
        F.col("store_id").cast("string").alias("store_code_norm"), F.col("sku").cast("string").alias("sku_norm"),
        status.alias("distribution_status_norm"), F.col("order_priority").alias("status_reason_norm"),
        F.concat(F.lit("L"), (F.col("order_id") % 2).cast("string")).alias("load_id"))
