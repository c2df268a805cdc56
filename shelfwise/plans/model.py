"""How the driver's TPC-H-like test tables play the roles of the retail model.

Role mapping (stated assumptions, identical in the SQL oracle):

* sales line   = ``lineitem`` row; date = ``o_orderdate``; units = ``l_quantity``;
  gross = ``l_extendedprice``; discount = gross × ``l_discount``; net = gross − discount
* COGS         = ``l_quantity × p_retailprice × 0.6``
* store/account = ``customer``; state = nation name; region = region name;
  channel = lower(``c_mktsegment``)
* SKU          = ``part``; category = ``p_type``; promo = ``p_type = 'PROMO'``;
  pack size = ``p_size``; brand = ``p_brand``
* shipment / inventory site = ``supplier``; ship date = ``l_shipdate``
* ledger       = ``orders.o_totalprice`` by order date and customer
* punches      = ``events``: employee = ``user_id``; store = ``S`` + (user_id mod 8);
  ``click`` = IN, ``view`` = OUT
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MONEY, exact
from ..operators.calendar import latest_date
from ..sources.testdata import Tables

COGS_RATIO = 0.6
N_PUNCH_STORES = 8
PUNCH_ACTIONS = {"CLICK": "IN", "VIEW": "OUT"}


def geography(t: Tables) -> DataFrame:
    """nation × region."""
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")) \
        .select(F.col("n_nationkey"), F.col("n_name").alias("state"), F.col("r_name").alias("region"))


def stores(t: Tables) -> DataFrame:
    """Account / store dimension."""
    return t.customer.join(geography(t), F.col("c_nationkey") == F.col("n_nationkey")) \
        .select(F.col("c_custkey").alias("store_id"), F.col("c_name").alias("store_name"),
                "state", "region", F.lower("c_mktsegment").alias("channel"),
                exact("c_acctbal").alias("acct_balance"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("sku"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_size").alias("pack_size"), exact("p_retailprice").alias("list_price"),
        (F.col("p_type") == F.lit("PROMO")).alias("promo_flag"))


def on_day(df: DataFrame, column: str, day) -> DataFrame:
    """Rows of one day as a range of the stored column, so that the bounds reach the scan (all rows without a day)."""
    if day is None:
        return df
    stored = df.schema[column].dataType
    return df.filter((F.col(column) >= F.lit(str(day)).cast(stored)) & (F.col(column) < F.lit(str(day + dt.timedelta(days=1))).cast(stored)))


def sales_lines(t: Tables, since=None, on=None, carry=()) -> DataFrame:
    """One row per sale line with dimensions attached; with ``since`` only sales from that date on, with ``on`` of that date.
    ``carry`` names further columns of the orders.

    lineitem ⋈ orders is the only fact-to-fact join (sort-merge on the order
    key); Spark picks the strategy of the dimension joins from run-time sizes.
    Column pruning and the date bound (on the stored column) reach the scans.
    """
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", *carry)
    if since is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(str(since)).cast(o.schema["o_orderdate"].dataType))
    o = on_day(o, "o_orderdate", on)
    cust = t.customer.select(F.col("c_custkey").alias("store_id"), F.col("c_name").alias("store_name"),
                             "c_nationkey", F.lower("c_mktsegment").alias("channel"))
    # The account joins the order headers, which are fewer than their lines: the lines move by order and by product only.
    o = o.join(cust, F.col("o_custkey") == F.col("store_id")).join(geography(t), F.col("c_nationkey") == F.col("n_nationkey"))
    base = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(products(t), F.col("l_partkey") == F.col("sku"))
    sale_date = F.col("o_orderdate").cast("date")
    # Prices and rates are doubles of two digits: a product's error is far below half of the fourth digit, so the cast gives the
    # exact amount, at half the cost of a product of decimals.
    price, rate = F.col("l_extendedprice"), F.col("l_discount")
    cogs = F.col("l_quantity") * F.col("list_price").cast("double") * F.lit(COGS_RATIO)
    return base.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        sale_date.alias("sale_date"), F.trunc(sale_date, "month").alias("month_start"),
        F.date_trunc("week", sale_date).cast("date").alias("week_start"),
        "store_id", "store_name", "state", "region", "channel",
        "sku", "product_name", "brand", "category", "pack_size", "promo_flag", "list_price",
        F.col("l_suppkey").alias("site_id"), F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("l_quantity").alias("units"),
        price.cast(MONEY).alias("gross_sales"), (price * rate).cast(MONEY).alias("discount_amount"),
        (price * (1 - rate)).cast(MONEY).alias("net_sales"), cogs.cast(MONEY).alias("cogs"), *carry,
    )


def latest_sale_date(t: Tables):
    """Date of the latest order with a line: resolved once from two key columns, passed on as a literal."""
    return latest_date(t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi"), "o_orderdate")


def ledger(t: Tables) -> DataFrame:
    """Order headers as the ledger side of sales-to-ledger reconciliations."""
    d = F.col("o_orderdate").cast("date")
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("store_id"),
                           d.alias("posting_date"), F.trunc(d, "month").alias("period_month"),
                           exact("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"))


def punches(t: Tables) -> DataFrame:
    """Time-clock punches from the event stream."""
    from ..functions.clean import map_synonyms
    e = t.events
    return e.select(
        F.col("event_id").alias("punch_id"),
        F.concat(F.lit("S"), F.lpad((F.col("user_id") % N_PUNCH_STORES).cast("string"), 2, "0")).alias("store_code"),
        F.col("user_id").alias("employee_id"),
        F.col("ts").alias("punch_ts"),
        F.col("ts").cast("date").alias("work_date"),
        F.col("event_type").alias("action_raw"),
        map_synonyms(F.col("event_type"), PUNCH_ACTIONS).alias("action"),
        F.col("value").alias("value"),
    )


# Fixed labels used to turn order status into account-status text.
STATUS_TEXT = {"F": "Active", "O": "Pending approval", "P": "INACTIVE - closed"}


def account_status_history(t: Tables) -> DataFrame:
    """Account status events: one per order (date, customer, status text).

    Odd order keys carry padded text so the staging trim / classify is exercised.
    """
    o = t.orders
    label = F.create_map(*[F.lit(x) for kv in STATUS_TEXT.items() for x in kv])[F.col("o_orderstatus")]
    padded = F.when(F.col("o_orderkey") % 2 == 1, F.concat(F.lit("  "), label, F.lit(" "))).otherwise(label)
    return o.select(F.col("o_orderkey").alias("load_seq"),
                    F.col("o_custkey").alias("store_code"),
                    F.col("o_orderdate").cast("date").alias("status_date"),
                    padded.alias("account_status_raw"))


def shipments(t: Tables) -> DataFrame:
    """WMS-like shipments: one per line; line 1 of an order has no shipment id."""
    li = t.lineitem
    sid = F.when(F.col("l_linenumber") != 1,
                 F.concat(F.lit("SH"), F.col("l_orderkey").cast("string"), F.lit("-"),
                          F.col("l_linenumber").cast("string")))
    return li.select(sid.alias("shipment_id"),
                     F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("load_id"),
                     F.col("l_shipdate").cast("date").alias("ship_date"),
                     F.col("l_suppkey").alias("site_id"), F.col("l_partkey").alias("sku"),
                     F.col("l_quantity").alias("units_shipped"),
                     F.col("l_returnflag").alias("carrier"))


def raw_orders_text(t: Tables) -> DataFrame:
    """Orders rendered as an all-text extract with mixed formats and blanks.

    Even keys: ISO dates and plain amounts; odd keys: ``MM/dd/yyyy`` dates and
    ``$``-prefixed amounts with thousands separators stripped of nothing; keys
    divisible by 7: blank dates; every 11th: junk text in the amount.
    """
    o = t.orders
    k = F.col("o_orderkey")
    d = F.col("o_orderdate").cast("date")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    date_txt = (F.when(k % 7 == 0, F.lit("  "))
                .when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd"))
                .otherwise(F.date_format(d, "MM/dd/yyyy")))
    amt_txt = (F.when(k % 11 == 0, F.lit("n/a"))
               .when(k % 2 == 1, F.concat(F.lit("$"), amount))
               .otherwise(amount))
    cust_txt = F.when(k % 3 == 0, F.concat(F.lit(" c-"), F.col("o_custkey").cast("string"), F.lit(" ")))\
        .otherwise(F.col("o_custkey").cast("string"))
    prio_txt = F.when(k % 2 == 1, F.lower(F.col("o_orderpriority"))).otherwise(
        F.concat(F.col("o_orderpriority"), F.lit("  ")))
    return o.select(k.cast("string").alias("order_id_raw"), date_txt.alias("order_date_raw"),
                    amt_txt.alias("total_raw"), cust_txt.alias("customer_raw"),
                    prio_txt.alias("priority_raw"), F.col("o_orderstatus").alias("status_raw"))


def inventory(t: Tables, on=None) -> DataFrame:
    """Inventory snapshots: one per line at ship date, supplier site and SKU.

    on hand = quantity − 10 (so some snapshots are negative / out of stock);
    the typed in-stock flag is missing on even line numbers.
    """
    li = on_day(t.lineitem, "l_shipdate", on)
    sup = t.supplier.join(geography(t), F.col("s_nationkey") == F.col("n_nationkey")) \
        .select(F.col("s_suppkey"), F.col("state"))
    base = li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")) \
        .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    d = F.col("l_shipdate").cast("date")
    on_hand = F.col("l_quantity") - F.lit(10.0)
    return base.select(
        d.alias("snapshot_date"), F.trunc(d, "month").alias("month_start"),
        F.col("l_suppkey").alias("site_id"), F.col("l_partkey").alias("sku"),
        F.col("state"), F.col("p_type").alias("category"),
        on_hand.alias("on_hand_units"), F.col("l_quantity").alias("received_units"),
        F.when(F.col("l_linenumber") % 2 == 1, on_hand > 0).alias("in_stock_flag"))


# The event stream covers January 2024 while sales end in 2001: for labor-vs-sales
# KPIs the punch timeline is shifted back by a fixed number of days so that it
# ends on the sales horizon (2024-01-01 → 2001-07-01).  Stated, fixed parameter.
LABOR_SHIFT_DAYS = 8219
LABOR_RATE_PER_HOUR = 20.0


def punches_aligned(t: Tables) -> DataFrame:
    p = punches(t)
    ts = F.col("punch_ts") - F.expr(f"INTERVAL {LABOR_SHIFT_DAYS} DAYS")
    return p.withColumns({"punch_ts": ts, "work_date": ts.cast("date")})


def punch_store_of(store_id):
    """Sales accounts mapped onto the punch stores (same rule as the punch store assignment)."""
    return F.concat(F.lit("S"), F.lpad((store_id % N_PUNCH_STORES).cast("string"), 2, "0"))
