"""Conformed facts and dimensions.

Dimensions are built from key universes (U2: union + distinct) joined with
profiles computed by grouped aggregates; facts aggregate deduplicated rows.
Every join is against an aggregated or size-checked side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MONEY, ratio
from .dedup import clean_first, complete, keep_best, last_value_per_key, newest_first


# The type of a sum of amounts (MONEY).
DAY_SUM = "decimal(28,4)"


def pos_daily(pos: DataFrame, date: str = "txn_date", keys: Sequence[str] = ("store_code", "sku"),
              deduplicated: bool = False) -> DataFrame:
    """POS lines → (day, store, sku): lines, distinct transactions, units, sales.

    ``deduplicated`` says that a transaction id stands in one row only (D5): distinct ids are then plainly counted.
    """
    ids = F.count("txn_id") if deduplicated else F.count_distinct("txn_id")
    return pos.groupBy(date, *keys).agg(
        F.count(F.lit(1)).alias("pos_lines"), ids.alias("pos_transactions"),
        F.sum("qty").alias("units"), F.sum("gross_amount").alias("gross_sales"), F.sum("net_amount").alias("net_sales"))


def distributor_daily(dist: DataFrame, grain: Sequence[str] = ("sale_date", "store_code", "sku", "channel")) -> DataFrame:
    """M7: distributor rows → daily fact with volume-weighted prices (A6) and any-value labels."""
    q = F.col("qty")
    g = dist.groupBy(*grain).agg(
        F.sum(q).alias("units"), F.sum("gross_sales").alias("gross_sales"),
        F.sum("discount_amount").alias("discount_amount"), F.sum("net_sales").alias("net_sales"),
        F.sum("cogs").alias("cogs"), F.max("product_name").alias("product_name"),
        F.sum(F.coalesce("orders", F.lit(0))).alias("orders"), F.sum(F.coalesce("customers", F.lit(0))).alias("customers"),
        F.sum(F.col("unit_list_price") * q).alias("__lp_q"), F.sum(F.when(F.col("unit_list_price").isNotNull(), q)).alias("__q_lp"),
        F.sum(F.coalesce("unit_net_price", F.lit(0)) * F.coalesce(q, F.lit(0))).alias("__np_q"),
        F.count(F.lit(1)).alias("source_rows"), F.max("load_id").alias("any_load_id"))
    return g.withColumns({
        "weighted_list_price": ratio("__lp_q", "__q_lp"),
        "weighted_net_price": ratio("__np_q", "units"),
        "implied_net_price": ratio("net_sales", "units"),
        "implied_discount_rate": ratio("discount_amount", "gross_sales"),
    }).drop("__lp_q", "__q_lp", "__np_q")


def distributor_sums(dist: DataFrame, measures: Sequence[str],
                     grain: Sequence[str] = ("sale_date", "store_code", "sku", "channel")) -> DataFrame:
    """M7 with some of its sums only (units, orders, customers or amounts), from deduplicated rows (D1) that hold just their
    columns: with one row per grain, a sum is the row's value in the sum's type."""
    value = {"units": F.col("qty"), **{c: F.coalesce(c, F.lit(0)) for c in ("orders", "customers")}}
    cast = {c: "long" for c in ("units", "orders", "customers")}
    return dist.select(*grain, *[value.get(m, F.col(m)).cast(cast.get(m, DAY_SUM)).alias(m) for m in measures])


# Rows up to which a lookup table may be sent whole to every executor by way of the driver (some 30 MB of products).
LOOKUP_ROWS = 500_000


def lookup(table: DataFrame) -> DataFrame:
    """A stored ``table`` to join on its key. Spark weighs it by its compressed bytes and the types of the columns that are left, so
    that millions of narrow rows can pass for a table to broadcast: beyond a counted bound its joins are dealt by key and merged."""
    return table.hint("merge") if table.count() > LOOKUP_ROWS else table


def store_lists(stores: DataFrame) -> DataFrame:
    """One row per store: a list of its rows' context (repeated stores have several), for rows to carry."""
    return stores.filter(F.col("store_code").isNotNull()).groupBy("store_code").agg(F.collect_list(F.struct("state")).alias("stores"))


def conformed_sales(distributor: DataFrame, pos_day: DataFrame, products: DataFrame,
                    grain: Sequence[str] = ("sale_date", "store_code", "sku", "channel"), key: str = "sku_key") -> DataFrame:
    """Distributor daily ∪ POS daily with a source label, product label, store context and
    missing-dimension flags (J15).

    Both facts carry their store's rows (``stores`` of ``store_lists``, null without one), put to the orders before their lines
    multiply, and the stored product ``key``, by which they may already be dealt: neither lookup moves the facts again. A union of
    facts that are dealt alike stays so, and one task has both facts' rows of a product.
    """
    d = distributor.select(*grain, "units", "gross_sales", "discount_amount", "net_sales", "cogs", "orders",
                           F.lit("distributor").alias("source_system"), key, "stores")
    # POS lines carry no cost; what the net amount leaves of the gross one is their discount, a transaction is an order.
    p = pos_day.select("sale_date", "store_code", "sku", F.lit("retail").alias("channel"), "units", "gross_sales",
                       (F.col("gross_sales") - F.col("net_sales")).alias("discount_amount"), "net_sales",
                       F.lit(None).cast(MONEY).alias("cogs"), F.col("pos_transactions").alias("orders"), F.lit("pos").alias("source_system"),
                       key, "stores")
    prod = products.select(key, "product_name", F.lit(True).alias("__p"))
    u = d.unionByName(p).join(prod, key, "left")
    j = u.select("*", F.explode_outer("stores").alias("__st")).withColumns({"state": F.col("__st.state"), "__s": F.col("stores")})
    return j.select("store_code", "sku", *[c for c in u.columns if c not in ("store_code", "sku", key, "stores")], "state", "__s").withColumns({
        "product_label": F.coalesce(F.col("product_name"), F.concat(F.lit("Unknown "), F.col("sku"))),
        "is_missing_date": F.col("sale_date").isNull(), "is_missing_store": F.col("__s").isNull(),
        "is_missing_sku": F.col("__p").isNull(), "is_missing_channel": F.col("channel").isNull(),
    }).drop("__p", "__s")


def store_day_agg(conformed: DataFrame, date: str = "sale_date", store: str = "store_code") -> DataFrame:
    """Store-day totals with source split (A4), distinct SKUs and channels (A2), cost coverage and margin."""
    src = F.col("source_system")
    total = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    g = conformed.groupBy(date, store).agg(
        total("net_sales").alias("net_sales"), total("gross_sales").alias("gross_sales"), total("discount_amount").alias("discount_amount"),
        total("units").alias("units"), total("orders").alias("orders"), total("cogs").alias("cogs"), F.count("cogs").alias("rows_with_cogs"),
        F.sum(F.when(src == "distributor", F.col("net_sales"))).alias("distributor_net_sales"),
        F.sum(F.when(src == "pos", F.col("net_sales"))).alias("pos_net_sales"),
        # As sets (what one store sells in a day): two distinct counts would send every row three times.
        F.size(F.collect_set("sku")).cast("long").alias("distinct_skus"),
        F.size(F.collect_set("channel")).cast("long").alias("distinct_channels"),
        F.count(F.lit(1)).alias("fact_rows"))
    profit = F.col("net_sales") - F.col("cogs")
    return g.withColumns({"gross_profit": profit, "gross_margin_pct": ratio(profit, "net_sales")})


def sku_dimension(key_sources: Sequence[DataFrame], sales: DataFrame, status: DataFrame | None = None,
                  sku: str = "sku", date: str = "sale_date") -> DataFrame:
    """M3: SKU key universe (U2) ⟕ first / last sale and units ⟕ current status."""
    keys = None
    for s in key_sources:
        k = s.select(F.col(sku).cast("string").alias(sku)).filter(F.col(sku).isNotNull())
        keys = k if keys is None else keys.union(k)
    keys = keys.distinct()
    prof = sales.groupBy(F.col(sku).cast("string").alias(sku)).agg(
        F.min(date).alias("first_sale_date"), F.max(date).alias("last_sale_date"), F.sum("units").alias("lifetime_units"))
    out = keys.join(prof, sku, "left")
    if status is not None:
        cur = keep_best(status, [sku], [("as_of_date", "desc")], count_col="status_versions")
        out = out.join(cur.select(sku, F.col("status").alias("current_status"), "status_versions"), sku, "left")
    return out.withColumn("has_sales", F.col("first_sale_date").isNotNull())


def employee_dimension(daily: DataFrame, punches: DataFrame, store: str = "store_code", emp: str = "employee_id",
                       date: str = "work_date") -> DataFrame:
    """M4: span, days, hours, punches, last store (D13 with a tie-break), average hours."""
    prof = daily.groupBy(emp).agg(F.min(date).alias("first_work_date"), F.max(date).alias("last_work_date"),
                                  F.count_distinct(date).alias("days_worked"), F.sum("hours_worked").alias("total_hours"))
    p = punches.groupBy(emp).agg(F.count(F.lit(1)).alias("punch_count"))
    last = last_value_per_key(daily.select(emp, store, date), [emp], store, date, "last_store_code")
    keys = daily.select(emp).union(punches.select(emp)).distinct()
    out = keys.join(prof, emp, "left").join(p, emp, "left").join(last, emp, "left")
    return out.withColumn("avg_hours_per_day", ratio("total_hours", "days_worked"))


def inventory_snapshot_fact(inv: DataFrame, grain: Sequence[str] = ("snapshot_date", "site_id", "sku")) -> DataFrame:
    """One snapshot per complete grain: clean keys, then non-negative on-hand, then the newest load."""
    return keep_best(complete(inv, grain), grain,
                     [*clean_first(inv, "is_missing_key"), (F.coalesce(F.col("on_hand_units") < 0, F.lit(False)), "asc"),
                      *newest_first(inv)])


def finance_monthly(staged: DataFrame) -> DataFrame:
    """Monthly actuals by KPI category with the unmapped-row count."""
    return staged.groupBy("period_month", "kpi_category").agg(
        F.sum("actual_amount").alias("actual_amount"), F.count(F.lit(1)).alias("source_rows"),
        F.count_if("is_unmapped_metric").alias("unmapped_rows"))


def multi_level_summary(df: DataFrame, levels: Sequence[Sequence[str]], measures: dict[str, Column],
                        level_col: str = "summary_level") -> DataFrame:
    """Several group-by levels stacked with a level label (GROUPING SETS + grouping_id)."""
    all_cols: list[str] = []
    for lv in levels:
        all_cols += [c for c in lv if c not in all_cols]
    gid = F.grouping_id(*all_cols)
    label = None
    for lv in levels:
        bits = sum(1 << (len(all_cols) - 1 - i) for i, c in enumerate(all_cols) if c not in lv)
        name = "+".join(lv) if lv else "total"
        label = F.when(gid == bits, F.lit(name)) if label is None else label.when(gid == bits, F.lit(name))
    g = df.groupingSets([list(lv) for lv in levels], *all_cols).agg(
        *[m.alias(k) for k, m in measures.items()], label.alias(level_col))
    return g.select(*all_cols, level_col, *measures)


def store_dimension(master_latest: DataFrame, status_current: DataFrame, key: str = "store_code") -> DataFrame:
    """M2: latest complete master ⟕ current account status, with activity flags."""
    st = status_current.select(key, "account_status", F.col("status_date").alias("account_status_date"))
    j = master_latest.join(st, key, "left")
    return j.withColumns({"is_active": F.coalesce(F.col("account_status") == "active", F.lit(False)),
                          "has_status": F.col("account_status").isNotNull()})


def with_product_label(df: DataFrame, products: DataFrame, sku: str = "sku", name: str = "product_name",
                       out: str = "product_label") -> DataFrame:
    """Product label from the product dimension, falling back to ``Unknown <sku>``."""
    p = products.select(sku, name)
    return df.join(p, sku, "left").withColumn(out, F.coalesce(F.col(name), F.concat(F.lit("Unknown "), F.col(sku))))


def product_dimension(key_sources: Sequence[DataFrame], products: DataFrame, sku: str = "sku") -> DataFrame:
    """Product key universe from every fact (U2) with labels (``Unknown <sku>`` when missing)."""
    keys = None
    for s in key_sources:
        k = s.select(F.col(sku).cast("string").alias(sku))
        keys = k if keys is None else keys.union(k)
    keys = keys.filter(F.col(sku).isNotNull()).distinct()
    out = with_product_label(keys, products, sku)
    return out.withColumn("is_known_product", F.col("product_name").isNotNull())
