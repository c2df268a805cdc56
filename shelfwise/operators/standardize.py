"""Canonical columns of the seven source feeds, whatever their headers are called.

A feed's headers are brought to snake case, alternate names are coalesced into the canonical column, dates and
numbers are cast (numbers after dropping ``$`` and ``,``; anything else unreadable becomes null), missing columns are null, and sales
amounts that a feed lacks are derived from the others (C25). Only schemas are looked at on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MONEY, derive_measures, exact, money, normalise_headers, parse_date


@dataclass(frozen=True)
class Feed:
    """Canonical columns in order, alternate headers (header -> column), and the typed columns."""

    columns: tuple[str, ...]
    aliases: dict[str, str] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()


# The feeds' canonical columns and the headers they arrive under.
FEEDS = {
    "sales": Feed(
        ("sale_date", "store_id", "sku", "product_name", "channel", "qty", "unit_list_price", "discount_rate", "unit_net_price",
         "gross_sales_amount", "discount_amount", "net_sales_amount", "cogs_amount", "order_count", "customer_count",
         "transaction_id", "transaction_ts"),
        {"store_code": "store_id", "site_code": "store_id", "product_sku": "sku", "transaction_date": "sale_date", "txn_date": "sale_date",
         "txn_ts": "transaction_ts", "units_sold": "qty", "unit_price": "unit_list_price", "discount_pct": "discount_rate",
         "gross_sales": "gross_sales_amount", "gross_amount": "gross_sales_amount", "net_sales": "net_sales_amount",
         "net_amount": "net_sales_amount", "cogs": "cogs_amount", "orders": "order_count", "customers": "customer_count",
         "txn_id": "transaction_id"},
        dates=("sale_date",),
        numbers=("qty", "unit_list_price", "discount_rate", "unit_net_price", "gross_sales_amount", "discount_amount",
                 "net_sales_amount", "cogs_amount")),
    "inventory": Feed(
        ("snapshot_date", "site_code", "sku", "on_hand_units", "received_units", "shipped_units", "requested_units", "backordered_units"),
        {"on_hand": "on_hand_units", "receipts": "received_units", "shipments": "shipped_units"}, dates=("snapshot_date",),
        numbers=("on_hand_units", "received_units", "shipped_units", "requested_units", "backordered_units")),
    "shipments": Feed(("ship_date", "shipment_id", "site_code", "sku", "units_shipped", "carrier"), dates=("ship_date",), numbers=("units_shipped",)),
    "payroll": Feed(
        ("work_date", "site_code", "department", "team", "hours_worked", "overtime_hours", "employee_count", "labor_cost_amount"),
        {"week_ending": "work_date", "ot_hours": "overtime_hours", "labor_cost": "labor_cost_amount"}, dates=("work_date",),
        numbers=("hours_worked", "overtime_hours", "employee_count", "labor_cost_amount")),
    "timeclock": Feed(("punch_ts", "punch_date", "employee_id", "site_code", "action"), timestamps=("punch_ts",)),
    "finance_actuals": Feed(("month_start", "metric_name", "actual_amount", "currency_code"), {"currency": "currency_code"},
                            dates=("month_start",), numbers=("actual_amount",)),
    "gl": Feed(("period", "posting_date", "location_code", "account_code", "account_name", "debit_amount", "credit_amount"),
               dates=("posting_date",), numbers=("debit_amount", "credit_amount")),
}


def _named(df: DataFrame, feed: Feed) -> dict[str, Column]:
    """Canonical column -> the first of its headers that has a value."""
    plain = normalise_headers(df)
    out: dict[str, list[Column]] = {}
    for header, source in zip(plain.columns, df.columns, strict=True):
        column = feed.aliases.get(header, header)
        # The canonical header itself goes before alternates.
        out.setdefault(column, []).insert(0 if header == column else len(out.get(column, [])), F.col(f"`{source}`"))
    return {c: F.coalesce(*v) if len(v) > 1 else v[0] for c, v in out.items()}


def standardize(df: DataFrame, kind: str, system: str) -> DataFrame:
    """The canonical rows of one feed (see FEEDS) with its ``source_system``."""
    feed = FEEDS[kind]
    have = _named(df, feed)
    if kind == "sales" and "sale_date" not in have and "transaction_ts" in have:
        have["sale_date"] = F.substring(have["transaction_ts"].cast("string"), 1, 10)
    typed: dict[str, Column] = {}
    for c in feed.columns:
        v = have.get(c)
        if v is None:
            typed[c] = F.lit(None).cast("date" if c in feed.dates else MONEY if c in feed.numbers else "timestamp_ntz" if c in feed.timestamps else "string")
        elif c in feed.dates:
            typed[c] = parse_date(None, v.cast("string"))
        elif c in feed.numbers:
            typed[c] = money(v.cast("string"))
        elif c in feed.timestamps:
            typed[c] = v.cast("string").try_cast("timestamp_ntz")
        else:
            typed[c] = v.cast("string")
    if kind == "sales":
        given = lambda *names: all(n in have for n in names)
        rate = F.coalesce(typed["discount_rate"], F.lit(0))
        if not given("unit_net_price") and given("unit_list_price", "discount_rate"):
            typed["unit_net_price"] = exact(typed["unit_list_price"] * (1 - rate))
        # With net sales at hand the discount is what they leave of gross sales, whatever the rate says.
        known_rate = rate if given("discount_rate") and not given("net_sales_amount") else F.lit(None).cast(MONEY)
        amounts = {"gross_sales_amount": "gross_sales", "discount_amount": "discount_amount", "net_sales_amount": "net_sales"}
        filled = derive_measures(typed["qty"], typed["unit_list_price"], known_rate, *[typed[c] for c in amounts])
        typed |= {c: exact(filled[m]) for c, m in amounts.items() if not given(c)}
    if kind == "timeclock" and "punch_ts" in have:
        typed["punch_date"] = F.to_date(typed["punch_ts"])
    if kind == "gl":
        zero = F.lit(0)
        typed["net_amount"] = F.coalesce(typed["debit_amount"], zero) - F.coalesce(typed["credit_amount"], zero)
    return df.select(*[v.alias(c) for c, v in typed.items()], F.lit(system).alias("source_system"))
