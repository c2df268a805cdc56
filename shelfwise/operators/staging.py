"""Per-source staging operators (H1–H12) and row-quality flags.

Each takes the raw landing frame (typed + ``*_raw`` + ``*_norm`` columns, see
FIXTURES.md) and returns typed, canonical, flagged rows.  Pure projections
except the duplicate-candidate flag, which is a partial-combined group count
joined back (``dedup.duplicate_candidates``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from .dedup import duplicate_candidates


def _opt(df: DataFrame, name: str, cast: str | None = None) -> Column:
    """Column if present in the frame, else a typed null (header drift tolerant)."""
    if name in df.columns:
        return F.col(name) if cast is None else F.col(name).cast(cast)
    return F.lit(None).cast(cast or "string").alias(name)


# G1 / G5 / G6 / G7 / G8 / G9 ------------------------------------------------
def is_missing_key(cols: Sequence[str]) -> Column:
    return C.any_true(F.col(c).isNull() for c in cols)


def is_bad_amount(gross: str = "gross_sales", net: str = "net_sales", discount: str = "discount_amount",
                  cogs: str = "cogs") -> Column:
    """Negative amounts, net above gross (+0.01), or net + discount ≠ gross (±0.50)."""
    g, n, d, c = F.col(gross), F.col(net), F.col(discount), F.col(cogs)
    neg = C.any_true([g < 0, n < 0, d < 0, c < 0])
    over = n > g + F.lit(0.01)
    unbalanced = F.abs((n + d) - g) > F.lit(0.50)
    return F.coalesce(neg, F.lit(False)) | F.coalesce(over, F.lit(False)) | F.coalesce(unbalanced, F.lit(False))


def is_bad_state_code(c: str = "state") -> Column:
    return F.coalesce(F.length(F.col(c)) != 2, F.lit(False))


def is_bad_postal_code(c: str = "postal_code") -> Column:
    return F.coalesce(F.length(F.col(c)) < 5, F.lit(False))


def is_bad_action(c: str = "action", vocabulary: Sequence[str] = ("IN", "OUT")) -> Column:
    """A word outside the vocabulary; a missing action is a missing key, not a bad one."""
    return F.coalesce(~F.col(c).isin(*vocabulary), F.lit(False))


# H1 -------------------------------------------------------------------------
def stage_account_status(raw: DataFrame) -> DataFrame:
    """H1: typed status date, canonical status bucket, missing-key and duplicate flags."""
    status_src = F.coalesce(_opt(raw, "account_status_norm"), _opt(raw, "account_status_raw"))
    out = raw.select(
        _opt(raw, "load_id"), _opt(raw, "drop_date", "date").alias("drop_date"),
        C.parse_date(_opt(raw, "status_date", "date"), _opt(raw, "status_date_raw")).alias("status_date"),
        _opt(raw, "status_date_raw").alias("status_date_raw"),
        C.blank_to_null(F.coalesce(_opt(raw, "store_code_norm"), _opt(raw, "store_code_raw"))).alias("store_code"),
        C.account_status(status_src).alias("account_status"),
        _opt(raw, "account_status_raw").alias("account_status_raw"),
        C.blank_to_null(_opt(raw, "status_reason_norm")).alias("status_reason"),
    )
    out = out.withColumn("is_missing_key", is_missing_key(["status_date", "store_code", "account_status"]))
    return duplicate_candidates(out, ["load_id", "status_date", "store_code", "account_status"])


# H4 -------------------------------------------------------------------------
def stage_sales_distributor(raw: DataFrame, flag_duplicates: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """H4: typed sale rows with channel bucket, bad-amount, missing-key, duplicate flags; columns in ``carry`` stay as they are.

    The duplicate flag costs a second evaluation of the rows; a dedup that follows does not need it.
    """
    qty = C.lenient_int(_opt(raw, "qty", "int"), _opt(raw, "qty_raw"))
    gross = C.lenient_decimal(_opt(raw, "gross_sales", C.MONEY), _opt(raw, "gross_sales_raw"))
    disc = C.lenient_decimal(_opt(raw, "discount_amount", C.MONEY), _opt(raw, "discount_amount_raw"))
    net = C.lenient_decimal(_opt(raw, "net_sales", C.MONEY), _opt(raw, "net_sales_raw"))
    cogs = C.lenient_decimal(_opt(raw, "cogs", C.MONEY), _opt(raw, "cogs_raw"))
    out = raw.select(
        _opt(raw, "load_id"), _opt(raw, "drop_date", "date").alias("drop_date"),
        _opt(raw, "ingested_at", "timestamp_ntz").alias("ingested_at"),
        C.parse_date(_opt(raw, "sale_date", "date"), _opt(raw, "sale_date_raw")).alias("sale_date"),
        C.blank_to_null(_opt(raw, "store_id_norm")).alias("store_code"),
        C.blank_to_null(_opt(raw, "sku")).alias("sku"),
        C.classify_channel(_opt(raw, "channel_norm")).alias("channel"),
        qty.alias("qty"),
        C.lenient_decimal(_opt(raw, "unit_list_price", C.MONEY), _opt(raw, "unit_list_price_raw")).alias("unit_list_price"),
        gross.alias("gross_sales"), disc.alias("discount_amount"), net.alias("net_sales"), cogs.alias("cogs"),
        C.blank_to_null(F.coalesce(_opt(raw, "product_name_norm"), _opt(raw, "product_name_raw"))).alias("product_name"),
        C.lenient_decimal(_opt(raw, "discount_rate", C.MONEY), _opt(raw, "discount_rate_raw")).alias("discount_rate"),
        C.lenient_decimal(_opt(raw, "unit_net_price", C.MONEY), _opt(raw, "unit_net_price_raw")).alias("unit_net_price"),
        C.lenient_int(_opt(raw, "orders", "int"), _opt(raw, "orders_raw")).alias("orders"),
        C.lenient_int(_opt(raw, "customers", "int"), _opt(raw, "customers_raw")).alias("customers"), *carry,
    )
    out = out.withColumns({
        "is_bad_amount": is_bad_amount(),
        "is_missing_key": is_missing_key(["sale_date", "store_code", "sku", "channel"]),
    })
    if not flag_duplicates:
        return out
    return duplicate_candidates(out, ["load_id", "sale_date", "store_code", "sku", "channel",
                                      F.coalesce(F.col("qty"), F.lit(-1)),
                                      F.coalesce(F.col("net_sales"), F.lit(-1.0))])


# H5 -------------------------------------------------------------------------
def stage_pos(raw: DataFrame) -> DataFrame:
    """H5: POS lines with trimmed codes and duplicate transaction flag."""
    out = raw.select(
        F.col("txn_id"), C.parse_ts(_opt(raw, "txn_ts_parsed", "timestamp_ntz"), _opt(raw, "txn_ts_raw")).alias("txn_ts"),
        _opt(raw, "txn_date", "date").alias("txn_date"),
        C.blank_to_null(_opt(raw, "store_code_norm")).alias("store_code"),
        C.blank_to_null(_opt(raw, "product_sku_norm")).alias("sku"),
        C.lenient_int(_opt(raw, "qty", "int"), _opt(raw, "qty_raw")).alias("qty"),
        C.lenient_decimal(_opt(raw, "gross_amount", C.MONEY), _opt(raw, "gross_amount_raw")).alias("gross_amount"),
        C.lenient_decimal(_opt(raw, "net_amount", C.MONEY), _opt(raw, "net_amount_raw")).alias("net_amount"),
        C.lenient_decimal(_opt(raw, "unit_price", C.MONEY), _opt(raw, "unit_price_raw")).alias("unit_price"),
        C.lenient_decimal(_opt(raw, "discount_pct", C.MONEY), _opt(raw, "discount_pct_raw")).alias("discount_pct"),
        _opt(raw, "load_id"), _opt(raw, "ingested_at", "timestamp_ntz").alias("ingested_at"),
    )
    out = out.withColumn("txn_date", F.coalesce(F.col("txn_date"), F.to_date("txn_ts")))
    out = out.withColumn("is_missing_key", is_missing_key(["txn_id", "txn_date", "store_code", "sku"]))
    return duplicate_candidates(out, ["txn_id"])


# H6 -------------------------------------------------------------------------
def stage_inventory_erp(raw: DataFrame) -> DataFrame:
    """H6: snapshot with receipts → received, shipments → shipped, clamps and flags."""
    def li(name):
        return C.lenient_int(_opt(raw, name, "int"), _opt(raw, name + "_raw"))
    out = raw.select(
        C.parse_date(_opt(raw, "snapshot_date", "date"), _opt(raw, "snapshot_date_raw")).alias("snapshot_date"),
        C.blank_to_null(_opt(raw, "site_code_norm")).alias("site_code"),
        C.blank_to_null(_opt(raw, "sku").cast("string")).alias("sku"),
        li("on_hand").alias("on_hand_units_raw"), li("receipts").alias("received_units"),
        li("shipments").alias("shipped_units"), li("requested_units").alias("requested_units"),
        li("backordered_units").alias("backordered_units"),
        _opt(raw, "load_id"), _opt(raw, "ingested_at", "timestamp_ntz").alias("ingested_at"),
    )
    return out.withColumns({
        "on_hand_units": C.nonneg(F.col("on_hand_units_raw")),
        "is_negative_on_hand": F.coalesce(F.col("on_hand_units_raw") < 0, F.lit(False)),
        "is_missing_units": F.col("on_hand_units_raw").isNull(),
        "in_stock_flag": F.coalesce(F.col("on_hand_units_raw") > 0, F.lit(False)),
        "is_missing_key": is_missing_key(["snapshot_date", "site_code", "sku"]),
    })


# H7 -------------------------------------------------------------------------
def stage_wms_shipments(raw: DataFrame) -> DataFrame:
    """H7: typed shipment rows with negative / missing flags."""
    out = raw.select(
        C.parse_date(_opt(raw, "ship_date", "date"), _opt(raw, "ship_date_raw")).alias("ship_date"),
        C.blank_to_null(_opt(raw, "shipment_id_norm")).alias("shipment_id"),
        C.blank_to_null(_opt(raw, "site_code_norm")).alias("site_code"),
        C.blank_to_null(_opt(raw, "sku_norm")).alias("sku"),
        C.lenient_int(_opt(raw, "units_shipped", "int"), _opt(raw, "units_shipped_raw")).alias("units_shipped"),
        C.blank_to_null(_opt(raw, "carrier_norm")).alias("carrier"),
        _opt(raw, "load_id"),
    )
    out = out.withColumns({
        "is_negative_units": F.coalesce(F.col("units_shipped") < 0, F.lit(False)),
        "is_missing_units": F.col("units_shipped").isNull(),
        "is_missing_key": is_missing_key(["ship_date", "site_code", "sku"]),
    })
    return duplicate_candidates(out, ["load_id", "ship_date", "shipment_id", "site_code", "sku"])


# H8 -------------------------------------------------------------------------
def stage_timeclock(raw: DataFrame, synonyms: dict[str, str] = C.ACTION_SYNONYMS) -> DataFrame:
    """H8: punch timestamp / date, canonical action, bad-action and duplicate flags."""
    ts = C.parse_ts(_opt(raw, "punch_ts_parsed", "timestamp_ntz"), _opt(raw, "punch_ts_raw"))
    out = raw.select(
        ts.alias("punch_ts"),
        F.coalesce(_opt(raw, "punch_date", "date"), C.date_from_ts_prefix(_opt(raw, "punch_ts_raw")),
                   F.to_date(ts)).alias("punch_date"),
        C.lenient_int(_opt(raw, "employee_id", "int"), _opt(raw, "employee_id_raw")).alias("employee_id"),
        C.blank_to_null(_opt(raw, "site_code_norm")).alias("store_code"),
        C.map_synonyms(F.coalesce(_opt(raw, "action_norm"), _opt(raw, "action_raw")), synonyms).alias("action"),
        _opt(raw, "load_id"),
    )
    out = out.withColumns({
        "is_bad_action": is_bad_action("action"),
        "is_missing_key": is_missing_key(["punch_ts", "punch_date", "employee_id", "store_code", "action"]),
    })
    return duplicate_candidates(out, ["load_id", "punch_ts", "store_code", "employee_id", "action"])


# H9 -------------------------------------------------------------------------
def stage_labor_payroll(raw: DataFrame) -> DataFrame:
    """H9: weekly payroll rows with team synonyms and missing flags."""
    out = raw.select(
        C.parse_date(_opt(raw, "week_ending", "date"), _opt(raw, "week_ending_raw")).alias("week_ending"),
        C.blank_to_null(_opt(raw, "site_code_norm")).alias("site_code"),
        C.canon(_opt(raw, "department_norm"), "lower").alias("department"),
        C.map_synonyms(_opt(raw, "team_norm"), C.TEAM_SYNONYMS, fold="lower").alias("team"),
        C.lenient_decimal(_opt(raw, "hours_worked", C.MONEY), _opt(raw, "hours_worked_raw")).alias("hours_worked"),
        C.lenient_decimal(_opt(raw, "ot_hours", C.MONEY), _opt(raw, "ot_hours_raw")).alias("ot_hours"),
        C.lenient_decimal(_opt(raw, "labor_cost", C.MONEY), _opt(raw, "labor_cost_raw")).alias("labor_cost"),
        C.lenient_int(_opt(raw, "employee_count", "int"), _opt(raw, "employee_count_raw")).alias("employee_count"),
    )
    return out.withColumn("is_missing_department_or_team", F.col("department").isNull() | F.col("team").isNull())


# H10 ------------------------------------------------------------------------
def stage_finance_actuals(raw: DataFrame) -> DataFrame:
    """Period month, metric label → KPI category, amount, unmapped flag."""
    month = C.period_start(C.parse_date(_opt(raw, "month_start", "date"), _opt(raw, "month_start_raw")), "month")
    out = raw.select(
        month.alias("period_month"),
        C.canon(_opt(raw, "metric_name_norm"), "lower").alias("metric_name"),
        C.lenient_decimal(_opt(raw, "actual_amount", C.MONEY), _opt(raw, "actual_amount_raw")).alias("actual_amount"),
        C.canon(_opt(raw, "currency_code_norm"), "upper").alias("currency_code"),
        _opt(raw, "store_code"),
    )
    out = out.withColumn("kpi_category", C.map_metric(F.col("metric_name")))
    return out.withColumns({
        "is_unmapped_metric": F.col("kpi_category") == "unknown",
        "is_missing_key": is_missing_key(["period_month", "metric_name"]),
    })


# H11 ------------------------------------------------------------------------
def stage_text_casts(raw: DataFrame, types: dict[str, str]) -> DataFrame:
    """All-text quarterly extracts → typed columns (trim, blank → null, try_cast)."""
    cols = []
    for c in raw.columns:
        cols.append(C.cast_trim(c, types[c]).alias(c) if c in types else C.blank_to_null(c).alias(c))
    return raw.select(*cols)


# H12 ------------------------------------------------------------------------
FORECAST_NUMERIC = ("forecast_units", "actual_units", "forecast_net_sales", "actual_net_sales",
                    "forecast_unit_price", "actual_unit_price")
FORECAST_FLAGS = ("promo_flag", "stockout_flag", "is_partial_actual")
FORECAST_WORDS = ("channel", "seasonality_label", "business_event")


def stage_forecast_weekly(raw: DataFrame) -> DataFrame:
    """Weekly forecast / actual text → typed, booleans from vocabulary."""
    cols = []
    for c in raw.columns:
        if c == "week_start_date":
            cols.append(C.cast_trim(c, "date").alias(c))
        elif c in FORECAST_NUMERIC:
            cols.append(C.cast_trim(c, "double").alias(c))
        elif c == "is_partial_actual":
            cols.append(F.coalesce(C.parse_bool3(c), F.lit(False)).alias(c))
        elif c in FORECAST_FLAGS:
            cols.append(C.parse_bool3(c).alias(c))
        elif c in FORECAST_WORDS:
            cols.append(C.canon(c, "lower").alias(c))
        else:
            cols.append(C.blank_to_null(c).alias(c) if dict(raw.dtypes)[c] == "string" else F.col(c))
    return raw.select(*cols)


# H2 -------------------------------------------------------------------------
def stage_store_master(raw: DataFrame) -> DataFrame:
    """H2: store master — trimmed keys and names, state in capitals as it came (so that a long one is flagged),
    bad-code flags, duplicate flag on (coalesce(as_of, drop_date), dispensary id)."""
    out = raw.select(
        C.parse_date(_opt(raw, "as_of_date", "date"), _opt(raw, "as_of_date_raw")).alias("as_of_date"),
        _opt(raw, "drop_date", "date").alias("drop_date"),
        C.blank_to_null(_opt(raw, "dispensary_id_norm")).alias("dispensary_id"),
        C.blank_to_null(_opt(raw, "store_code_norm")).alias("store_code"),
        C.blank_to_null(_opt(raw, "dispensary_name_norm")).alias("dispensary_name"),
        F.upper(F.trim(_opt(raw, "state_norm"))).alias("state"),
        C.canon(_opt(raw, "city_norm"), "initcap").alias("city"),
        C.blank_to_null(_opt(raw, "postal_code_norm")).alias("postal_code"),
        C.canon(_opt(raw, "license_id_norm"), "upper").alias("license_id"),
        F.lower(F.trim(F.coalesce(_opt(raw, "account_type_norm"), _opt(raw, "account_type_raw")))).alias("account_type"),
    )
    out = out.withColumns({
        "is_missing_key": is_missing_key(["dispensary_id", "dispensary_name"]),
        "is_bad_state_code": is_bad_state_code("state"),
        "is_bad_postal_code": is_bad_postal_code("postal_code"),
    })
    return duplicate_candidates(out, [F.coalesce(F.col("as_of_date"), F.col("drop_date")), F.col("dispensary_id")])


# H3 -------------------------------------------------------------------------
def stage_distribution_status(raw: DataFrame, flag_duplicates: bool = True) -> DataFrame:
    """H3: SKU distribution status rows — lower-case status, keys, duplicate flag within a load (which a dedup does not need)."""
    status = C.canon(F.coalesce(_opt(raw, "distribution_status_norm"), _opt(raw, "distribution_status_raw")), "lower")
    out = raw.select(
        C.parse_date(_opt(raw, "as_of_date", "date"), _opt(raw, "as_of_date_raw")).alias("as_of_date"),
        C.blank_to_null(_opt(raw, "store_code_norm")).alias("store_code"),
        C.blank_to_null(_opt(raw, "sku_norm")).alias("sku"),
        status.alias("distribution_status"),
        C.blank_to_null(_opt(raw, "status_reason_norm")).alias("status_reason"),
        _opt(raw, "load_id"))
    out = out.withColumn("is_missing_key", is_missing_key(["as_of_date", "store_code", "sku", "distribution_status"]))
    if not flag_duplicates:
        return out
    return duplicate_candidates(out, ["load_id", "as_of_date", "store_code", "sku", "distribution_status"])
