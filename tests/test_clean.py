"""Cleaning helpers on tiny in-memory frames: nulls, bad text, ties."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import clean as C


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).collect()[0]["r"]


def test_blank_to_null(spark):
    assert one(spark, C.blank_to_null, "  ") is None
    assert one(spark, C.blank_to_null, " a ") == "a"
    assert one(spark, C.blank_to_null, None) is None


def test_parse_date_formats(spark):
    f = lambda c: C.parse_date(None, c)
    assert one(spark, f, "2024-02-29") == dt.date(2024, 2, 29)
    assert one(spark, f, "02/29/2024") == dt.date(2024, 2, 29)
    assert one(spark, f, "2/9/2024") is None          # strict two-digit US format
    assert one(spark, f, "02/30/2024") is None        # invalid date → null, not an error
    assert one(spark, f, "garbage") is None


def test_parse_month_formats(spark):
    assert one(spark, C.parse_month, "Mar-2024") == dt.date(2024, 3, 1)
    assert one(spark, C.parse_month, "3/15/2024") == dt.date(2024, 3, 1)
    assert one(spark, C.parse_month, "2024-03-15") == dt.date(2024, 3, 1)


def test_lenient_numbers(spark):
    f = lambda c: C.lenient_int(None, c)
    assert one(spark, f, " 12 units") == 12
    assert one(spark, f, "-1-2") is None              # would fail in SQL engines; try_cast → null
    assert one(spark, lambda c: C.lenient_decimal(None, c), "$1,234.50") == 1234.5
    assert one(spark, C.money, "$1,234.50") == 1234.5
    assert one(spark, C.money, "n/a") is None
    assert one(spark, lambda c: C.strict_decimal(c, 18, 2), "12.5") is not None
    assert one(spark, lambda c: C.strict_decimal(c, 18, 2), "$12.5") is None


def test_booleans(spark):
    assert one(spark, C.parse_bool3, " Yes") is True
    assert one(spark, C.parse_bool3, "0") is False
    assert one(spark, C.parse_bool3, "maybe") is None
    assert one(spark, C.parse_bool2, "maybe") is False
    assert one(spark, C.parse_bool2, None) is False


def test_codes(spark):
    assert one(spark, C.norm_code, " ab-12 c ") == "AB12C"
    assert one(spark, C.alnum_code, "a.b/1") == "AB1"
    assert one(spark, C.digits, "tel: 555-12") == "55512"
    assert one(spark, C.norm_state, " co lorado") == "CO"
    assert one(spark, C.norm_postal, "80 202") == "80202"


def test_classifier_order(spark):
    # "inactive" must win over "active"
    assert one(spark, C.account_status, "  INACTIVE - closed") == "inactive"
    assert one(spark, C.account_status, "Active") == "active"
    assert one(spark, C.account_status, "other") == "other"
    assert one(spark, C.map_metric, "Cost of Goods Sold") == "cogs"
    assert one(spark, C.map_metric, None) == "unknown"


def test_synonyms(spark):
    f = lambda c: C.map_synonyms(c, C.ACTION_SYNONYMS)
    assert one(spark, f, " clockin") == "IN"
    assert one(spark, f, "break") == "BREAK"


def test_ratio_and_diff(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0), (0.0, 0.0)], "a double, b double")
    r = [x["r"] for x in df.select(C.ratio("a", "b").alias("r")).collect()]
    assert r == [None, None, 2.5, None]
    s = [x["s"] for x in df.select(C.sym_rel_diff("a", "b").alias("s")).collect()]
    assert s[0] == 1.0 and s[3] == 0.0


def test_hash_keys(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    r = df.select(C.hash_key("x", "y").alias("h1"), C.hash_key_nullsafe("x", "y").alias("h2"),
                  C.record_key("x", "y").alias("k")).collect()[0]
    assert r["h1"] != r["h2"] and r["k"] == "a|MISSING"


def test_round_to_decimal_tie(spark):
    # -5844.7788 / 1176 is exactly -4.97005 in decimal arithmetic
    df = spark.createDataFrame([(-5844.7788, 1176.0)], "a double, b double")
    assert df.select(C.round_to(F.col("a") / F.col("b"), 4).alias("r")).collect()[0]["r"] == -4.9701


def test_minutes_between(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 9, 30))], "a timestamp, b timestamp")
    assert df.select(C.minutes_between("a", "b").alias("m")).collect()[0]["m"] == 90.0


def test_staged_master_flags_a_long_state(spark):
    from shelfwise.operators import staging
    raw = spark.createDataFrame([(" d1", "Shop", "new york", " 123 ", None, "X"), (None, "Shop", " ny ", "10001", " lic-1", None)],
                                "dispensary_id_norm string, dispensary_name_norm string, state_norm string, postal_code_norm string, "
                                "license_id_norm string, account_type_raw string")
    a, b = sorted(staging.stage_store_master(raw).collect(), key=lambda r: r["dispensary_id"] is None)
    assert (a["state"], a["is_bad_state_code"], a["is_bad_postal_code"], a["is_missing_key"], a["account_type"]) == ("NEW YORK", True, True, False, "x")
    assert (b["state"], b["is_bad_state_code"], b["is_missing_key"], b["license_id"]) == ("NY", False, True, "LIC-1")


def test_punch_words_and_missing_actions(spark):
    from shelfwise.operators import staging
    raw = spark.createDataFrame([("2024-01-02 08:00:00", "E1", "S1", w) for w in ("PunchIn", "punch_out", "lunch", None)],
                                "punch_ts_raw string, employee_id_raw string, site_code_norm string, action_raw string")
    got = {r["action"]: (r["is_bad_action"], r["is_missing_key"]) for r in staging.stage_timeclock(raw).collect()}
    assert got == {"IN": (False, False), "OUT": (False, False), "LUNCH": (True, False), None: (False, True)}


def test_team_synonym_and_fuel_classes(spark):
    from shelfwise.operators import emissions, staging
    raw = spark.createDataFrame([("2024-01-05", "S1", "Fulfilment", " Fulfilment ")],
                                "week_ending_raw string, site_code_norm string, department_norm string, team_norm string")
    r = staging.stage_labor_payroll(raw).collect()[0]
    assert (r["department"], r["team"]) == ("fulfilment", "fulfillment")
    fuels = spark.createDataFrame([(i, "2024-01-01", "f", f, "1", u) for i, (f, u) in enumerate(
        [("Natural Gas", "Therms"), ("diesel", "gal"), ("gasoline", "therm"), ("propane", "gallon")])],
        "source_record_id int, activity_month string, facility_id string, fuel_type string, activity_amount string, activity_unit string")
    got = {r["source_record_id"]: (r["factor_type"], r["has_invalid_fuel_unit"], r["has_unknown_fuel_type"])
           for r in emissions.stage_fuel_usage(fuels).collect()}
    assert got == {0: ("natural_gas_therm", False, False), 1: ("diesel_gallon", False, False), 2: (None, True, True), 3: (None, False, True)}


def test_money_is_exact_and_out_of_range_is_null(spark):
    from decimal import Decimal as D
    rows = spark.createDataFrame([("$1,234.56785",), ("-0.00005",), ("99999999999999",), ("100000000000000",), ("1-2",), ("",), (None,)], "t string")
    got = [tuple(r) for r in rows.select(C.lenient_decimal(None, "t"), C.money("t")).collect()]
    assert got == [(D("1234.5679"), D("1234.5679")), (D("-0.0001"), D("-0.0001")), (D("99999999999999.0000"),) * 2,
                   (None, None), (None, None), (None, None), (None, None)]
    tenths = spark.range(1000).select(C.exact(F.lit(0.1)).alias("x"))
    assert tenths.agg(F.sum("x")).first()[0] == D("100.0000")


def test_typed_amounts_beyond_the_range_fall_back_to_text(spark):
    row = spark.createDataFrame([(1e20, "7.5")], "x double, t string")
    assert float(row.select(C.lenient_decimal("x", "t")).first()[0]) == 7.5


def test_rounding_of_quotients_is_decimal(spark):
    row = spark.createDataFrame([(1183.8753, 6, -4.97005, float("nan"))], "n double, d int, x double, y double")
    assert tuple(row.select(C.round_to(C.ratio("n", "d"), 4), C.round_to("x", 4), C.round_to("y", 4), C.round_to(F.lit(None).cast("double"), 2)).first()) \
        == (197.3126, -4.9701, None, None)
