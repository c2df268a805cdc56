"""Reference data and key universes (M19, M20): license reference, store dimension of several sources, weekly labor."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to_null
from .dedup import last_wins

# Words that make a license recreational retail or wholesale, its groups, and the words of its status.
RECREATIONAL, RETAIL, WHOLESALE = "recreat", "retail", "wholesal"
LICENSE_GROUPS = {"retail": "Recreational Retailer", "wholesale": "Recreational Wholesaler", "both": "Recreational Retailer/Wholesaler"}
STATUS_WORDS = {"unknown": "Unknown", "active": "Active/Unexpired", "expired": "Expired"}
MISSING_WORDS = ("nan", "None")


def license_reference(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Recreational retail and wholesale licenses, one row per license number.

    ``raw`` holds text: license_number, business_name, business_licenses, license_type, county, expiration_date (and ``keep``). The
    group follows from the words of both license fields, the county is trimmed and title-cased, an unreadable
    expiration is null. The last row of a number by expiration stays, a null expiration being last; rows without a number are
    one license.
    """
    text = F.lower(F.concat_ws(" | ", F.coalesce(F.trim("business_licenses"), F.lit("")), F.coalesce(F.trim("license_type"), F.lit(""))))
    retail, wholesale = text.contains(RETAIL), text.contains(WHOLESALE)
    group = F.when(retail & wholesale, F.lit(LICENSE_GROUPS["both"])).when(wholesale, F.lit(LICENSE_GROUPS["wholesale"])) \
        .otherwise(F.lit(LICENSE_GROUPS["retail"]))
    county = blank_to_null("county")
    expires = F.trim("expiration_date").try_cast("date")
    rows = raw.filter(text.contains(RECREATIONAL) & (retail | wholesale)).select(
        "license_number", F.trim("business_name").alias("business_name"), group.alias("license_group"),
        F.trim("business_licenses").alias("business_licenses"), F.trim("license_type").alias("license_type"),
        F.initcap(F.when(~county.isin(*MISSING_WORDS), county)).alias("county"), expires.alias("expiration_date"), *keep)
    last = F.coalesce(F.col("expiration_date"), F.lit("9999-12-31").cast("date"))
    return last_wins(rows.withColumn("__last", last), ["license_number"], "__last").drop("__last")


def license_status(expires: Column, as_of: Column) -> Column:
    return F.when(expires.isNull(), F.lit(STATUS_WORDS["unknown"])).when(expires >= as_of, F.lit(STATUS_WORDS["active"])) \
        .otherwise(F.lit(STATUS_WORDS["expired"]))


def license_summary(licenses: DataFrame, as_of) -> DataFrame:
    """Number of licenses by group, by county and group, and by group and status on ``as_of``: three levels in one run."""
    x = licenses.withColumn("license_status", license_status(F.col("expiration_date"), F.lit(as_of).cast("date")))
    keys = ["license_group", "county", "license_status"]
    # Bits of grouping_id from the last key on: 1 where the key is summed over.
    level = {3: "license_group", 1: "county_license_group", 2: "license_group_status"}
    gid = F.grouping_id(*keys)
    name = reduce(lambda c, kv: c.when(gid == kv[0], F.lit(kv[1])), level.items(), F.when(F.lit(False), F.lit("")))
    return x.groupingSets([["license_group"], ["license_group", "county"], ["license_group", "license_status"]], *keys) \
        .agg(F.count(F.lit(1)).alias("location_count"), name.alias("summary_level")).select(*keys, "summary_level", "location_count")


def key_universe(sources: dict[str, DataFrame], key: str) -> DataFrame:
    """Every key of any source with the sources that know it, as a bit set (bit i: the i-th source) and by name, and their number.

    One pass: each row adds its source's bit, and bits are or-ed before the shuffle, so a key of any frequency is one row per task.
    Blank keys are left out.
    """
    marked = [df.select(blank_to_null(F.col(key).cast("string")).alias(key), F.lit(1 << i).cast("long").alias("__bit"))
              for i, df in enumerate(sources.values())]
    u = reduce(DataFrame.unionByName, marked).filter(F.col(key).isNotNull())
    g = u.groupBy(key).agg(F.bit_or("__bit").alias("source_bits"))
    named = [F.when(F.col("source_bits").bitwiseAND(1 << i) != 0, F.lit(name)) for i, name in enumerate(sources)]
    return g.withColumns({"known_in": F.concat_ws(",", *named), "source_count": F.bit_count("source_bits")})


def store_dimension_of(sources: dict[str, DataFrame], key: str = "store_id") -> DataFrame:
    """Store dimension from the key universe of all sources: state code and display name follow from the key."""
    return key_universe(sources, key).select(
        key, F.left(key, F.lit(2)).alias("state_code"), F.concat(F.lit("Account "), F.col(key)).alias("store_name"),
        "source_bits", "known_in", "source_count")


def labor_weekly(payroll: DataFrame, key: str = "site_code", week: str = "week_ending") -> DataFrame:
    """Payroll rows with week and store → (week, store, department) hours, overtime, employees and cost."""
    return payroll.filter(F.col(week).isNotNull() & blank_to_null(key).isNotNull()).groupBy(week, key, "department").agg(
        F.sum("hours_worked").alias("hours_worked"), F.sum("ot_hours").alias("ot_hours"),
        F.sum("employee_count").alias("employee_count"), F.sum("labor_cost").alias("labor_cost"))
