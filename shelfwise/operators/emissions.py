"""Emissions model (E1–E6) and its controls.

Activity rows from four sources are unioned into one contract (E1), matched
to effective-dated emission factors (E2) and flagged for reportability (E3).
The factor match is an equi join on (factor type, unit, region key) with the
effective-date range as a residual predicate; the region key is computed
*before* the join (Scope 2 → the facility's grid region, otherwise ``US``).
Factor and master tables are broadcast only behind a size check.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to_null, hash_key, parse_bool2, parse_date, parse_month, ratio, strict_decimal

ACTIVITY_COLUMNS = ("activity_id", "source_system", "source_record_id", "activity_month", "scope", "facility_id",
                    "product_line_id", "activity_category", "factor_type", "activity_amount", "activity_unit",
                    "cost_usd", "evidence_reference")

# Fixed QA labels (first match wins, in this order).
QA_LABELS = (
    ("has_missing_factor_join", "❌ Missing factor join"),
    ("has_negative_activity", "⚠️ Negative activity"),
    ("has_missing_facility_id", "⚠️ Missing facility ID"),
    ("has_invalid_activity_month", "⚠️ Invalid activity month"),
    ("has_unknown_activity_type", "⚠️ Unknown activity type"),
    ("has_missing_facility_join", "⚠️ Missing facility join"),
    ("has_missing_product_line_join", "⚠️ Missing product line join"),
)
REPORTABLE_LABEL = "✅ Reportable"
REVIEW_LABEL = "⚠️ Review"


def stage_facility_master(raw: DataFrame) -> DataFrame:
    """Facility master with canonical text and boolean active flag."""
    return raw.select(F.upper(F.trim("facility_id")).alias("facility_id"), F.trim("facility_name").alias("facility_name"),
                      F.initcap(F.trim("facility_type")).alias("facility_type"),
                      F.trim("state_province").alias("state_province"), F.upper(F.trim("country")).alias("country"),
                      F.upper(F.trim("grid_region")).alias("grid_region"),
                      parse_bool2("active_flag").alias("is_active"))


def stage_product_lines(raw: DataFrame) -> DataFrame:
    """Product-line master."""
    return raw.select(F.upper(F.trim("product_line_id")).alias("product_line_id"),
                      F.trim("product_line_name").alias("product_line_name"),
                      F.trim("product_family").alias("product_family"), parse_bool2("active_flag").alias("is_active"))


def stage_factors(raw: DataFrame) -> DataFrame:
    """Effective-dated emission factors."""
    return raw.select("factor_id", F.trim("scope").alias("scope"), F.lower(F.trim("factor_type")).alias("factor_type"),
                      F.upper(F.trim("region")).alias("region"), F.lower(F.trim("activity_unit")).alias("activity_unit"),
                      F.col("factor_value_kg_co2e_per_unit").cast("double").alias("factor_value_kg_co2e_per_unit"),
                      "source_authority", F.col("effective_start").cast("date").alias("effective_start"),
                      F.col("effective_end").cast("date").alias("effective_end"),
                      F.col("version").alias("factor_version"), parse_bool2("is_current").alias("is_current"))


def activity_flags(df: DataFrame, known_types: Sequence[str]) -> DataFrame:
    """Negative, missing facility / product line, invalid month, unknown type."""
    return df.withColumns({
        "has_negative_activity": F.coalesce(F.col("activity_amount") < 0, F.lit(False)),
        "has_missing_facility_id": F.col("facility_id").isNull(),
        "has_missing_product_line_id": F.col("product_line_id").isNull() & (F.col("scope") == "Scope 3"),
        "has_invalid_activity_month": F.col("activity_month").isNull(),
        "has_unknown_activity_type": F.col("factor_type").isNull() | ~F.col("factor_type").isin(*known_types),
    })


def union_activity(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of per-source activity with a stable content id and an evidence reference.

    ``activity_id`` hashes (source, record id): stable across runs, unlike a
    positional ``row_number() over ()``.
    """
    out = None
    for name, df in sources.items():
        d = df.withColumn("source_system", F.lit(name))
        d = d.withColumns({
            "activity_id": hash_key(F.col("source_system"), F.col("source_record_id")),
            "evidence_reference": F.concat_ws(":", F.col("source_system"), F.col("source_record_id")),
        })
        keep = [c for c in ACTIVITY_COLUMNS if c in d.columns]
        extra = [c for c in d.columns if c.startswith("has_")]
        d = d.select(*keep, *extra)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


# Master rows up to which a lookup is sent to every executor (some 20 MB of facilities); beyond it both sides are dealt by key.
MASTER_ROWS = 500_000


def _looked_up(a: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """``a`` left joined with ``master`` on ``key``. A master of counted, bounded size is broadcast, so that the activity stays
    where it is; beside a larger one, rows without a key are dealt by their id, not all to the task of the null key."""
    if master.limit(MASTER_ROWS + 1).count() <= MASTER_ROWS:
        return a.join(F.broadcast(master), key, "left")
    spread = F.coalesce(F.col(key), F.concat(F.lit("\0"), F.col("activity_id")))
    m = master.filter(F.col(key).isNotNull()).withColumnRenamed(key, "__key")
    return a.join(m, spread == F.col("__key"), "left").drop("__key")


def match_factors(activity: DataFrame, facilities: DataFrame, product_lines: DataFrame,
                  factors: DataFrame) -> DataFrame:
    """Facility / product-line lookups and effective-dated factor match → kg and t CO2e."""
    fac = facilities.select("facility_id", "facility_name", "facility_type", "state_province",
                                            "country", "grid_region", F.lit(True).alias("__fac"))
    pl = product_lines.select("product_line_id", "product_line_name", "product_family",
                                              F.lit(True).alias("__pl"))
    a = _looked_up(_looked_up(activity, fac, "facility_id"), pl, "product_line_id")
    a = a.withColumn("__region_key", F.when(F.col("scope") == "Scope 2", F.col("grid_region")).otherwise(F.lit("US")))
    ef = factors.select(
        F.col("factor_id"), F.col("factor_type").alias("__ft"), F.col("activity_unit").alias("__fu"),
        F.col("region").alias("__fr"), "effective_start", "effective_end", "factor_version", "source_authority",
        "factor_value_kg_co2e_per_unit")
    cond = [(a["factor_type"] == ef["__ft"]), (a["activity_unit"] == ef["__fu"]), (a["__region_key"] == ef["__fr"]),
            (a["activity_month"] >= ef["effective_start"]), (a["activity_month"] <= ef["effective_end"])]
    j = a.join(ef, cond, "left")
    ok = F.col("activity_amount").isNotNull() & F.col("factor_value_kg_co2e_per_unit").isNotNull() & (F.col("activity_amount") >= 0)
    kg = F.col("activity_amount") * F.col("factor_value_kg_co2e_per_unit")
    return j.withColumns({
        "kg_co2e": F.when(ok, kg),
        "metric_tons_co2e": F.when(ok, kg / F.lit(1000.0)),
        "has_missing_facility_join": F.col("__fac").isNull(),
        "has_missing_product_line_join": F.col("__pl").isNull() & F.col("product_line_id").isNotNull(),
        "has_missing_factor_join": F.col("factor_id").isNull(),
    }).drop("__fac", "__pl", "__region_key", "__ft", "__fu", "__fr")


def fact_emissions(matched: DataFrame) -> DataFrame:
    """Reportability flag and first-match QA label."""
    bad = (F.col("has_negative_activity") | F.col("has_missing_facility_id") | F.col("has_invalid_activity_month")
           | F.col("has_unknown_activity_type") | F.col("has_missing_facility_join") | F.col("has_missing_factor_join"))
    rep = ~bad
    label = None
    for flag, text in QA_LABELS:
        label = F.when(F.col(flag), F.lit(text)) if label is None else label.when(F.col(flag), F.lit(text))
    label = label.when(rep, F.lit(REPORTABLE_LABEL)).otherwise(F.lit(REVIEW_LABEL))
    return matched.withColumns({"is_reportable_emissions_row": rep, "qa_status_label": label})


def emissions_controls(fact: DataFrame) -> DataFrame:
    """Q28: unknown type, negative activity, missing dimension and missing factor counts per source."""
    return fact.groupBy("source_system").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("has_unknown_activity_type").alias("unknown_activity_type_rows"),
        F.count_if("has_negative_activity").alias("negative_activity_rows"),
        F.count_if(F.col("has_missing_facility_join") | F.col("has_missing_product_line_join")).alias("missing_dim_rows"),
        F.count_if("has_missing_factor_join").alias("missing_factor_rows"),
        F.sum(F.when(F.col("has_missing_factor_join"), F.col("activity_amount"))).alias("missing_factor_activity"))


def hard_checks(fact: DataFrame, factors: DataFrame, source_counts: DataFrame) -> DataFrame:
    """Q30 / Q31: unique id, reportable not null, clean rows have a factor, math to 1e-4,
    factor uniqueness, flag logic, rowcount = Σ sources, required fields."""
    f = fact.agg(
        (F.count(F.lit(1)) - F.count_distinct("activity_id")).alias("duplicate_activity_ids"),
        F.count_if(F.col("is_reportable_emissions_row") & F.col("kg_co2e").isNull()).alias("reportable_without_emissions"),
        F.count_if(F.col("is_reportable_emissions_row") & F.col("factor_id").isNull()).alias("clean_rows_without_factor"),
        F.count_if(F.abs(F.col("kg_co2e") - F.col("activity_amount") * F.col("factor_value_kg_co2e_per_unit")) > 1e-4)
        .alias("math_mismatches"),
        F.count_if(F.col("is_reportable_emissions_row") & (F.col("has_negative_activity") | F.col("has_missing_factor_join")))
        .alias("flag_logic_violations"),
        F.count_if(F.col("activity_id").isNull() | F.col("source_system").isNull() | F.col("scope").isNull())
        .alias("required_field_nulls"),
        F.count(F.lit(1)).alias("fact_rows"))
    fu = factors.groupBy("factor_type", "activity_unit", "region", "effective_start").agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.count_if(F.col("n") > 1).alias("duplicate_factor_keys"))
    s = source_counts.agg(F.sum("row_count").alias("source_rows"))
    one = f.withColumn("__k", F.lit(1)).join(fu.withColumn("__k", F.lit(1)), "__k") \
        .join(s.withColumn("__k", F.lit(1)), "__k")
    checks = ["duplicate_activity_ids", "reportable_without_emissions", "clean_rows_without_factor", "math_mismatches",
              "flag_logic_violations", "required_field_nulls", "duplicate_factor_keys"]
    stack = ", ".join(f"'{c}', CAST({c} AS BIGINT)" for c in checks)
    stack += ", 'rowcount_matches_sources', CAST(abs(fact_rows - source_rows) AS BIGINT)"
    return one.selectExpr(f"stack({len(checks) + 1}, {stack}) AS (check_name, failed_count)") \
        .withColumn("status", F.when(F.col("failed_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))


# Fixed thresholds per control: rows from which to warn, shares of fact rows from which to warn and to fail, severity.
MATERIALITY_THRESHOLDS = (
    ("duplicate_source_records", 1, 0.01, 0.1, "high"),
    ("non_reportable_rows", 1, 0.05, 0.2, "high"),
    ("missing_factor_joins", 1, 0.001, 0.05, "critical"),
    ("negative_activity_rows", 1, 0.001, 0.05, "high"),
    ("unknown_activity_type_rows", 1, 0.001, 0.05, "high"),
    ("missing_dimension_joins", 1, 0.001, 0.1, "high"),
)


def materiality(fact: DataFrame, duplicate_records: DataFrame, thresholds=MATERIALITY_THRESHOLDS) -> DataFrame:
    """Q32: six controls against row and share thresholds; limits count as exceeded when met (FAIL before WARN)."""
    one = fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col("is_reportable_emissions_row")).alias("non_reportable_rows"),
        F.count_if("has_missing_factor_join").alias("missing_factor_joins"),
        F.count_if("has_negative_activity").alias("negative_activity_rows"),
        F.count_if("has_unknown_activity_type").alias("unknown_activity_type_rows"),
        F.count_if(F.col("has_missing_facility_join") | F.col("has_missing_product_line_join")).alias("missing_dimension_joins"))
    dup = duplicate_records.agg(F.count(F.lit(1)).alias("duplicate_source_records"))
    one = one.withColumn("k", F.lit(1)).join(dup.withColumn("k", F.lit(1)), "k")
    rows = ", ".join(f"'{n}', CAST({n} AS BIGINT), {w}L, {wp}D, {fp}D, '{sev}'" for n, w, wp, fp, sev in thresholds)
    out = one.selectExpr("total_rows", f"stack({len(thresholds)}, {rows}) AS (control_name, exception_rows, "
                         "warning_row_threshold, warning_pct_threshold, failure_pct_threshold, severity)")
    share = ratio("exception_rows", "total_rows")
    status = (F.when(share >= F.col("failure_pct_threshold"), F.lit("FAIL"))
              .when(F.col("exception_rows") >= F.col("warning_row_threshold"), F.lit("WARN"))
              .when(share >= F.col("warning_pct_threshold"), F.lit("WARN")).otherwise(F.lit("PASS")))
    return out.select("control_name", "exception_rows", "total_rows", share.alias("exception_pct"), "warning_row_threshold",
                      "warning_pct_threshold", "failure_pct_threshold", "severity", status.alias("materiality_status"))


def null_profile(fact: DataFrame, cols: Sequence[str], by: str = "source_system") -> DataFrame:
    """Q33: null count per column per source in one grouped pass."""
    return fact.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"),
                                *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def intensity_monthly(fact: DataFrame, revenue: DataFrame, month: str = "activity_month",
                      revenue_month: str = "month_start", revenue_col: str = "net_sales") -> DataFrame:
    """Reportable t CO2e per month by scope (filtered aggregates) over revenue."""
    rep = F.col("is_reportable_emissions_row")
    e = fact.groupBy(month).agg(
        F.sum(F.when(rep, F.col("metric_tons_co2e"))).alias("total_t_co2e"),
        F.sum(F.when(rep & (F.col("scope") == "Scope 1"), F.col("metric_tons_co2e"))).alias("scope1_t_co2e"),
        F.sum(F.when(rep & (F.col("scope") == "Scope 2"), F.col("metric_tons_co2e"))).alias("scope2_t_co2e"),
        F.sum(F.when(rep & (F.col("scope") == "Scope 3"), F.col("metric_tons_co2e"))).alias("scope3_t_co2e"))
    r = revenue.groupBy(F.col(revenue_month).alias(month)).agg(F.sum(revenue_col).alias("revenue_usd"))
    j = e.join(r, month, "left")
    return j.withColumns({"t_co2e_per_usd": ratio("total_t_co2e", "revenue_usd"),
                          "t_co2e_per_1k_usd": ratio(F.col("total_t_co2e") * 1000.0, "revenue_usd")})


def by_factor_version(fact: DataFrame) -> DataFrame:
    """Traceability — emissions and rows per factor version, source and category."""
    return fact.groupBy("factor_version", "source_system", "activity_category").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("is_reportable_emissions_row").alias("reportable_rows"),
        F.sum("metric_tons_co2e").alias("t_co2e"))


TRACE_COLUMNS = ("activity_id", "source_system", "source_record_id", "evidence_reference", "activity_month", "scope", "facility_id",
                 "product_line_id", "activity_category", "activity_amount", "activity_unit", "factor_id", "factor_version",
                 "metric_tons_co2e", "qa_status_label")
EXCLUSION_FLAGS = ("has_negative_activity", "has_missing_facility_id", "has_missing_product_line_id", "has_invalid_activity_month",
                   "has_unknown_activity_type", "has_missing_facility_join", "has_missing_product_line_join", "has_missing_factor_join")


def reportable_evidence(fact: DataFrame) -> DataFrame:
    """Reportable rows with their source and factor evidence."""
    return fact.filter("is_reportable_emissions_row").select(*TRACE_COLUMNS, "source_authority", "factor_value_kg_co2e_per_unit")


def excluded_rows(fact: DataFrame) -> DataFrame:
    """Rows left out of the report, with every reason flag."""
    return fact.filter(~F.col("is_reportable_emissions_row")).select(*TRACE_COLUMNS, *EXCLUSION_FLAGS)


def factor_usage(fact: DataFrame) -> DataFrame:
    """Reportable emissions by the factor that made them."""
    return fact.filter("is_reportable_emissions_row").groupBy(
        "scope", "factor_type", "activity_unit", "grid_region", "factor_id", "factor_version", "source_authority").agg(
        F.count(F.lit(1)).alias("rows_using_factor"), F.sum("metric_tons_co2e").alias("metric_tons_co2e"))


def source_activity_summary(fact: DataFrame) -> DataFrame:
    """Rows and reportable emissions by source system and activity."""
    rep = F.col("is_reportable_emissions_row")
    return fact.groupBy("source_system", "scope", "activity_category", "activity_unit").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(rep).alias("reportable_rows"), F.count_if(~rep).alias("non_reportable_rows"),
        F.sum(F.when(rep, F.col("metric_tons_co2e"))).alias("reportable_metric_tons_co2e"))


# Fixed words: electricity units, and the factor type of each shipping mode and packaging material.
KWH_WORDS = ("kwh", "kw hrs", "kwhrs", "kilowatt hour", "kilowatt hours")
SHIPPING_FACTORS = {"truck": "freight_truck_ton_mile", "air": "freight_air_ton_mile"}
MATERIAL_FACTORS = {"paper": "packaging_paper_kg", "plastic": "packaging_plastic_kg", "glass": "packaging_glass_kg"}


def _code(c: str) -> Column:
    return F.upper(blank_to_null(F.col(c)))


def _amount(c: str, scale: int) -> Column:
    return strict_decimal(F.col(c), 18, scale).cast("double")


def stage_electricity_bills(raw: DataFrame) -> DataFrame:
    """E5: electricity bills text → month, strict amounts, canonical unit, row flags (unreadable amounts have null flags)."""
    unit = F.lower(F.trim("usage_unit"))
    out = raw.select(
        parse_month(F.col("bill_month")).alias("activity_month"), _code("facility_id").alias("facility_id"),
        F.trim("utility_provider").alias("utility_provider"), _code("meter_number").alias("meter_number"),
        _amount("usage_amount", 4).alias("activity_amount"),
        F.when(unit.isin(*KWH_WORDS), F.lit("kwh")).otherwise(unit).alias("activity_unit"),
        _amount("invoice_amount_usd", 2).alias("invoice_amount_usd"), _code("invoice_number").alias("invoice_number"),
        F.lit("Scope 2").alias("scope"), F.lit("electricity_kwh").alias("factor_type"), F.lit("electricity_bills").alias("source_system"))
    return out.withColumns({"has_negative_activity": F.col("activity_amount") < 0, "has_missing_facility_id": F.col("facility_id").isNull(),
                            "has_invalid_activity_month": F.col("activity_month").isNull()})


def stage_shipping_miles(raw: DataFrame) -> DataFrame:
    """E5: shipping text → date (two formats) and month, mode, ton-miles and the mode's factor type, row flags."""
    mode = F.lower(F.trim("shipping_mode"))
    ftype = F.create_map(*[F.lit(x) for kv in SHIPPING_FACTORS.items() for x in kv])[mode]
    date = parse_date(F.lit(None).cast("date"), F.col("shipment_date"))
    out = raw.select(
        _code("shipment_id").alias("shipment_id"), date.alias("shipment_date"), F.trunc(date, "month").alias("activity_month"),
        _code("origin_facility_id").alias("facility_id"), _code("destination_state").alias("destination_state"),
        _code("product_line_id").alias("product_line_id"), mode.alias("shipping_mode"), F.trim("carrier").alias("carrier"),
        _amount("distance_miles", 4).alias("distance_miles"), _amount("shipment_weight_lb", 4).alias("shipment_weight_lb"),
        _amount("ton_miles", 4).alias("activity_amount"), F.lit("ton_mile").alias("activity_unit"),
        _amount("freight_cost_usd", 2).alias("freight_cost_usd"), F.lit("Scope 3").alias("scope"), ftype.alias("factor_type"),
        F.lit("shipping_miles").alias("source_system"))
    return out.withColumns({"has_negative_activity": F.col("activity_amount") < 0, "has_missing_facility_id": F.col("facility_id").isNull(),
                            "has_missing_product_line_id": F.col("product_line_id").isNull(),
                            "has_invalid_shipment_date": F.col("shipment_date").isNull(),
                            "has_unknown_shipping_mode": F.col("factor_type").isNull()})


def stage_packaging_materials(raw: DataFrame) -> DataFrame:
    """E5: packaging purchases text → month, material, weight and the material's factor type, row flags."""
    material = F.lower(F.trim("material_type"))
    ftype = F.create_map(*[F.lit(x) for kv in MATERIAL_FACTORS.items() for x in kv])[material]
    out = raw.select(
        parse_month(F.col("invoice_month")).alias("activity_month"), _code("facility_id").alias("facility_id"),
        _code("product_line_id").alias("product_line_id"), material.alias("material_type"),
        F.trim("supplier_name").alias("supplier_name"), _amount("units_purchased", 4).alias("units_purchased"),
        _amount("material_weight_kg", 4).alias("activity_amount"), F.lit("kg").alias("activity_unit"),
        _code("invoice_number").alias("invoice_number"), _amount("cost_usd", 2).alias("cost_usd"), F.lit("Scope 3").alias("scope"),
        ftype.alias("factor_type"), F.lit("packaging_materials").alias("source_system"))
    return out.withColumns({"has_negative_activity": F.col("activity_amount") < 0, "has_missing_facility_id": F.col("facility_id").isNull(),
                            "has_missing_product_line_id": F.col("product_line_id").isNull(),
                            "has_invalid_activity_month": F.col("activity_month").isNull(),
                            "has_unknown_material_type": F.col("factor_type").isNull()})


def stage_fuel_usage(raw: DataFrame) -> DataFrame:
    """E5: fuel usage text → month (three formats, C3), strict numeric amount (C8), unit
    synonyms (C20), factor type from fuel + unit with an invalid-unit flag (C22), row flags (G9)."""
    from ..functions.clean import FUEL_SYNONYMS, FUEL_UNIT_SYNONYMS, factor_type, map_synonyms
    unit = map_synonyms(F.col("activity_unit"), FUEL_UNIT_SYNONYMS, fold="lower")
    out = raw.select(
        F.col("source_record_id"), parse_month(F.col("activity_month")).alias("activity_month"),
        F.upper(F.trim("facility_id")).alias("facility_id"), map_synonyms(F.col("fuel_type"), FUEL_SYNONYMS, fold="lower").alias("fuel_type"),
        strict_decimal(F.col("activity_amount"), 18, 4).cast("double").alias("activity_amount"),
        unit.alias("activity_unit"), F.col("activity_month").alias("activity_month_raw"))
    ftype, mismatch = factor_type(F.col("fuel_type"), F.col("activity_unit"))
    out = out.withColumns({"factor_type": ftype, "has_invalid_fuel_unit": mismatch, "scope": F.lit("Scope 1")})
    out = out.withColumns({
        "has_negative_activity": F.col("activity_amount") < 0,
        "has_missing_facility_id": F.col("facility_id").isNull() | (F.col("facility_id") == ""),
        "has_invalid_activity_month": F.col("activity_month").isNull(),
        "has_unparsed_amount": F.col("activity_amount").isNull(),
        "has_unknown_fuel_type": F.col("factor_type").isNull(),
    })
    return out


def trace(ids: DataFrame, fact: DataFrame, factors: DataFrame, staged: dict[str, DataFrame],
          record_keys: dict[str, dict[str, Column]]) -> DataFrame:
    """Every activity id walked back from the reported row to its factor, its staged row and its source file.

    ``ids`` holds activity ids (any number; repeats count once). ``staged`` gives each source's rows with ``source_amount`` and
    ``source_file``; ``record_keys`` says how the stored key columns of a source follow from the record id, so that each
    source is cut by a semi-join on its stored columns: Spark broadcasts a small set of keys or filters the scan by
    its Bloom filter, and reads no other source's rows. The amount is recomputed from the staged row and the factor; ``ties_out`` tells
    whether it is the reported one. Ids that no reported row has come back with nulls; a repeated source record comes back with
    each of its staged rows.
    """
    wanted = ids.select("activity_id").distinct()
    rows = fact.join(wanted, "activity_id", "left_semi").select(*TRACE_COLUMNS, "factor_type", "kg_co2e")
    rows = rows.join(factors.select("factor_id", "source_authority", "factor_value_kg_co2e_per_unit", "effective_start", "effective_end"),
                     "factor_id", "left")
    found = None
    for source, frame in staged.items():
        keys = record_keys[source]
        own = rows.filter(F.col("source_system") == source).select(
            F.col("source_system").alias("__s"), F.col("source_record_id").alias("__r"), *[e.alias(f"__{k}") for k, e in keys.items()]).distinct()
        on = [frame[k] == own[f"__{k}"] for k in keys]
        part = frame.join(own, on).select("__s", "__r", "source_amount", "source_file")
        found = part if found is None else found.unionByName(part)
    j = rows.join(found, (rows["source_system"] == found["__s"]) & (rows["source_record_id"] == found["__r"]), "left").drop("__s", "__r")
    kg = F.col("source_amount") * F.col("factor_value_kg_co2e_per_unit")
    j = j.withColumns({"recomputed_kg_co2e": kg, "ties_out": F.coalesce(F.abs(kg - F.col("kg_co2e")) <= 1e-6, F.lit(False))})
    return wanted.join(j, "activity_id", "left")
