"""Date spine and calendar dimensions.

The spine is generated with ``explode(sequence(start, end))``; its size is the
number of days in the range, independent of fact volume.  Bounds may be given
as literals or derived from data (a one-row aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import date_labels


def latest_date(df: DataFrame, date: str):
    """The latest date of a column, resolved once (one value), so that it reaches scans as a literal; None if there is none."""
    return df.agg(F.max(F.col(date).cast("date"))).first()[0]


def date_spine(spark: SparkSession, start, end, col: str = "full_date") -> DataFrame:
    """One row per day in [start, end]."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(col))


def date_spine_from(df: DataFrame, date_col: str, col: str = "full_date") -> DataFrame:
    """Spine covering the min..max of a data column (bounds from a one-row aggregate)."""
    b = df.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias(col))


def calendar(spine: DataFrame, fiscal_start_month: int = 1, as_of: Column | str | None = None,
             col: str = "full_date") -> DataFrame:
    """M5 / M6: calendar attributes, ISO parts, boundaries, fiscal periods and to-date flags.

    Fiscal years are named by their ending year; ``as_of`` replaces ``current_date``.
    """
    d = F.col(col)
    labels = date_labels(d)
    m = F.month(d)
    fsm = F.lit(fiscal_start_month)
    fy = F.when(m >= fsm, F.year(d) + F.lit(0 if fiscal_start_month == 1 else 1)).otherwise(F.year(d))
    fm = ((m - fsm + 12) % 12) + 1
    out = spine.select(
        d, labels["date_key"].alias("date_key"), labels["year_num"].alias("year_num"),
        labels["quarter_num"].alias("quarter_num"), labels["month_num"].alias("month_num"),
        labels["month_name"].alias("month_name"), labels["month_abbr"].alias("month_abbr"),
        labels["day_name"].alias("day_name"), F.dayofmonth(d).alias("day_of_month"),
        labels["day_of_week"].alias("iso_day_of_week_num"),
        labels["day_of_week"].isin(6, 7).alias("is_weekend"),
        F.date_trunc("week", d).cast("date").alias("week_start_date"),
        F.date_add(F.date_trunc("week", d).cast("date"), 6).alias("week_end_date"),
        F.trunc(d, "month").alias("month_start_date"), F.last_day(d).alias("month_end_date"),
        F.trunc(d, "quarter").alias("quarter_start_date"), F.trunc(d, "year").alias("year_start_date"),
        labels["iso_week"].alias("iso_week_num"), labels["iso_year"].alias("iso_year_num"),
        labels["iso_year_week"].alias("iso_year_week"), labels["year_month"].alias("year_month"),
        labels["year_quarter"].alias("year_quarter"),
        (d == F.trunc(d, "month")).alias("is_month_start"), (d == F.last_day(d)).alias("is_month_end"),
        F.lit(fiscal_start_month).alias("fiscal_start_month"), fy.alias("fiscal_year"), fm.alias("fiscal_month"),
        F.ceil(fm / F.lit(3.0)).cast("int").alias("fiscal_quarter"),
        F.concat(F.lit("FY"), fy.cast("string")).alias("fiscal_year_label"),
        F.concat(F.lit("FY"), fy.cast("string"), F.lit("-P"), F.lpad(fm.cast("string"), 2, "0")).alias("fiscal_period_label"),
    )
    if as_of is not None:
        a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
        out = out.withColumns({
            "is_today": d == a,
            "is_mtd": (F.trunc(d, "month") == F.trunc(a, "month")) & (d <= a),
            "is_ytd": (F.year(d) == F.year(a)) & (d <= a),
        })
    return out
