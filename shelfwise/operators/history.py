"""Effective-dated history and event pairing.

Windows here are partitioned so that no unbounded group lands in one task:

* ``effective_ranges`` runs ``lead`` over one row per (entity, as-of date) —
  the input is deduplicated to that grain first, so a partition holds at most
  the number of distinct dates of one entity.
* ``pair_events`` needs "the next event of this employee".  A plain
  ``lead`` over (store, employee) would put an employee's whole history into
  one task.  Instead: ``lead`` inside (store, employee, day) partitions, and
  for the last event of each day the first event of the employee's next
  active day, found by ``lead`` over a one-row-per-day table.  The result is
  identical to the whole-history ``lead``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import minutes_between
from .dedup import keep_best


def effective_ranges(df: DataFrame, keys: Sequence[str], as_of: str, prefer=(),
                     valid_from: str = "valid_from", valid_to: str = "valid_to",
                     current_col: str = "is_current") -> DataFrame:
    """One version per (keys, as_of) → ``[valid_from, valid_to]`` ranges.

    ``valid_to`` is the next version's date minus one day; the open end is null.
    """
    versions = keep_best(df, [*keys, as_of], prefer, count_col="rows_on_date")
    w = Window.partitionBy(*keys).orderBy(F.col(as_of))
    nxt = F.lead(F.col(as_of)).over(w)
    return (versions
            .withColumn(valid_from, F.col(as_of))
            .withColumn(valid_to, F.date_sub(nxt, 1))
            .withColumn(current_col, nxt.isNull())
            .withColumn("version_number", F.row_number().over(w)))


def next_event(events: DataFrame, entity: Sequence[str], ts: str, action: str,
               day_col: str = "__day") -> DataFrame:
    """Attach ``next_action`` / ``next_ts``: the entity's next event in (ts, action) order."""
    ev = events.withColumn(day_col, F.to_date(F.col(ts)))
    w_day = Window.partitionBy(*entity, day_col).orderBy(F.col(ts), F.col(action))
    ev = (ev.withColumn("next_action", F.lead(action).over(w_day))
            .withColumn("next_ts", F.lead(ts).over(w_day))
            .withColumn("__last_of_day", F.lead(F.lit(1)).over(w_day).isNull()))
    heads = (ev.groupBy(*entity, day_col)
               .agg(F.min(F.struct(F.col(ts).alias("ts"), F.col(action).alias("action"))).alias("__head")))
    w_days = Window.partitionBy(*entity).orderBy(day_col)
    heads = heads.select(*entity, day_col,
                         F.lead("__head").over(w_days).alias("__next_head"))
    ev = ev.join(heads, [*entity, day_col], "left")
    last = F.col("__last_of_day")
    return (ev.withColumn("next_action", F.when(last, F.col("__next_head.action")).otherwise(F.col("next_action")))
              .withColumn("next_ts", F.when(last, F.col("__next_head.ts")).otherwise(F.col("next_ts")))
              .drop("__next_head", "__last_of_day", day_col))


def pair_events(events: DataFrame, entity: Sequence[str] = ("store_code", "employee_id"),
                ts: str = "punch_ts", action: str = "action", work_date: str = "work_date",
                start: str = "IN", end: str = "OUT") -> DataFrame:
    """``start`` immediately followed by ``end`` → a worked interval.

    Returns every event with ``next_action``, ``next_ts``, ``is_pair`` and
    ``minutes_worked`` (non-negative, only on pairs).
    """
    base = events.filter(F.col(ts).isNotNull() & F.col(action).isNotNull()
                         & F.col(work_date).isNotNull()
                         & F.col(entity[0]).isNotNull() & F.col(entity[1]).isNotNull())
    ev = next_event(base, list(entity), ts, action)
    is_pair = ((F.col(action) == start) & (F.col("next_action") == end)
               & F.col("next_ts").isNotNull() & (F.col("next_ts") >= F.col(ts)))
    return (ev.withColumn("is_pair", is_pair)
              .withColumn("minutes_worked",
                          F.when(is_pair, F.greatest(minutes_between(F.col(ts), F.col("next_ts")), F.lit(0)))))


def labor_daily_employee(events: DataFrame, entity: Sequence[str] = ("store_code", "employee_id"),
                         ts: str = "punch_ts", action: str = "action", work_date: str = "work_date",
                         include_unpaired: bool = False) -> DataFrame:
    """Minutes / hours / shift pairs / event counts per (day, store, employee).

    The reference's correlated count subqueries become conditional aggregates
    of one ``groupBy``.  By default (as the reference) employee-days with no
    complete pair are dropped; ``include_unpaired=True`` keeps them.
    """
    p = pair_events(events, entity, ts, action, work_date)
    unpaired_in = (F.col(action) == "IN") & (~F.col("next_action").eqNullSafe(F.lit("OUT")) | F.col("next_ts").isNull())
    out = p.groupBy(work_date, *entity).agg(
        F.sum("minutes_worked").alias("minutes_worked"),
        (F.sum("minutes_worked") / F.lit(60.0)).alias("hours_worked"),
        F.count_if(F.col("is_pair")).alias("n_shift_pairs"),
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(unpaired_in).alias("n_unpaired_in"),
        F.count_if(F.col(action) == "OUT").alias("n_out_events"),
    )
    return out if include_unpaired else out.filter(F.col("n_shift_pairs") > 0)


def punch_intervals(events: DataFrame, entity: Sequence[str] = ("store_code", "employee_id"),
                    ts: str = "punch_ts", action: str = "action", work_date: str = "work_date") -> DataFrame:
    """One row per worked interval (clock in, clock out, minutes)."""
    p = pair_events(events, entity, ts, action, work_date).filter(F.col("is_pair"))
    return p.select(work_date, *entity, F.col(ts).alias("clock_in_at"), F.col("next_ts").alias("clock_out_at"),
                    "minutes_worked")


def labor_store_daily(daily_employee: DataFrame, store: str = "store_code",
                      work_date: str = "work_date") -> DataFrame:
    """Labor by store-day (hours, headcount)."""
    return daily_employee.groupBy(work_date, store).agg(
        F.sum("hours_worked").alias("labor_hours"),
        F.count_distinct("employee_id").alias("employees_worked"),
        F.sum("n_shift_pairs").alias("shift_pairs"),
        F.sum("n_unpaired_in").alias("unpaired_in"),
    )


def coverage_conformed(status: DataFrame, stores: DataFrame | None = None, accounts: DataFrame | None = None,
                       keys: Sequence[str] = ("store_code", "sku"), as_of: str = "as_of_date") -> DataFrame:
    """Distribution status → coverage group + flags (C21), effective ranges (D10),
    version count, and store / account context (J2, J15).

    ``status`` must already be one row per (as_of, keys) (D4).  The range
    window is partitioned by (store, sku): bounded by that pair's status days.
    """
    from ..functions.clean import coverage_status
    base = status.filter(F.col(as_of).isNotNull() & F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    base = base.withColumns(coverage_status(F.col("distribution_status")))
    w = Window.partitionBy(*keys).orderBy(as_of)
    nxt = F.lead(as_of).over(w)
    out = base.withColumns({"version_count": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
                            "effective_start_date": F.col(as_of),
                            "effective_end_date": F.date_sub(nxt, 1),
                            "is_current": nxt.isNull()})
    if stores is not None:
        s = stores.select(F.col(keys[0]), F.lit(True).alias("__store"))
        out = out.join(s, keys[0], "left").withColumn("is_missing_store_dim", F.col("__store").isNull()).drop("__store")
    if accounts is not None:
        a = accounts.select(keys[0], "account_status", F.col("status_date").alias("account_status_date"))
        out = out.join(a, keys[0], "left").withColumns({
            "is_active_account": F.lower("account_status") == "active",
            "is_inactive_or_suspended": F.lower("account_status").isin("inactive", "suspended")})
    return out
