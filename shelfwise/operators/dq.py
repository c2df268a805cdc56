"""Data-quality rules, results, exceptions and certification (Q1–Q15, Q37, Q39, Q40).

A rule is a small Python spec; the catalogue becomes a literal DataFrame.
Evaluation folds every row-level rule on one table into a *single* ``agg`` of
``count_if`` expressions (the reference scans the table once per rule), and
unpivots that one row into one result row per rule.  Uniqueness rules count
failing key *groups* from a partial-combined ``groupBy``.  Exception rows are a
union of filtered projections — never collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.clean import first_null_label, record_key, ratio

CATEGORIES = ("completeness", "uniqueness", "validity", "timeliness", "reconciliation")
SEVERITIES = ("critical", "high", "medium", "low")


@dataclass(frozen=True)
class Rule:
    """Q1: one governed rule.

    kind: ``required`` (cols non-null), ``unique`` (keys), ``predicate``
    (``fail_when`` is a SQL boolean expression marking failing rows).
    """
    rule_id: int
    rule_name: str
    rule_category: str
    target_table: str
    kind: str
    cols: tuple = ()
    fail_when: str | None = None
    issue: str | None = None
    severity: str = "critical"
    threshold_pct: float = 0.0
    owner_team: str = "Data Governance"
    active_flag: bool = True
    record_key_cols: tuple = field(default=())

    def __post_init__(self):
        if self.rule_category not in CATEGORIES:
            raise ValueError(f"bad category {self.rule_category}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"bad severity {self.severity}")


RULE_SCHEMA = T.StructType([
    T.StructField("rule_id", T.LongType()), T.StructField("rule_name", T.StringType()),
    T.StructField("rule_category", T.StringType()), T.StructField("target_table", T.StringType()),
    T.StructField("target_column", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("threshold_pct", T.DoubleType()), T.StructField("owner_team", T.StringType()),
    T.StructField("active_flag", T.BooleanType()),
])


def rules_df(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rule catalogue as a literal DataFrame."""
    rows = [(r.rule_id, r.rule_name, r.rule_category, r.target_table, ", ".join(r.cols) or None,
             r.severity, float(r.threshold_pct), r.owner_team, r.active_flag) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _fail_expr(r: Rule) -> Column:
    if r.kind == "required":
        cond = None
        for c in r.cols:
            cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
        return cond
    if r.kind == "predicate":
        return F.coalesce(F.expr(r.fail_when), F.lit(False))
    raise ValueError(r.kind)


def evaluate_rules(df: DataFrame, rules: Sequence[Rule], run_id: int, quarter_id: str | None = None,
                   use_threshold: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Q3 / Q5 / Q6 / Q7: one result row per active rule (per ``by`` group).

    Row rules: one grouped ``agg`` pass of ``count_if`` columns, unpivoted with
    ``stack``.  Uniqueness: failing groups = key groups with more than one row
    (two partial-combined ``groupBy`` steps).  With ``by=("quarter_id",)`` every
    quarter is evaluated in the same pass; otherwise ``quarter_id`` is a label.
    """
    by = list(by)
    active = [r for r in rules if r.active_flag]
    row_rules = [r for r in active if r.kind != "unique"]
    parts = []
    if row_rules:
        aggs = [F.count(F.lit(1)).alias("__checked")]
        aggs += [F.count_if(_fail_expr(r)).alias(f"__f{r.rule_id}") for r in row_rules]
        one = df.groupBy(*by).agg(*aggs)
        stack = ", ".join(f"{r.rule_id}L, __f{r.rule_id}" for r in row_rules)
        parts.append(one.selectExpr(*by, "__checked AS checked_count",
                                    f"stack({len(row_rules)}, {stack}) AS (rule_id, failed_count)"))
    for r in active:
        if r.kind != "unique":
            continue
        g = df.groupBy(*by, *r.cols).agg(F.count(F.lit(1)).alias("__n"))
        parts.append(g.groupBy(*by).agg(F.sum("__n").cast("bigint").alias("checked_count"),
                                        F.count_if(F.col("__n") > 1).alias("failed_count"))
                      .select(*by, F.lit(r.rule_id).cast("bigint").alias("rule_id"), "checked_count", "failed_count"))
    cols = [*by, "rule_id", "checked_count", "failed_count"]
    res = parts[0].select(*cols)
    for p in parts[1:]:
        res = res.unionByName(p.select(*cols))
    meta = rules_df(df.sparkSession, active).select("rule_id", "rule_name", "rule_category", "target_table",
                                                    "severity", "threshold_pct")
    out = res.join(F.broadcast(meta), "rule_id")
    pct = F.when(F.col("checked_count") == 0, F.lit(0)).otherwise(F.col("failed_count") / F.col("checked_count"))
    out = out.withColumn("failed_pct", pct)
    status = F.when(F.col("failed_count") > 0, F.lit("fail")).otherwise(F.lit("pass"))
    if use_threshold:
        status = (F.when(F.col("failed_count") == 0, F.lit("pass"))
                  .when(F.col("failed_pct") <= F.col("threshold_pct"), F.lit("warn")).otherwise(F.lit("fail")))
    label = [] if "quarter_id" in by else [F.lit(quarter_id).alias("quarter_id")]
    return out.select(F.lit(run_id).cast("bigint").alias("run_id"), *by, *label,
                      "rule_id", "rule_name", "rule_category", "target_table", "checked_count", "failed_count",
                      "failed_pct", "severity", status.alias("status"))


def exceptions(df: DataFrame, rules: Sequence[Rule], run_id: int, quarter_id: str | None = None) -> DataFrame:
    """Q4 / Q5: exception detail rows (record key, issue, owner, ``open``) for every failing record.

    ``quarter_id=None`` takes the quarter from the frame's ``quarter_id`` column.
    """
    q = F.col("quarter_id") if quarter_id is None else F.lit(quarter_id)
    active = [r for r in rules if r.active_flag]
    found = []
    for r in active:
        if r.kind == "unique":
            continue
        key = record_key(*r.record_key_cols) if r.record_key_cols else F.lit(None).cast("string")
        issue = first_null_label([(c, f"{c} is null") for c in r.cols]) if r.kind == "required" else F.lit(r.issue or r.rule_name)
        found.append(F.when(_fail_expr(r), F.struct(F.lit(r.rule_id).cast("bigint").alias("rule_id"), key.alias("record_key"),
                                                    issue.alias("issue_value"))))
    parts = []
    if found:  # all row rules in one pass: the failing ones of a row are exploded
        hits = df.select(q.alias("quarter_id"), F.array_compact(F.array(*found)).alias("hits")).filter(F.size("hits") > 0)
        parts.append(hits.select("quarter_id", F.explode("hits").alias("h")).select("quarter_id", "h.*"))
    for r in active:
        if r.kind == "unique":  # one exception per duplicated key group
            keys = list(r.cols) if quarter_id is not None or "quarter_id" in r.cols else ["quarter_id", *r.cols]
            g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
            parts.append(g.select(q.alias("quarter_id"), F.lit(r.rule_id).cast("bigint").alias("rule_id"),
                                  record_key(*r.cols).alias("record_key"),
                                  F.concat(F.lit("duplicate count = "), F.col("__n").cast("string")).alias("issue_value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    meta = rules_df(df.sparkSession, active).select("rule_id", "target_table", F.col("rule_name").alias("issue_description"),
                                                    F.col("owner_team").alias("assigned_team"))
    return out.join(F.broadcast(meta), "rule_id").select(
        F.lit(run_id).cast("bigint").alias("run_id"), "quarter_id", "rule_id", "target_table", "record_key", "issue_value",
        "issue_description", "assigned_team", F.lit("open").alias("remediation_status"))


def latest_per_group(df: DataFrame, group: Sequence[str], order_col: str) -> DataFrame:
    """Rows of the latest ``order_col`` per group (group max joined back)."""
    mx = df.groupBy(*group).agg(F.max(order_col).alias("__mx"))
    mx = mx.select(*[F.col(g).alias(f"__g_{g}") for g in group], "__mx")
    cond = [df[g].eqNullSafe(mx[f"__g_{g}"]) for g in group] + [df[order_col] == mx["__mx"]]
    return df.join(mx, cond, "inner").drop("__mx", *[f"__g_{g}" for g in group])


def scorecard(results: DataFrame) -> DataFrame:
    """Q10: latest run per quarter, one row per rule (results already carry run_id)."""
    return latest_per_group(results, ["quarter_id"], "run_id")


STATUS_RANK = {"fail": 3, "warn": 2, "pass": 1}


def worst_status(col: Column) -> Column:
    """Worst status wins (``max`` over text would let ``pass`` hide ``fail``)."""
    rank = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])[col]
    back = F.create_map(*[F.lit(x) for kv in ((v, k) for k, v in STATUS_RANK.items()) for x in kv])
    return back[F.max(rank)]


def latest_runs(run_log: DataFrame) -> DataFrame:
    """Q10 / Q11: the newest run of every quarter with its status (one grouped max, no join)."""
    g = run_log.groupBy("quarter_id").agg(F.max(F.struct("run_id", "run_status", "run_ts")).alias("r"))
    return g.select("quarter_id", "r.run_id", "r.run_status", "r.run_ts")


def open_exceptions(exceptions: DataFrame, rules: DataFrame, run_log: DataFrame) -> DataFrame:
    """Q10: open exceptions of each quarter's newest run, with the governing rule's attributes.

    The rule catalogue and the newest runs (one row a quarter) go to the exceptions: dealt by rule or by quarter, all
    exceptions of one would be one task's work.
    """
    r = rules.select("rule_id", "rule_name", "rule_category", "severity", "owner_team")
    latest = latest_runs(run_log).select("quarter_id", "run_id")
    return exceptions.filter(F.col("remediation_status") == "open").join(F.broadcast(r), "rule_id") \
        .join(F.broadcast(latest), ["quarter_id", "run_id"]) \
        .select("run_id", "quarter_id", "rule_id", "rule_name", "rule_category", "severity", "owner_team", "target_table",
                "record_key", "issue_value", "issue_description", "assigned_team", "remediation_status")


def reconciliation_summary(recon: DataFrame, run_log: DataFrame) -> DataFrame:
    """Q10: reconciliation results of each quarter's newest run."""
    return recon.join(latest_runs(run_log).select("quarter_id", "run_id"), ["quarter_id", "run_id"])


# Certification words and reasons, in the order in which they are decided.
HOLD, CERTIFIED, NOT_RUN = "hold", "certified", "not_run"
HOLD_REASONS = ("latest dq run not completed", "reconciliation failed or not run", "open critical exceptions remain")
READY_REASON = "ready for reporting"


def certify(run_log: DataFrame, open_exc: DataFrame, recon: DataFrame) -> DataFrame:
    """Q11: hold or certify every quarter on its newest run.

    A quarter is held unless its newest run is completed, a reconciliation of that run passed (none at all
    holds) and no critical exception of that run is open. Several reconciliation rows count by their worst status.
    """
    keys = ["quarter_id", "run_id"]
    exc = open_exc.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("open_exception_count"),
        F.count_if(F.col("severity") == "critical").alias("open_critical_exception_count"))
    rec = recon.groupBy(*keys).agg(worst_status(F.col("status")).alias("reconciliation_status"))
    g = latest_runs(run_log).join(exc, keys, "left").join(rec, keys, "left")
    g = g.withColumns({"open_exception_count": F.coalesce("open_exception_count", F.lit(0)),
                       "open_critical_exception_count": F.coalesce("open_critical_exception_count", F.lit(0)),
                       "reconciliation_status": F.coalesce("reconciliation_status", F.lit(NOT_RUN))})
    holds = (F.col("run_status") != "completed", F.col("reconciliation_status") != "pass",
             F.col("open_critical_exception_count") > 0)
    reason = F.lit(READY_REASON)
    for cond, text in reversed(list(zip(holds, HOLD_REASONS, strict=True))):
        reason = F.when(cond, F.lit(text)).otherwise(reason)
    return g.withColumn("certification_reason", reason).withColumn(
        "certification_status", F.when(F.col("certification_reason") == READY_REASON, F.lit(CERTIFIED)).otherwise(F.lit(HOLD)))


def threshold_rate_checks(df: DataFrame, table: str, flag_thresholds: dict[str, tuple[float, float | None]]) -> DataFrame:
    """Q13: rate of each flag column in one pass; FAIL above, WARN above the warn level.

    ``flag_thresholds``: flag column → (fail_rate, warn_rate or None).  Flags
    missing from the frame are reported as ``SKIPPED`` (existence check).
    """
    present = {k: v for k, v in flag_thresholds.items() if k in df.columns}
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count_if(F.col(k)).alias(k) for k in present]
    one = df.agg(*aggs)
    if present:
        stack = ", ".join(f"'{k}', CAST({k} AS BIGINT)" for k in present)
        long = one.selectExpr("__rows AS row_count", f"stack({len(present)}, {stack}) AS (check_column, flagged_rows)")
    else:
        long = one.selectExpr("__rows AS row_count", "CAST(NULL AS STRING) AS check_column",
                              "CAST(NULL AS BIGINT) AS flagged_rows").filter("false")
    th = df.sparkSession.createDataFrame(
        [(k, float(f), None if w is None else float(w), k in present) for k, (f, w) in flag_thresholds.items()],
        "check_column string, fail_rate double, warn_rate double, exists boolean")
    j = F.broadcast(th).join(long, "check_column", "left")
    rate = ratio("flagged_rows", "row_count")
    status = (F.when(~F.col("exists"), F.lit("SKIPPED"))
              .when(F.col("row_count") == 0, F.lit("FAIL"))
              .when(rate > F.col("fail_rate"), F.lit("FAIL"))
              .when(F.col("warn_rate").isNotNull() & (rate > F.col("warn_rate")), F.lit("WARN"))
              .otherwise(F.lit("PASS")))
    return j.select(F.lit(table).alias("table_name"), "check_column", "row_count", "flagged_rows",
                    rate.alias("flagged_rate"), "fail_rate", "warn_rate", status.alias("status"))


# Q14 ------------------------------------------------------------------------
def contract_checks(df: DataFrame, name: str, grain: Sequence[str] = (), not_null: Sequence[str] = (),
                    ranges: dict[str, tuple] | None = None, vocab: dict[str, Sequence[str]] | None = None,
                    notices: dict[str, str] | None = None) -> DataFrame:
    """Q14: relation non-empty, unique grain, null keys, ranges, vocabularies, notices.

    Everything except grain uniqueness comes from one ``agg`` pass; the result
    is one row per check with ``PASS`` / ``FAIL`` / ``NOTICE``.
    """
    ranges, vocab, notices = ranges or {}, vocab or {}, notices or {}
    checks: list[tuple[str, Column, str]] = [("non_empty", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0), "error")]
    for c in not_null:
        checks.append((f"not_null:{c}", F.count_if(F.col(c).isNull()), "error"))
    for c, (lo, hi) in ranges.items():
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < lo)
        if hi is not None:
            bad = bad | (F.col(c) > hi)
        checks.append((f"range:{c}", F.count_if(F.coalesce(bad, F.lit(False))), "error"))
    for c, values in vocab.items():
        checks.append((f"vocab:{c}", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)), "error"))
    for label, cond in notices.items():
        checks.append((f"notice:{label}", F.count_if(F.coalesce(F.expr(cond), F.lit(False))), "notice"))
    one = df.agg(*[e.cast("bigint").alias(f"__c{i}") for i, (_, e, _) in enumerate(checks)])
    stack = ", ".join(f"'{n}', __c{i}, '{s}'" for i, (n, _, s) in enumerate(checks))
    res = one.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, failed_count, severity)")
    if grain:
        dup = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("__n")).agg(
            F.count_if(F.col("__n") > 1).alias("failed_count"))
        res = res.unionByName(dup.select(F.lit("unique_grain:" + ",".join(grain)).alias("check_name"),
                                         F.col("failed_count").cast("bigint"), F.lit("error").alias("severity")))
    status = (F.when(F.col("severity") == "notice", F.lit("NOTICE"))
              .when(F.col("failed_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))
    return res.select(F.lit(name).alias("relation"), "check_name", "failed_count", "severity", status.alias("status"))


class ContractViolation(AssertionError):
    pass


def raise_on_fail(checks: DataFrame) -> DataFrame:
    """raise when any check fails (collects only the failing check rows)."""
    bad = checks.filter(F.col("status") == "FAIL").select("relation", "check_name", "failed_count").collect()
    if bad:
        raise ContractViolation("; ".join(f"{r.relation}.{r.check_name}={r.failed_count}" for r in bad))
    return checks


def duplicate_triage(df: DataFrame, keys: Sequence[str], sample_per_key: int = 3) -> DataFrame:
    """Q15: duplicated keys with their group size and up to ``sample_per_key`` sample rows."""
    from pyspark.sql import Window
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count")).filter(F.col("dup_count") > 1)
    rows = df.join(g, list(keys), "inner")
    order = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= sample_per_key)


def formula_integrity(df: DataFrame, tol: float = 0.01) -> DataFrame:
    """Q40: documented formula checks in one pass (gross = units × list, …, rates in [0,1])."""
    u, lp, np_ = F.col("units"), F.col("unit_list_price"), F.col("unit_net_price")
    g, n, d = F.col("gross_sales"), F.col("net_sales"), F.col("discount_amount")
    checks = {
        "gross_eq_units_x_list": F.abs(g - u * lp) > tol,
        "net_eq_units_x_net_price": F.abs(n - u * np_) > tol,
        "discount_eq_gross_minus_net": F.abs(d - (g - n)) > tol,
        "discount_rate_in_0_1": (F.col("discount_rate") < 0) | (F.col("discount_rate") > 1),
        "units_non_negative": u < 0,
    }
    one = df.agg(F.count(F.lit(1)).alias("rows_checked"),
                 *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()])
    stack = ", ".join(f"'{k}', {k}" for k in checks)
    return one.selectExpr("rows_checked", f"stack({len(checks)}, {stack}) AS (check_name, failed_rows)") \
        .withColumn("status", F.when(F.col("failed_rows") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")))


def upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q39: ``insert … on conflict do update``: keep current rows without an update, add all updates."""
    kept = current.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def intake_log(expected: DataFrame, received: DataFrame, keys: Sequence[str], due_col: str = "due_date",
               received_col: str = "received_date") -> DataFrame:
    """Q37 / Q8: expected vs received submissions with on-time / late / missing status."""
    j = expected.join(received, list(keys), "left")
    status = (F.when(F.col(received_col).isNull(), F.lit("missing"))
              .when(F.col(received_col) <= F.col(due_col), F.lit("on_time")).otherwise(F.lit("late")))
    return j.withColumn("submission_status", status)


def continuity(df: DataFrame, entity: str, date: str, step_days: int = 7) -> DataFrame:
    """Q8 (weekly continuity): per entity, periods between its first and last active period
    with no rows.  Periods are generated per entity with ``sequence`` (a time grid, not row pairs)."""
    wk = F.date_trunc("week", F.col(date)).cast("date")
    active = df.select(F.col(entity), wk.alias("period_start")).distinct()
    span = active.groupBy(entity).agg(F.min("period_start").alias("__lo"), F.max("period_start").alias("__hi"),
                                      F.count(F.lit(1)).alias("active_periods"))
    grid = span.select(entity, "active_periods",
                       F.explode(F.sequence("__lo", "__hi", F.expr(f"INTERVAL {step_days} DAYS"))).alias("period_start"))
    missing = grid.join(active, [entity, "period_start"], "left_anti")
    m = missing.groupBy(entity).agg(F.count(F.lit(1)).alias("missing_periods"))
    out = span.join(m, entity, "left").select(
        entity, "__lo", "__hi", "active_periods", F.coalesce("missing_periods", F.lit(0)).alias("missing_periods"))
    out = out.withColumnsRenamed({"__lo": "first_period", "__hi": "last_period"})
    return out.withColumn("continuity_pct", F.col("active_periods") / (F.col("active_periods") + F.col("missing_periods")))


def row_exceptions(checks: Sequence[tuple[str, str, str, str, DataFrame, Column]], run_id: int) -> DataFrame:
    """Q12: typed exception rows of (rule, table, severity, details, failing rows, record key)."""
    out = None
    for rule, table, severity, details, failing, key in checks:
        rows = failing.select(
            F.lit(run_id).cast("bigint").alias("run_id"), F.lit(rule).alias("rule_name"), F.lit(table).alias("table_name"),
            key.alias("record_key"), F.lit(severity).alias("severity"), F.lit(details).alias("details"))
        out = rows if out is None else out.unionByName(rows)
    return out


def or_unknown(*cols: str) -> Column:
    """Record key of an exception row: the values joined by ``|``, a null as ``?``."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in cols])


def exception_summary(exc: DataFrame) -> DataFrame:
    """Q12: exceptions per run, table and rule."""
    return exc.groupBy("run_id", "table_name", "rule_name").agg(F.count(F.lit(1)).alias("exception_count"))


def certification_gaps(expected: DataFrame, certifications: DataFrame, key: str, as_of) -> DataFrame:
    """Owners without a certification record (EXCEPT), not certified, or certified up to a past date."""
    missing = expected.select(key).subtract(certifications.select(key)).withColumn("gap", F.lit("missing"))
    certified = F.lower("certification_status") == "certified"
    expired = F.col("certified_through") < F.lit(as_of).cast("date")
    bad = certifications.filter(~certified | expired) \
        .select(key, F.when(~certified, F.lit("not certified")).otherwise(F.lit("expired")).alias("gap"))
    return missing.unionByName(bad)


def resolution_status(exc: DataFrame, log: DataFrame, id_col: str = "exception_id", by: Sequence[str] = ("rule_id",)) -> DataFrame:
    """Q35: exceptions (hash ids) matched to a resolution log → resolved / open counts per rule."""
    j = exc.join(log.select(id_col, "resolution_status"), id_col, "left")
    resolved = F.col("resolution_status") == "resolved"
    g = j.groupBy(*by).agg(F.count(F.lit(1)).alias("exceptions"), F.count_if(resolved).alias("resolved"),
                           F.count_if(~F.coalesce(resolved, F.lit(False))).alias("still_open"))
    return g.withColumn("resolution_rate", F.col("resolved") / F.col("exceptions"))


RUN_LOG_SCHEMA = ("run_id bigint, quarter_id string, run_ts timestamp, run_by string, source_batch_name string, "
                  "rules_version string, run_status string")


def open_run(spark: SparkSession, log_path: str, quarter_id: str, run_by: str, batch: str,
             rules_version: str = "v1") -> int:
    """Q2: append a ``started`` row to the run log (parquet folder) and return its run id.

    The log holds one row per run; reading its max id is a small aggregate. Only a missing log starts at run 1.
    """
    try:
        last = spark.read.parquet(log_path).agg(F.max("run_id")).collect()[0][0] or 0
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    run_id = int(last) + 1
    row = spark.createDataFrame([(run_id, quarter_id, None, run_by, batch, rules_version, "started")], RUN_LOG_SCHEMA)
    row.withColumn("run_ts", F.current_timestamp()).write.mode("append").parquet(log_path)
    return run_id


def close_run(spark: SparkSession, log_path: str, run_id: int, status: str = "completed") -> None:
    """Q2: record the closing status as a new log row (append-only; latest row per run wins)."""
    row = spark.createDataFrame([(run_id, None, None, None, None, None, status)], RUN_LOG_SCHEMA)
    row.withColumn("run_ts", F.current_timestamp()).write.mode("append").parquet(log_path)


def run_status(spark: SparkSession, log_path: str) -> DataFrame:
    """Q2: current status per run (latest log row per run id, T4)."""
    from .ranking import latest_row
    return latest_row(spark.read.parquet(log_path), "run_ts", keys=["run_id"])


def append_results(results: DataFrame, path: str, run_id: int) -> None:
    """S5 append of one run's results; reruns of a run id replace that run's partition only."""
    results.withColumn("run_id", F.lit(run_id).cast("bigint")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
