"""Steps that keep shuffles, skew and repeated work down on large tables, on rows of their own."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dedup, dq, emissions as E, facts, kpi, staging
from shelfwise.plans import ghg, model, q_controls, q_dq, q_facts, raw
from shelfwise.plans.catalog import REGISTRY
from shelfwise.sources.testdata import Tables


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Own tables: six orders of two accounts; one line number stands twice, one account has no nation."""
    d = str(tmp_path_factory.mktemp("tables"))
    day = lambda k: dt.datetime(1997 + k % 2, 1 + k, 3)
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(0, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, "c1", 0, 1.0, "BUILDING"), (2, "c2", 0, 2.0, "HOUSEHOLD"), (3, "c3", 9, 3.0, "MACHINERY")],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    put("supplier", [(1, "s1", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    put("part", [(1, "bolt", "B1", "PROMO", 1, 9.0), (2, "ring", "B2", "LARGE", 2, 8.0)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(k, 1 + k % 3, "OFP"[k % 3], 100.0 + k, day(k), "5-LOW") for k in range(1, 8)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    lines = [(k, 1 + n % 2, 1, n, 5.0 + n, 50.0 + n, 0.05, 0.0, "ANR"[n % 3], "O", day(k)) for k in range(1, 8) for n in (1, 2, 3)]
    put("lineitem", lines + lines[:1] + [lines[0][:4] + (9.0,) + lines[0][5:]],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return d


@pytest.fixture
def dealt(spark):
    """No table is small enough to be broadcast unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df, *cols):
    return sorted(repr(tuple(r)) for r in (df.select(*cols) if cols else df).collect())


def test_keep_best_of_some_columns(spark):
    rows = [("k", 1, "a", 5, "x"), ("k", 1, "b", 4, "y"), ("k", 1, "b", 4, "z"), ("m", None, None, None, "w")]
    df = spark.createDataFrame(rows, "k string, p int, a string, b int, rest string")
    full = dedup.keep_best(df, ["k"], [("p", "desc")])
    some = dedup.keep_best(df, ["k"], [("p", "desc")], columns=["b"])
    assert some.columns == ["k", "b", "dup_group_size"]
    assert _sorted(some) == _sorted(full, *some.columns) == ["('k', 4, 3)", "('m', None, 1)"]
    assert "rest" not in some._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1].split("\n")[0]


def test_distributor_sums_are_the_daily_ones(spark, small):
    t = Tables(spark, small)
    cols = ["sale_date", "store_code", "sku", "channel", "units", "net_sales", "cogs", "orders"]
    assert _sorted(q_facts.dist_daily(t, cols[4:]), *cols) == _sorted(q_facts.dist_daily(t), *cols)


def test_lines_do_not_move_by_account(spark, small, dealt):
    """The account meets the order headers: no exchange by account holds line columns."""
    s = model.sales_lines(Tables(spark, small))
    by_account = [x for x in _plan(s.select("order_id", "units", "channel")).split("\n") if "Exchange hashpartitioning(o_custkey" in x]
    joins = _plan(s.select("order_id", "units", "channel"))
    assert by_account and joins.index("hashpartitioning(l_orderkey") < joins.index("hashpartitioning(o_custkey")
    assert s.count() == 17  # accounts without a nation have no sales


def test_transactions_are_grouped_where_the_order_join_left_them(spark, small, dealt):
    t = Tables(spark, small)
    day = q_facts.pos_day(t)
    assert "hashpartitioning(txn_id" not in _plan(day)
    rows = dedup.pos_transactions(raw.pos_transactions(t))
    assert _sorted(day) == _sorted(facts.pos_daily(rows).withColumnRenamed("txn_date", "sale_date"))


def test_distribution_status_without_duplicate_flag(spark, small):
    rows = raw.distribution_status_extract(Tables(spark, small))
    plain, flagged = staging.stage_distribution_status(rows, flag_duplicates=False), staging.stage_distribution_status(rows)
    assert "is_duplicate_candidate" not in plain.columns
    assert _sorted(plain) == _sorted(flagged, *plain.columns)
    grain = ["as_of_date", "store_code", "sku"]
    assert _sorted(dedup.one_per_grain(plain, grain, count_col=None, columns=["distribution_status"])) == \
        _sorted(dedup.one_per_grain(flagged, grain), *grain, "distribution_status")


def test_rows_without_product_line_stay_where_they_are(spark, small, dealt, monkeypatch):
    t = Tables(spark, small)
    near = ghg.fact(t)
    assert "hashpartitioning(product_line_id" not in _plan(near) and "hashpartitioning(facility_id" not in _plan(near)
    monkeypatch.setattr(E, "MASTER_ROWS", 0)  # a master beyond the bound: dealt by key, null keys by their id
    far = ghg.fact(t)
    assert "hashpartitioning(product_line_id" not in _plan(far)
    assert _sorted(far.select(*near.columns)) == _sorted(near)


def test_duplicate_records_with_a_repeated_id(spark, small, monkeypatch):
    """A record that stands twice has a detail row for each fact row; ids are made at the end, not written."""
    rows = [("s", "r1", 1.0, 2.0), ("s", "r1", 1.0, 3.0), ("s", "r2", 1.0, 4.0), ("s", "r3", 7.0, 5.0), ("s", None, 1.0, 6.0)]
    frame = spark.createDataFrame(rows, "source_system string, source_record_id string, activity_amount double, metric_tons_co2e double") \
        .withColumns({"activity_month": F.lit(dt.date(2000, 1, 1)), "facility_id": F.lit("F1"), "factor_type": F.lit("diesel"),
                      "activity_unit": F.lit("gallon"), "cost_usd": F.lit(1.0), "is_reportable_emissions_row": F.lit(True),
                      "activity_id": E.hash_key("source_system", "source_record_id")})
    monkeypatch.setattr(q_controls.ghg, "fact", lambda t: frame)
    kept, write = [], q_controls.materialized
    monkeypatch.setattr(q_controls, "materialized", lambda df, tag: kept.extend(df.columns) or write(df, tag))
    out = q_controls.duplicate_source_records(None).collect()
    assert "activity_id" not in kept
    # Four rows share the key; r1 meets both of its rows twice, the row without an id meets none.
    assert sorted((r["source_record_id"] or "", r["metric_tons_co2e"]) for r in out) == \
        [("", None), ("r1", 2.0), ("r1", 2.0), ("r1", 3.0), ("r1", 3.0), ("r2", 4.0)]
    assert {(r["duplicate_record_count"], r["duplicate_group_metric_tons_co2e"], r["duplicate_group_cost_usd"]) for r in out} == {(4, 14.0, 4.0)}
    assert {r["activity_id"] for r in out if r["source_record_id"] == "r2"} == {r[0] for r in frame.filter("source_record_id = 'r2'").select("activity_id").collect()}


@pytest.mark.parametrize("name, module, tags", [("q10_scorecard_latest_run", q_dq, {"staged_retail"}),
                                                ("q35_exception_resolution", q_controls, {"staged_retail", "exceptions"})])
def test_rules_read_staged_rows_once(spark, small, monkeypatch, name, module, tags):
    seen, write = [], module.materialized
    monkeypatch.setattr(module, "materialized", lambda df, tag: seen.append(tag) or write(df, tag))
    assert REGISTRY[name](spark, small).count() > 0 and sorted(seen) == sorted(tags)


def test_store_day_counts_distinct_words_without_copies_of_rows(spark):
    rows = [("d", "s", "p1", "retail"), ("d", "s", "p1", "club"), ("d", "s", "p2", None), ("d", None, "p2", None)]
    df = spark.createDataFrame(rows, "sale_date string, store_code string, sku string, channel string")
    for c in ("net_sales", "gross_sales", "discount_amount", "units", "orders", "cogs"):
        df = df.withColumn(c, F.lit(1).cast("decimal(18,4)"))
    out = facts.store_day_agg(df.withColumn("source_system", F.lit("pos")))
    assert "Expand" not in _plan(out)
    assert sorted((r["store_code"] or "", r["distinct_skus"], r["distinct_channels"]) for r in out.collect()) == [("", 1, 0), ("s", 2, 2)]


def test_facts_do_not_move_for_their_labels(spark, small, dealt):
    """The store context goes along from the orders and the lines are dealt by product once."""
    plan = _plan(REGISTRY["m1_conformed_sales"](spark, small))
    assert "Union" in plan and "Exchange" not in plan.split("Union")[0] and "hashpartitioning(sale_date" not in plan


def test_repeated_and_unknown_stores_of_conformed_sales(spark):
    stores = spark.createDataFrame([("1", "A"), ("1", None), ("2", "B"), (None, "C")], "store_code string, state string")
    lists = facts.store_lists(stores)
    num = {c: F.lit(1).cast("decimal(28,4)") for c in ("gross_sales", "discount_amount", "net_sales", "cogs")}
    rows = spark.createDataFrame([("1", "7", 7), ("3", "7", 7), (None, "8", 8)], "store_code string, sku string, sku_key long") \
        .withColumns({"sale_date": F.lit(dt.date(2000, 1, 1)), "channel": F.lit("club"), "units": F.lit(1.0), "orders": F.lit(1), **num}) \
        .join(lists, "store_code", "left")
    prods = spark.createDataFrame([(7, "bolt")], "sku_key long, product_name string")
    out = facts.conformed_sales(rows, rows.withColumn("pos_transactions", F.lit(1)), prods)
    got = _sorted(out.filter("source_system = 'pos'"), "store_code", "state", "product_label", "is_missing_store", "is_missing_sku")
    assert got == ["('1', 'A', 'bolt', False, False)", "('1', None, 'bolt', False, False)", "('3', None, 'bolt', True, False)",
                   "(None, None, 'Unknown 8', True, True)"]
    assert out.count() == 8


@pytest.mark.parametrize("name", ["m1_conformed_sales", "m10_store_day_sales"])
def test_many_products_and_accounts_are_not_sent_through_the_driver(spark, small, monkeypatch, name):
    """Beyond a counted bound, a table whose few columns look small enough to be broadcast is dealt by its key."""
    sent = r"BroadcastHashJoin \[(sku_key|l_partkey|o_custkey#\d+L?\], \[store_id)#"
    few = REGISTRY[name](spark, small)
    assert len(re.findall(sent, _plan(few))) == 3
    monkeypatch.setattr(facts, "LOOKUP_ROWS", 1, raising=False)
    many = REGISTRY[name](spark, small)
    assert not re.findall(sent, _plan(many)) and len(re.findall(r"SortMergeJoin \[sku_key#", _plan(many))) == 1
    assert _sorted(many) == _sorted(few) and many.count() > 0


def test_both_facts_of_a_product_meet_in_one_task(spark, small, dealt):
    """One label join above the union, whose sides are dealt by product already: a store's day is summed over both sources there."""
    plan = _plan(REGISTRY["m10_store_day_sales"](spark, small))
    above = plan.split("Union")[0]
    assert "SortMergeJoin [sku_key#" in above and above.count("Exchange") == 1 and "Exchange hashpartitioning(sale_date" in above


def test_inventory_health_dealt_once_to_counted_tasks(spark, dealt):
    """K6: the sides meet where they were dealt; grouped rows are not dealt again, and the tasks do not depend on run-time sizes."""
    inv = spark.createDataFrame(
        [("m1", 1, 1, "ASIA", "bolt", 4.0, True), ("m1", 1, 1, "ASIA", "bolt", 2.0, None), ("m1", 1, 1, "ASIA", "ring", 6.0, None),
         ("m1", 2, 1, "ASIA", "bolt", -1.0, None), (None, 2, 1, "ASIA", "bolt", 3.0, False), ("m2", 3, 2, None, "bolt", 5.0, True)],
        "m string, sku long, site_id long, state string, category string, on_hand_units double, in_stock_flag boolean") \
        .withColumn("month_start", F.when(F.col("m") == "m1", F.lit("1997-01-01")).when(F.col("m") == "m2", F.lit("1997-02-01")).cast("date"))
    sales = spark.createDataFrame([("1997-01-01", 1, 1, 3.0), ("1997-01-01", 1, 1, 4.0), (None, 2, 1, 9.0), ("1997-02-01", 4, 2, 1.0)],
                                  "d string, sku long, site_id long, units double").withColumn("month_start", F.col("d").cast("date"))
    some = kpi.inventory_health(inv, sales, tasks=3)
    plan = _plan(some)
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("ENSURE_REQUIREMENTS") == 1
    assert _sorted(some) == _sorted(kpi.inventory_health(inv, sales))
    assert len(_sorted(some)) == 4


def test_inventory_health_query_is_dealt(spark, small, dealt):
    assert _plan(REGISTRY["k6_inventory_health"](spark, small)).count("REPARTITION_BY_NUM") == 2


def test_open_exceptions_are_not_dealt_by_rule_or_quarter(spark, dealt):
    """Q10, Q11: all exceptions of a rule or a quarter would be one task's work."""
    exc = spark.createDataFrame([(2, "1997Q1", 4, "t", "k1", "v", "d", "a", "open"), (2, "1997Q1", 9, "t", "k2", "v", "d", "a", "open"),
                                 (2, "1997Q2", 4, "t", "k3", "v", "d", "a", "open"), (2, None, 4, "t", "k4", "v", "d", "a", "open"),
                                 (2, "1997Q1", 4, "t", "k5", "v", "d", "a", "closed")],
                                "run_id long, quarter_id string, rule_id long, target_table string, record_key string, issue_value string, "
                                "issue_description string, assigned_team string, remediation_status string")
    log = spark.createDataFrame([("1997Q1", 1, "completed", None), ("1997Q1", 2, "started", None), ("1997Q2", 1, "completed", None)],
                                "quarter_id string, run_id long, run_status string, run_ts timestamp_ntz")
    found = dq.open_exceptions(exc, dq.rules_df(spark, q_dq.RETAIL_RULES), log)
    assert _sorted(found, "quarter_id", "rule_id", "severity", "record_key") == ["('1997Q1', 4, 'high', 'k1')"]
    plan = _plan(found)
    assert "hashpartitioning(rule_id" not in plan and "SortMergeJoin" not in plan
