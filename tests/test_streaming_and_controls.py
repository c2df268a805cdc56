"""Multi-batch streaming keep-best, duplicate flags vs window counts, continuity, upsert, rule evaluation."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators import dedup, dq, recon
from shelfwise.streaming import incremental


DROPS = [[(1, 5, "a"), (2, 1, "b"), (None, 1, "n")], [(1, 9, "c"), (3, 2, "d")], [(1, 7, "e"), (2, 4, "f"), (2, 4, "g"), (None, 2, "m")]]
SCHEMA = "k int, v int, tag string"
PREFER = [("v", "desc")]


def _table(spark, root):
    return {r["k"]: (r["v"], r["tag"], r["dup_group_size"]) for r in incremental.read_table(spark, root).collect()}


def _reference(spark, drops):
    rows = spark.createDataFrame([r for d in drops for r in d], SCHEMA)
    return {r["k"]: (r["v"], r["tag"], r["dup_group_size"]) for r in dedup.keep_best(rows, ["k"], PREFER).collect()}


def _merge(spark, root, epoch):
    incremental.merge_epoch(spark.createDataFrame(DROPS[epoch], SCHEMA), epoch, ["k"], PREFER, root, buckets=4)


def test_keep_best_incremental_across_drops(spark, tmp_path):
    src, root = str(tmp_path / "drops"), str(tmp_path / "table")
    for i, rows in enumerate(DROPS):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"drop={i}"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(src)
    incremental.keep_best_incremental(stream, ["k"], PREFER, root, buckets=4)
    got = _table(spark, root)
    assert got == _reference(spark, DROPS)
    assert got[1] == (9, "c", 3) and got[2] == (4, "g", 3)
    # Nothing new: the stream runs again and changes nothing; without its checkpoint it refuses to run.
    incremental.keep_best_incremental(stream, ["k"], PREFER, root, buckets=4)
    assert _table(spark, root) == got
    os.rename(os.path.join(root, "stream"), str(tmp_path / "lost"))
    with pytest.raises(ValueError, match="checkpoint"):
        incremental.keep_best_incremental(stream, ["k"], PREFER, root, buckets=4)
    assert _table(spark, root) == got


def test_replaying_an_epoch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "table")
    for e in range(3):
        _merge(spark, root, e)
        for again in range(e + 1):
            _merge(spark, root, again)
        assert _table(spark, root) == _reference(spark, DROPS[:e + 1])


def test_an_epoch_killed_before_its_commit_is_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    _merge(spark, root, 0)
    with monkeypatch.context() as m:
        m.setattr(incremental, "_remove_unnamed", lambda *a, **k: None)
        _merge(spark, root, 1)
    os.remove(os.path.join(root, "manifest", "epoch=1", "_SUCCESS"))  # as if the driver died while publishing
    assert _table(spark, root) == _reference(spark, DROPS[:1])
    _merge(spark, root, 1)
    _merge(spark, root, 2)
    assert _table(spark, root) == _reference(spark, DROPS)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "table")
    many = spark.createDataFrame([(i, i, "x") for i in range(200)], SCHEMA)
    incremental.merge_epoch(many, 0, ["k"], PREFER, root, buckets=16)
    incremental.merge_epoch(spark.createDataFrame([(7, 999, "y")], SCHEMA), 1, ["k"], PREFER, root, buckets=16)
    new = [n for n in os.listdir(os.path.join(root, "data", "epoch=1")) if n.startswith("bucket=")]
    assert len(new) == 1 and _table(spark, root)[7] == (999, "y", 2)


def test_duplicate_flags_equal_window_count(spark):
    import random
    random.seed(3)
    rows = [(random.choice(["a", "b", None]), random.randint(0, 5)) for _ in range(300)]
    df = spark.createDataFrame(rows, "x string, y int").withColumn("id", F.monotonically_increasing_id())
    got = {r["id"]: r["is_duplicate_candidate"] for r in dedup.duplicate_candidates(df, ["x", "y"]).collect()}
    w = Window.partitionBy("x", "y")
    ref = {r["id"]: r["f"] for r in df.select("id", (F.count(F.lit(1)).over(w) > 1).alias("f")).collect()}
    assert got == ref


def test_continuity_counts_missing_weeks(spark):
    d = dt.date
    rows = [("s1", d(2024, 1, 1)), ("s1", d(2024, 1, 15)), ("s1", d(2024, 1, 16)), ("s2", d(2024, 1, 3))]
    out = {r["store"]: r for r in dq.continuity(spark.createDataFrame(rows, "store string, sale_date date"),
                                                "store", "sale_date").collect()}
    assert out["s1"]["active_periods"] == 2 and out["s1"]["missing_periods"] == 1
    assert out["s2"]["missing_periods"] == 0 and out["s2"]["continuity_pct"] == 1.0


def test_upsert_replaces_and_keeps(spark):
    cur = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    upd = spark.createDataFrame([(1, "new"), (3, "add")], "k int, v string")
    assert sorted(tuple(r) for r in dq.upsert(cur, upd, ["k"]).collect()) == [(1, "new"), (2, "keep"), (3, "add")]


def test_rule_evaluation_single_pass_matches_counts(spark):
    df = spark.createDataFrame([("q1", None, 1), ("q1", "a", -2), ("q2", "b", 3), ("q2", "b", 4)], "quarter_id string, k string, n int")
    rules = [dq.Rule(1, "k present", "completeness", "t", "required", cols=("k",)),
             dq.Rule(2, "n non-negative", "validity", "t", "predicate", fail_when="n < 0", severity="high"),
             dq.Rule(3, "k unique", "uniqueness", "t", "unique", cols=("k",), severity="medium")]
    res = {(r["quarter_id"], r["rule_id"]): (r["checked_count"], r["failed_count"], r["status"])
           for r in dq.evaluate_rules(df, rules, run_id=7, by=["quarter_id"]).collect()}
    assert res[("q1", 1)] == (2, 1, "fail") and res[("q1", 2)] == (2, 1, "fail")
    assert res[("q2", 3)] == (2, 1, "fail") and res[("q1", 3)] == (2, 0, "pass")


def test_worst_status_wins(spark):
    df = spark.createDataFrame([("q", "pass"), ("q", "fail"), ("q", "warn")], "q string, status string")
    assert df.groupBy("q").agg(dq.worst_status(F.col("status")).alias("w")).collect()[0]["w"] == "fail"


def _certify(spark, runs, exc=(), rec=()):
    log = spark.createDataFrame([(*r, None) for r in runs], "quarter_id string, run_id long, run_status string, run_ts timestamp")
    e = spark.createDataFrame(list(exc), "quarter_id string, run_id long, severity string")
    r = spark.createDataFrame(list(rec), "quarter_id string, run_id long, status string")
    out = dq.certify(log, e, dq.reconciliation_summary(r, log))
    return {x["quarter_id"]: (x["certification_status"], x["certification_reason"], x["reconciliation_status"]) for x in out.collect()}


def test_certification_holds_without_evidence(spark):
    runs = [("a", 1, "completed"), ("b", 1, "completed"), ("b", 2, "started"), ("c", 1, "completed"), ("d", 1, "completed"),
            ("e", 1, "completed"), ("e", 2, "completed"), ("f", 1, "completed")]
    rec = [("b", 2, "pass"), ("c", 1, "pass"), ("d", 1, "pass"), ("e", 1, "pass"), ("f", 1, "pass"), ("f", 1, "fail")]
    exc = [("c", 1, "critical"), ("d", 1, "high")]
    got = _certify(spark, runs, exc, rec)
    assert got == {
        "a": ("hold", "reconciliation failed or not run", "not_run"), "b": ("hold", "latest dq run not completed", "pass"),
        "c": ("hold", "open critical exceptions remain", "pass"), "d": ("certified", "ready for reporting", "pass"),
        "e": ("hold", "reconciliation failed or not run", "not_run"), "f": ("hold", "reconciliation failed or not run", "fail")}


def test_reconciliation_fails_without_a_target(spark):
    left = spark.createDataFrame([("q", 0.0), ("r", 5.0), ("s", 100.0)], "k string, a double")
    right = spark.createDataFrame([("q", 0.0), ("s", 101.0), ("t", 3.0)], "k string, b double")
    got = {r["k"]: r["recon_status"] for r in recon.reconcile_totals(left, right, ["k"], "a", "b", rel_tol=0.02).collect()}
    assert got == {"q": "fail", "r": "fail", "s": "pass", "t": "fail"}


def test_missing_dimension_ladder(spark):
    rows = [("2024-01-01", True)] + [("2024-01-01", False)] * 999 + [("2024-01-02", False)] + [("2024-01-03", True)] + [("2024-01-03", False)] * 500
    df = spark.createDataFrame(rows, "d string, missing boolean")
    got = {str(r["grain_date"]): r["status"] for r in recon.missing_dim_control([("m", df, "d", "dim", F.col("missing"))]).collect()}
    assert got == {"2024-01-01": "WARN_low", "2024-01-02": "PASS", "2024-01-03": "FAIL"}


def test_certification_gaps_name_missing_expired_and_uncertified(spark):
    cert = spark.createDataFrame([("a", "Certified", dt.date(2024, 6, 1)), ("b", "certified", dt.date(2024, 1, 1)), ("c", "pending", dt.date(2030, 1, 1))],
                                 "s string, certification_status string, certified_through date")
    expected = spark.createDataFrame([("a",), ("d",)], "s string")
    got = {(r["s"], r["gap"]) for r in dq.certification_gaps(expected, cert, "s", "2024-03-31").collect()}
    assert got == {("d", "missing"), ("b", "expired"), ("c", "not certified")}


def test_raise_on_fail_names_every_failure(spark):
    checks = spark.createDataFrame([("t", f"c{i}", 1, "FAIL") for i in range(70)] + [("t", "ok", 0, "PASS")],
                                   "relation string, check_name string, failed_count long, status string")
    with pytest.raises(dq.ContractViolation) as e:
        dq.raise_on_fail(checks)
    assert str(e.value).count("t.c") == 70


def test_newest_master_row_beats_a_stale_complete_one(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), "id", "name", False), ("s", dt.date(2024, 5, 1), "id", None, False),
                                ("s", dt.date(2024, 5, 1), None, "x", True)],
                               "store_code string, as_of_date date, dispensary_id string, dispensary_name string, is_missing_key boolean")
    got = dedup.latest_complete(df, ["store_code"], ["dispensary_id", "dispensary_name"], F.col("as_of_date")).collect()[0]
    assert (got["as_of_date"], got["dispensary_id"], got["version_count"]) == (dt.date(2024, 5, 1), "id", 3)


def test_run_log_starts_at_one_only_without_a_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert [dq.open_run(spark, path, "q", "x", "b") for _ in range(2)] == [1, 2]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        dq.open_run(spark, str(bad), "q", "x", "b")


def test_layers_meet_on_their_latest_common_date(spark):
    from shelfwise.operators.recon import Layer, LayerPair, latest_common_dates, layer_reconciliation
    day = lambda k: dt.date(2024, 1, k)
    source = spark.createDataFrame([(day(1), 1.25, 2), (day(2), 10.10, 3), (day(2), None, 4), (day(3), 7.0, 1)], "d date, net double, n int")
    modeled = spark.createDataFrame([(day(1), 1.25, 2), (day(2), 10.10, 8)], "d date, net double, n int")
    none = spark.createDataFrame([], "d date, net double, n int")
    asked = []

    def layer(name, frame):
        def build(on):
            asked.append((name, on))
            return frame
        return Layer(name, "d", build, {"net": "net", "n": "n"}, lambda: frame.select("d"))

    pairs = [LayerPair("a", "day", layer("src", source), layer("mart", modeled)),
             LayerPair("b", "day", layer("src", source), layer("mart", none)),
             LayerPair("c", "day", layer("src", none), layer("mart", none)),
             LayerPair("d", "day", layer("src", source), layer("mart", modeled), tolerance_pct=0.2)]
    assert latest_common_dates(pairs) == {"a": day(2), "b": day(3), "c": None, "d": day(2)}
    assert not asked  # dates come from the cheaper frames
    got = {r["check_name"]: (r["check_date"], r["source_total"], r["modeled_total"], r["status_detail"]) for r in layer_reconciliation(pairs).collect()}
    assert asked[0] == ("src", day(2)) and len(asked) == 8  # one read of each layer
    as_float = {k: (d, s and float(s), m and float(m), x) for k, (d, s, m, x) in got.items()}
    assert as_float == {
        "a:net": (day(2), 10.1, 10.1, "PASS"), "a:n": (day(2), 7.0, 8.0, "FAIL_mismatch"),
        "b:net": (day(3), 7.0, None, "FAIL_missing_modeled"), "b:n": (day(3), 1.0, None, "FAIL_missing_modeled"),
        "c:net": (None, None, None, "FAIL_missing_source"), "c:n": (None, None, None, "FAIL_missing_source"),
        "d:net": (day(2), 10.1, 10.1, "PASS"), "d:n": (day(2), 7.0, 8.0, "PASS")}


def test_layers_must_name_the_same_measures(spark):
    from shelfwise.operators.recon import Layer, LayerPair, layer_reconciliation
    f = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "d date, n int")
    with pytest.raises(ValueError):
        layer_reconciliation([LayerPair("a", "day", Layer("s", "d", lambda on: f, {"n": "n"}), Layer("m", "d", lambda on: f, {"x": "n"}))])


def _land(spark, root, k, rows):
    spark.createDataFrame([(i, dt.datetime(2024, 1, d), v) for i, d, v in rows], "id int, ts timestamp, v string").repartition(2) \
        .write.parquet(f"{root}/drops/drop={k}")
    stream = spark.readStream.schema("id int, ts timestamp, v string").option("recursiveFileLookup", True).parquet(f"{root}/drops")
    return incremental.first_arrivals(stream, ["id"], "ts", f"{root}/table", delay="3 days")


ARRIVALS = [[(1, 1, "a"), (2, 2, "b"), (3, 2, "c")], [(1, 1, "late copy"), (4, 4, "d")], [(2, 2, "late copy"), (5, 6, "e")],
            [(6, 20, "f")], [(7, 21, "g"), (6, 20, "late copy")], [(8, 5, "too late"), (9, 22, "h")], [(9, 22, "late copy")]]


def test_first_arrivals_survive_restarts_with_bounded_state(spark, tmp_path):
    root = str(tmp_path / "first")
    held, lost = [], 0
    for k, rows in enumerate(ARRIVALS):  # every drop is a new run that starts from the checkpoint
        out = _land(spark, root, k, rows)
        held.append(out.keys_held)
        lost += out.too_late
    got = {(r["id"], r["v"]) for r in out.rows.collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f"), (7, "g"), (9, "h")}
    assert out.rows.count() == len(got) and lost == 1
    assert max(held) <= 6 and held[-1] <= 3  # keys older than the delay leave the state


def test_a_killed_micro_batch_of_first_arrivals_is_run_again(spark, tmp_path):
    root = str(tmp_path / "killed")
    for k, rows in enumerate(ARRIVALS[:2]):
        _land(spark, root, k, rows)
    commits = sorted((tmp_path / "killed" / "table" / "stream" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()  # the batch wrote its rows, but was killed before its commit
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    out = _land(spark, root, 2, ARRIVALS[2])
    assert sorted((r["id"], r["v"]) for r in out.rows.collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")]


def test_control_confidence_is_the_share_of_passing_rows(spark):
    rows = spark.createDataFrame([("w1", "Pass"), ("w1", "Fail"), ("w1", None), ("w1", "Pass"), ("w2", None)], "week string, status string")
    got = {r["week"]: r["data_confidence_score"] for r in recon.confidence(rows, ["week"], "Pass").collect()}
    assert got == {"w1": 0.5, "w2": 0.0}


def test_lineage_matrix_tells_where_a_column_ends(spark):
    layers = {"raw": spark.range(1).selectExpr("id AS a", "id AS b"), "stg": spark.range(1).selectExpr("id AS a", "id AS c"),
              "mart": spark.range(1).selectExpr("id AS a")}
    got = {r["column_name"]: r for r in recon.lineage_matrix(layers).collect()}
    flags = lambda c: (got[c]["raw"], got[c]["stg"], got[c]["mart"], got[c]["reaches_last_layer"], got[c]["dropped_after_first"])
    assert flags("a") == (True, True, True, True, False)
    assert flags("b") == (True, False, False, False, True)
    assert flags("c") == (False, True, False, False, False)


def test_materialized_frames_are_written_once(spark):
    from shelfwise.session import materialized
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    back = materialized(df, "t")
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == [(1, None), (2, "x")]
    assert materialized(df.filter("k > 5"), "t").count() == 0
