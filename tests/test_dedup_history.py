"""Dedup / history operators against brute force on small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import dedup, history, ranking


def test_keep_best_prefers_and_counts(spark):
    rows = [("k1", True, 3, "a"), ("k1", False, 9, "b"), ("k1", True, 5, "c"),
            ("k2", None, 1, "d"), ("k2", False, None, "e")]
    df = spark.createDataFrame(rows, "k string, ok boolean, v int, tag string")
    out = {r["k"]: r for r in dedup.keep_best(df, ["k"], [("ok", "desc"), ("v", "desc")]).collect()}
    assert out["k1"]["tag"] == "c" and out["k1"]["dup_group_size"] == 3
    assert out["k2"]["tag"] == "e"          # null preference loses (nulls last)


def test_keep_best_ascending(spark):
    df = spark.createDataFrame([("k", 3, "a"), ("k", 1, "b"), ("k", None, "c")], "k string, v int, tag string")
    assert dedup.keep_best(df, ["k"], [("v", "asc")]).collect()[0]["tag"] == "b"


def test_keep_best_matches_row_number(spark):
    import random
    random.seed(7)
    rows = [(random.randint(0, 20), random.choice([None, 1, 2, 3]), random.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, p int, x double")
    got = sorted((r["k"], r["p"], r["x"]) for r in dedup.keep_best(df, ["k"], [("p", "desc")]).collect())
    best = {}
    for k, p, x in rows:
        key = (p is not None, p if p is not None else 0, x)
        if k not in best or key > best[k][0]:
            best[k] = (key, (k, p, x))
    assert got == sorted(v[1] for v in best.values())


def test_duplicate_candidates_nullsafe(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", 1)], "x string, y int")
    flags = sorted((r["y"] is None, r["is_duplicate_candidate"])
                   for r in dedup.duplicate_candidates(df, ["x", "y"]).collect())
    assert flags == [(False, False), (True, True), (True, True)]


def test_effective_ranges(spark):
    rows = [("s", dt.date(2024, 1, 1), "a"), ("s", dt.date(2024, 1, 10), "b"), ("s", dt.date(2024, 1, 10), "c")]
    df = spark.createDataFrame(rows, "store string, d date, status string")
    out = sorted(history.effective_ranges(df, ["store"], "d").collect(), key=lambda r: r["d"])
    assert out[0]["valid_to"] == dt.date(2024, 1, 9) and out[1]["valid_to"] is None
    assert out[1]["rows_on_date"] == 2 and out[1]["is_current"]


def test_pairing_crosses_midnight(spark):
    t = dt.datetime
    rows = [("S", 1, t(2024, 1, 1, 22), "IN"), ("S", 1, t(2024, 1, 2, 2), "OUT"),
            ("S", 1, t(2024, 1, 2, 9), "IN"), ("S", 1, t(2024, 1, 2, 9, 30), "IN"),
            ("S", 1, t(2024, 1, 2, 17), "OUT")]
    df = spark.createDataFrame(rows, "store_code string, employee_id int, punch_ts timestamp, action string") \
        .withColumn("work_date", F.to_date("punch_ts"))
    daily = {r["work_date"]: r for r in history.labor_daily_employee(df, include_unpaired=True).collect()}
    assert daily[dt.date(2024, 1, 1)]["minutes_worked"] == 240.0   # 22:00 → 02:00 next day
    d2 = daily[dt.date(2024, 1, 2)]
    assert d2["n_shift_pairs"] == 1 and d2["n_unpaired_in"] == 1 and d2["minutes_worked"] == 450.0


def test_global_dense_rank_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 300).select((F.col("id") % 37).cast("double").alias("v"), F.col("id"))
    got = {r["id"]: r["r"] for r in ranking.global_dense_rank(df, [("v", "desc")], "r", partitions=5).collect()}
    ref = {r["id"]: r["r"] for r in df.select("id", F.dense_rank().over(Window.orderBy(F.col("v").desc())).alias("r")).collect()}
    assert got == ref


def test_distributed_rank_matches_windows(spark):
    import random
    from pyspark.sql import Window
    random.seed(11)
    rows = [(random.choice(["a", "b", "c"]), random.choice([None, 1.0, 2.0, 3.0, 4.0]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, id int")
    got = {r["id"]: (r["rank"], r["dense_rank"], round(r["percent_rank"], 9))
           for r in ranking.distributed_rank(df, ["g"], [("v", "desc")], partitions=6).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    ref = {r["id"]: (r["rk"], r["dr"], round(r["pr"], 9)) for r in df.select(
        "id", F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"),
        F.percent_rank().over(w).alias("pr")).collect()}
    assert got == ref


def test_fifo_layers_equal_unit_by_unit_matching(spark):
    import random
    from shelfwise.operators import semantic as S
    rng = random.Random(4)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    moves = {side: [(k, day(rng.randrange(40)), rng.choice([0, 1, 2, 5, None])) for k in "abc" for _ in range(rng.randrange(0, 25))]
             for side in ("in", "out")}
    moves["in"].append(("only_in", day(3), 4))
    moves["out"].append(("only_out", day(3), 4))
    frames = [spark.createDataFrame(m, "k string, date date, units int") for m in moves.values()]
    want = {}
    for key in {m[0] for v in moves.values() for m in v}:
        units = [sorted(d for k, d, u in moves[s] if k == key for _ in range(u or 0)) for s in ("in", "out")]
        for n in range(max(map(len, units))):
            pair = tuple(u[n] if n < len(u) else None for u in units)
            want[(key, *pair)] = want.get((key, *pair), 0) + 1
    got = S.fifo_layers(*frames, ["k"]).groupBy("k", "receipt_date", "issue_date").sum("units").collect()
    assert {tuple(r)[:3]: r[3] for r in got} == want
    aged = {r["k"]: r for r in S.aged_inventory(S.fifo_layers(*frames, ["k"]), ["k"], day(60)).collect()}
    assert (aged["only_in"]["on_hand_units"], aged["only_in"]["units_31_60"], aged["only_in"]["aged_share"]) == (4, 4, 0.0)
    assert (aged["only_out"]["unreceived_units"], aged["only_out"]["on_hand_units"], aged["only_out"]["aged_share"]) == (4, 0, None)


def test_mix_effects_add_up_and_cannibalised_totals_match(spark):
    import random
    from shelfwise.operators import semantic as S
    rng = random.Random(1)
    rows = [(dt.date(y, 1, 1), c, float(rng.randint(1, 100)), float(rng.randint(1, 40))) for y in (2022, 2023, 2024) for c in "abcde"
            for _ in range(3) if (y, c) not in ((2022, "a"), (2023, "b"))]
    sales = spark.createDataFrame(rows, "p date, c string, v double, m double")
    mix = S.mix_change(sales, "p", "c", "v", "m").collect()
    for year in (2023, 2024):
        total = lambda y, i: sum(r[i] for r in rows if r[0].year == y)
        change = total(year, 3) / total(year, 2) - total(year - 1, 3) / total(year - 1, 2)
        own = [r for r in mix if r["p"].year == year]
        assert abs(sum(r["within_effect"] + r["between_effect"] for r in own) - change) < 1e-12
        assert len(own) == 5 and abs(sum(r["mix_change"] for r in own)) < 1e-12
    lost = S.cannibalisation(sales, "p", "c", "v").collect()
    assert {r["p"].year for r in lost} == {2023, 2024}
    for year in (2023, 2024):
        own = [r for r in lost if r["p"].year == year]
        moved = min(own[0]["total_loss"], own[0]["total_gain"])
        assert abs(sum(r["cannibalised_loss"] for r in own) - moved) < 1e-9 and abs(sum(r["cannibalising_gain"] for r in own) - moved) < 1e-9
        assert all(r["revenue_loss"] == max(r["prior_revenue"] - r["revenue"], 0) for r in own)


def test_launch_windows_start_with_each_product(spark):
    from shelfwise.operators import semantic as S
    sales = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 3, 30), 2.0), ("a", dt.date(2024, 3, 31), 4.0),
                                   ("b", dt.date(2024, 3, 1), 8.0), ("b", dt.date(2024, 3, 9), 16.0), ("c", dt.date(2024, 9, 1), 32.0)],
                                  "k string, d date, v double")
    forecast = spark.createDataFrame([("a", 6.0), ("c", 1.0)], "k string, launch_forecast double")
    got = {r["k"]: (r["launch_revenue"], r["launch_success"], r["window_complete"])
           for r in S.launch_success(sales, forecast, "k", "d", "v", "2024-04-30").collect()}
    assert got == {"a": (3.0, 0.5, True), "b": (24.0, None, False)}
    ramp = {r["weeks_since_launch"]: (r["selling_products"], r["new_product_revenue"])
            for r in S.new_product_ramp(sales, "k", "d", "v", "2024-04-30", months=2).collect()}
    assert ramp == {0: (1, 8.0), 1: (1, 16.0)}


def test_trace_of_a_set_of_ids(spark):
    from shelfwise.operators import emissions as E
    cols = ", ".join(f"{c} string" for c in E.TRACE_COLUMNS if c not in ("activity_amount", "factor_id", "metric_tons_co2e"))
    row = lambda i, s, r, kg: (i, s, r, "e", "m", "s", "f", "p", "c", "u", "v", "ok", 2.0, 7, kg / 1000, "ft", kg)
    fact = spark.createDataFrame([row("x", "src", "5", 6.0), row("y", "src", "6", 9.0), row("z", "gone", "1", 6.0)],
                                 f"{cols}, activity_amount double, factor_id int, metric_tons_co2e double, factor_type string, kg_co2e double")
    factors = spark.createDataFrame([(7, "auth", 3.0, dt.date(2020, 1, 1), dt.date(2030, 1, 1))],
                                    "factor_id int, source_authority string, factor_value_kg_co2e_per_unit double, effective_start date, effective_end date")
    staged = {"src": spark.createDataFrame([(5, 2.0, "a.csv"), (6, 2.0, "b.csv")], "k long, source_amount double, source_file string")}
    keys = {"src": {"k": F.col("source_record_id").cast("long")}}
    ids = spark.createDataFrame([("x",), ("x",), ("y",), ("z",), ("nowhere",)], "activity_id string")
    got = {r["activity_id"]: (r["source_file"], r["recomputed_kg_co2e"], r["ties_out"]) for r in E.trace(ids, fact, factors, staged, keys).collect()}
    assert got == {"x": ("a.csv", 6.0, True), "y": ("b.csv", 6.0, False), "z": (None, None, False), "nowhere": (None, None, None)}


def test_license_reference_words_ties_and_summary(spark):
    from shelfwise.operators import reference as R
    rows = [("1", "a", "Recreational Retail", None, " new  york ", "2024-01-01"), ("1", "b", "Recreational Retail", None, "x", "2023-01-01"),
            ("2", "c", "RECREATIONAL", "Wholesaler", "nan", "2020-01-01"), ("3", "d", "recreational", "retail & wholesale", "", "never"),
            ("3", "e", "recreational", "retail", "", "2030-01-01"), ("4", "f", "Medical", "Retailer", "z", "2030-01-01"),
            ("5", "g", "Recreational", "Producer", "z", "2030-01-01"), (None, "h", "Recreational retail", "", "z", "2024-06-30"),
            (None, "i", "Recreational retail", "", "z", "2024-06-01")]
    ref = R.license_reference(spark.createDataFrame(rows, "license_number string, business_name string, business_licenses string, "
                                                          "license_type string, county string, expiration_date string"))
    got = {r["license_number"]: (r["business_name"], r["license_group"], r["county"]) for r in ref.collect()}
    assert got == {"1": ("a", "Recreational Retailer", "New  York"), "2": ("c", "Recreational Wholesaler", None),
                   "3": ("d", "Recreational Retailer/Wholesaler", None), None: ("h", "Recreational Retailer", "Z")}
    levels = {(r["summary_level"], r["license_group"], r["county"], r["license_status"]): r["location_count"]
              for r in R.license_summary(ref, dt.date(2024, 6, 30)).collect()}
    assert levels[("license_group", "Recreational Retailer", None, None)] == 2
    assert levels[("license_group_status", "Recreational Retailer", None, "Active/Unexpired")] == 1
    assert levels[("license_group_status", "Recreational Retailer/Wholesaler", None, "Unknown")] == 1
    assert levels[("county_license_group", "Recreational Wholesaler", None, None)] == 1
    assert sum(n for (level, *_), n in levels.items() if level == "license_group") == 4


def test_key_universe_keeps_which_sources_know_a_key(spark):
    from shelfwise.operators import reference as R
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "store_id string")
    got = {r["store_id"]: (r["source_bits"], r["known_in"], r["source_count"], r["state_code"])
           for r in R.store_dimension_of({"a": one("NY1", "NY1", " ", None), "b": one("CA2", " NY1 "), "c": one()}).collect()}
    assert got == {"NY1": (3, "a,b", 2, "NY"), "CA2": (2, "b", 1, "CA")}


def test_sorted_export_is_ordered_over_files_and_cuts_through_ties(spark, tmp_path):
    import random
    from shelfwise.sources import files
    rng = random.Random(2)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([None, 1.5, 2.5, float(i)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, tag string, v double").repartition(5)
    path = str(tmp_path / "sorted")
    files.export_sorted(df, path, [files.ranked("tag", ["b", "hot"]), F.col("v").desc_nulls_last(), F.col("id")], files=6)
    got = [tuple(r)[:3] for r in files.read_positions(spark, path).orderBy("position").collect()]
    rank = {"b": 0, "hot": 1}
    assert got == sorted(rows, key=lambda r: (rank.get(r[1], 2), r[2] is None, -(r[2] or 0), r[0]))
    sizes = [r["n"] for r in files.read_positions(spark, path).groupBy(F.floor((F.col("position") - 1) / 500)).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000
    parts = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(parts) == 6 and max(r["count"] for r in parts) < 1000  # the hot value spans several files


def test_feed_numbers_lose_money_signs_only(spark):
    from shelfwise.operators import standardize
    feed = spark.createDataFrame([("$1,200.50", "12 ea", "10%", "0.1"), ("7", "2", " 3 ", None)], "`Unit Price` string, Qty string, cogs string, `Discount PCT` string")
    a, b = sorted(standardize.standardize(feed, "sales", "s").collect(), key=lambda r: r["qty"] is not None)
    number = lambda r, *c: [None if r[x] is None else float(r[x]) for x in c]
    columns = ("qty", "unit_list_price", "cogs_amount", "unit_net_price", "gross_sales_amount", "discount_amount", "net_sales_amount")
    assert number(a, *columns) == [None, 1200.5, None, 1080.45, None, None, None]
    assert number(b, *columns) == [2.0, 7.0, 3.0, 7.0, 14.0, 0.0, 14.0]
