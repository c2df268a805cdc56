"""Source / sink and streaming queries.

Scratch output goes under the session's checkpoint folder (the shared
location named by ``spark.checkpoint.dir`` on a cluster).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators import staging
from ..session import checkpoint_dir
from ..sources import files
from ..sources.testdata import Tables
from ..streaming.incremental import first_arrivals, keep_best_incremental
from . import model, raw
from .oracle import SALES_LINES
from .q_clean import H4_CORE
from .registry import query, rounded


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfwise-io/{name}-{uuid.uuid4().hex}"


CUSTOMER_COLS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")

S1_SQL = "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 4) AS c_acctbal, c_mktsegment, " \
         "'customer.csv' AS load_id, 'crm' AS source_system FROM customer"


@query("s1_csv_roundtrip", S1_SQL)
def q_s1(spark, d):
    """Export the customer table as header CSV, land it as all-text with lineage, type it."""
    out = _scratch(spark, "csv")
    files.export_csv({"customer": Tables(spark, d).customer}, out)
    landed = files.add_lineage(files.read_raw_csv(spark, f"{out}/customer", CUSTOMER_COLS),
                               load_id="customer.csv", source_system="crm", cadence="daily")
    typed = staging.stage_text_casts(landed.select(*CUSTOMER_COLS, "load_id", "source_system"),
                                     {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})
    return rounded(typed)


S4_SQL = """
SELECT domain, system, target_table, status, row_count FROM (VALUES
  ('sales', 'erp', 'raw.lineitem', 'ingested', (SELECT COUNT(*) FROM lineitem)),
  ('sales', 'erp', 'raw.orders', 'ingested', (SELECT COUNT(*) FROM orders)),
  ('crm', 'crm', 'raw.customer', 'ingested', (SELECT COUNT(*) FROM customer)),
  ('hr', 'timeclock', 'raw.events', 'skipped', CAST(NULL AS BIGINT)),
  ('finance', 'gl', 'raw.returns', 'missing', CAST(NULL AS BIGINT))) AS t(domain, system, target_table, status, row_count)
"""


@query("s4_manifest_ingest", S4_SQL)
def q_s4(spark, d):
    specs = [files.SourceSpec("sales", "erp", f"{d}/lineitem.parquet", "raw.lineitem", "parquet"),
             files.SourceSpec("sales", "erp", f"{d}/orders.parquet", "raw.orders", "parquet"),
             files.SourceSpec("crm", "crm", f"{d}/customer.parquet", "raw.customer", "parquet"),
             files.SourceSpec("hr", "timeclock", f"{d}/events.parquet", "raw.events", "parquet", active=False),
             files.SourceSpec("finance", "gl", f"{d}/returns.parquet", "raw.returns", "parquet")]
    _, report = files.ingest_manifest(spark, specs)
    return report.select("domain", "system", "target_table", "status", "row_count")


S3_SQL = """
SELECT c_custkey, c_mktsegment, n AS loads FROM (SELECT c_custkey, c_mktsegment FROM customer), (SELECT unnest([1, 2]) AS n)
"""


@query("s3_catalogue_load", S3_SQL)
def q_s3(spark, d):
    """Two CSV drops and a missing one are ingested by catalogue, loaded column by column (truncate,
    then append), written as a table and queried through a view."""
    root = _scratch(spark, "s3")
    files.export_csv({"customer": Tables(spark, d).customer}, f"{root}/drops")
    specs = [files.SourceSpec("crm", "crm", f"{root}/drops/customer", "raw.customer", columns=CUSTOMER_COLS),
             files.SourceSpec("crm", "old_crm", f"{root}/drops/nothing", "raw.customer", columns=CUSTOMER_COLS)]
    landed = files.ingest(spark, specs)["raw.customer"]
    for load, mode in ((1, "overwrite"), (2, "append")):
        files.load_columns(landed.withColumn("loads", F.lit(load)), ["c_custkey", "c_mktsegment", "loads"], f"{root}/table", mode)
    typed = files.materialise(spark.read.parquet(f"{root}/table").withColumn("c_custkey", F.col("c_custkey").cast("bigint")), f"{root}/typed")
    files.register({"s3_customer_loads": typed})
    return spark.sql("SELECT c_custkey, c_mktsegment, loads FROM s3_customer_loads")


S8_SQL = f"""
WITH {SALES_LINES}
SELECT order_id, line_number, sale_date, store_id, sku, round(net_sales, 4) AS net_sales FROM sales_lines
WHERE sale_date > CAST((SELECT max(sale_date) FROM sales_lines) - INTERVAL 30 DAY AS DATE)
"""


@query("s8_export_recent", S8_SQL)
def q_s8(spark, d):
    t = Tables(spark, d)
    end = model.latest_sale_date(t)
    s = model.sales_lines(t, since=end and end - dt.timedelta(days=29)).select("order_id", "line_number", "sale_date", "store_id", "sku", "net_sales")
    dims = {"dim_store": model.stores(t).select("store_id", "store_name")}
    paths = files.export_recent({"fact_sales": (s, "sale_date")}, dims, 30, _scratch(spark, "recent"), as_of=end)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.schema)
    return rounded(spark.read.schema(kinds).option("header", True).csv(paths["fact_sales"]))


S12_SQL = f"""
WITH h4 AS ({H4_CORE}),
e AS (SELECT *, CASE WHEN COALESCE(is_missing_key, FALSE) THEN 'missing_key'
                     WHEN COALESCE(is_bad_amount, FALSE) THEN 'bad_amount'
                     WHEN COALESCE(is_duplicate_candidate, FALSE) THEN 'duplicate' END AS exception_reason FROM h4)
SELECT load_id, sale_date, store_code, sku, channel, qty, round(net_sales, 4) AS net_sales, exception_reason
FROM e WHERE exception_reason IS NOT NULL
"""


@query("s12_dump_exceptions", S12_SQL)
def q_s12(spark, d):
    staged = staging.stage_sales_distributor(raw.sales_distributor_extract(Tables(spark, d)))
    rej = files.dump_exceptions(staged, {"missing_key": F.col("is_missing_key"), "bad_amount": F.col("is_bad_amount"),
                                         "duplicate": F.col("is_duplicate_candidate")})
    return rounded(rej.select("load_id", "sale_date", "store_code", "sku", "channel", "qty", "net_sales",
                              "exception_reason"))


_LINES = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus", "l_shipdate")
R1_SQL = f"""
SELECT l_orderkey, {", ".join(_LINES)}, dup_group_size
FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey) AS dup_group_size,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY (l_linestatus = 'F') DESC NULLS LAST, l_shipdate DESC NULLS LAST,
                            {", ".join(f"{c} DESC NULLS LAST" for c in _LINES)}) AS rn
  FROM lineitem
) WHERE rn = 1
"""


# Rows that a bucket of the keep-best table holds on average.
BUCKET_ROWS = 500_000
DROPS = 4


@query("r1_stream_keep_best", R1_SQL)
def q_r1(spark, d):
    """Lineitem lands in four drops (by line number, so the lines of an order arrive in different drops, the later
    ones late); each drop is streamed into a keep-best table with one line per order as it lands."""
    lines = Tables(spark, d).lineitem.select("l_orderkey", *_LINES)
    root = _scratch(spark, "r1")
    buckets = max(8, -(-lines.count() // BUCKET_ROWS))
    for k in range(DROPS):
        lines.filter(F.pmod(F.col("l_linenumber"), F.lit(DROPS)) == k).write.parquet(f"{root}/drops/drop={k}")
        stream = spark.readStream.schema(lines.schema).option("recursiveFileLookup", True).parquet(f"{root}/drops")
        best = keep_best_incremental(stream, ["l_orderkey"], [(F.col("l_linestatus") == "F", "desc"), ("l_shipdate", "desc")],
                                     f"{root}/table", buckets=buckets)
    return best


R1_FIRST_SQL = """
WITH e AS (SELECT event_id, ts, user_id, event_type, value, ntile FROM (
             SELECT *, CAST(floor((epoch(ts) - epoch(min(ts) OVER ())) / (86400 * 8)) AS INTEGER) AS ntile FROM events)),
a AS (SELECT *, ntile AS arrived FROM e
      UNION ALL SELECT event_id, ts, user_id, event_type, value + 1000, ntile, ntile + 1 FROM e WHERE event_id % 7 = 0)
SELECT event_id, ts, user_id, event_type, round(value, 4) AS value FROM a QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrived) = 1
"""


@query("r1_stream_first_arrival", R1_FIRST_SQL)
def q_r1_first(spark, d):
    """Events land in drops of eight days; every seventh event is sent again with the next drop, late and with another value.
    The first arrival of each event stays; the stream's state holds the keys of sixteen days."""
    events = Tables(spark, d).events
    kept = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    first, last = kept.agg(F.min("ts"), F.max("ts")).first()
    root = _scratch(spark, "first")
    drop = F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(first))) / (8 * 86400 * 1_000_000))
    again = kept.filter(F.col("event_id") % 7 == 0).withColumn("value", F.col("value") + 1000)
    for k in range((last - first).days // 8 + 2):
        kept.filter(drop == k).unionByName(again.filter(drop + 1 == k)).write.parquet(f"{root}/drops/drop={k}")
        stream = spark.readStream.schema(kept.schema).option("recursiveFileLookup", True).parquet(f"{root}/drops")
        arrivals = first_arrivals(stream, ["event_id"], "ts", f"{root}/table", delay="16 days")
    return rounded(arrivals.rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")))
