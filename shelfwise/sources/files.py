"""Sources and sinks.

Readers never infer schemas from raw text: landing columns are all strings
with explicit null markers, typed later by staging operators.  Writers go to
parquet / CSV folders; on a cluster pass shared (HDFS / object-store) paths.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARKERS = ("NULL", "null")


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with header, every column text; ``""`` / ``NULL`` / ``null`` → null."""
    df = (spark.read.schema(string_schema(columns)).option("header", True).option("nullValue", "")
          .option("emptyValue", None).option("mode", "PERMISSIVE").csv(path))
    return df.select(*[F.when(~F.col(c).isin(*NULL_MARKERS), F.col(c)).alias(c) for c in columns])


def add_lineage(df: DataFrame, load_id: str, source_system: str, cadence: str, drop_date: str | None = None,
                with_file: bool = True) -> DataFrame:
    """Landing lineage columns; the source file comes from the scan's ``_metadata``."""
    cols = {"load_id": F.lit(load_id), "source_system": F.lit(source_system), "cadence": F.lit(cadence),
            "drop_date": F.lit(drop_date).cast("date"), "ingested_at": F.current_timestamp()}
    if with_file:
        try:
            cols["source_file"] = F.col("_metadata.file_path")
            return df.select("*", *[v.alias(k) for k, v in cols.items()])
        except Exception:  # frames not backed by a file scan
            cols.pop("source_file")
    return df.withColumns(cols)


@dataclass(frozen=True)
class SourceSpec:
    """One expected file → one landing table."""
    domain: str
    system: str
    path: str
    table: str
    fmt: str = "csv"
    columns: tuple = ()
    active: bool = True


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _read(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    if spec.fmt == "csv":
        return read_raw_csv(spark, spec.path, spec.columns)
    return spark.read.format(spec.fmt).load(spec.path)


def ingest(spark: SparkSession, specs: Iterable[SourceSpec]) -> dict[str, DataFrame]:
    """S3: read every present file of the catalogue (missing files are skipped with a notice);
    files landing in the same table are unioned by name."""
    out: dict[str, DataFrame] = {}
    for s in specs:
        if not _exists(spark, s.path):
            print(f"NOTICE: source file missing, skipped: {s.domain}/{s.system} {s.path}")
            continue
        df = add_lineage(_read(spark, s), load_id=os.path.basename(s.path), source_system=s.system, cadence="daily")
        out[s.table] = df if s.table not in out else out[s.table].unionByName(df, allowMissingColumns=True)
    return out


REPORT_SCHEMA = "domain string, system string, path string, target_table string, status string, row_count bigint"


def ingest_manifest(spark: SparkSession, specs: Sequence[SourceSpec], strict: bool = False
                    ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Manifest-driven ingest with a per-file report ``skipped / missing / ingested / error:<type>`` + row count.

    Only schemas are read while the report is built; the counts are part of its plan, one aggregate per present file,
    and run together when it is used. ``strict`` raises on the first missing or unreadable file.
    """
    tables: dict[str, DataFrame] = {}
    counted, rest = [], []
    for s in specs:
        row = (s.domain, s.system, s.path, s.table)
        if not s.active:
            rest.append((*row, "skipped", None))
            continue
        if not _exists(spark, s.path):
            if strict:
                raise FileNotFoundError(s.path)
            rest.append((*row, "missing", None))
            continue
        try:
            df = _read(spark, s)
        except AnalysisException as e:
            if strict:
                raise
            rest.append((*row, f"error:{type(e).__name__}", None))
            continue
        tables[s.table] = df if s.table not in tables else tables[s.table].unionByName(df, allowMissingColumns=True)
        counted.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            *[F.lit(v).alias(c) for v, c in zip(row, ("domain", "system", "path", "target_table"), strict=True)],
            F.lit("ingested").alias("status"), "row_count"))
    report = spark.createDataFrame(rest, REPORT_SCHEMA)
    for c in counted:
        report = report.unionByName(c)
    return tables, report


def load(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Truncate-and-load (``overwrite``) or append-load into a parquet table folder."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def load_columns(df: DataFrame, columns: Sequence[str], path: str, mode: str = "append") -> None:
    """Bulk load with an explicit column list."""
    load(df.select(*columns), path, mode)


def export_csv(frames: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One header CSV folder per frame (written in parallel part files)."""
    paths = {}
    for name, df in frames.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").option("header", True).csv(p)
        paths[name] = p
    return paths


def recent(df: DataFrame, date_col: str, days: int, as_of=None) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of`` (default: the frame's latest date, resolved once, so that
    the bound reaches the scan as a literal)."""
    from ..operators.calendar import latest_date
    a = F.lit(as_of or latest_date(df, date_col)).cast("date")
    return df.filter((F.col(date_col) > F.date_sub(a, days)) & (F.col(date_col) <= a))


def export_recent(facts: dict[str, tuple[DataFrame, str]], dims: dict[str, DataFrame], days: int, out_dir: str,
                  as_of: str | None = None) -> dict[str, str]:
    """Facts limited to the last ``days`` days, dimensions whole, as header CSV."""
    frames = {k: recent(df, c, days, as_of) for k, (df, c) in facts.items()}
    frames.update(dims)
    return export_csv(frames, out_dir)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """CTAS — write then read back, cutting the lineage of a long view chain."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def register(frames: dict[str, DataFrame]) -> None:
    """Register views in dependency order (dict order)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def dump_exceptions(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rejected rows with the reason of the first rule they break (``exception_reason``)."""
    reason = None
    for name, cond in rules.items():
        c = F.coalesce(cond, F.lit(False))
        reason = F.when(c, F.lit(name)) if reason is None else reason.when(c, F.lit(name))
    return df.withColumn("exception_reason", reason).filter(F.col("exception_reason").isNotNull())


def ranked(column: str, order: Sequence) -> Column:
    """Place of a value in a stated order (0 first); values outside it come last."""
    rank = None
    for i, v in enumerate(order):
        rank = F.when(F.col(column) == v, F.lit(i)) if rank is None else rank.when(F.col(column) == v, F.lit(i))
    return rank.otherwise(F.lit(len(order)))


def export_sorted(df: DataFrame, path: str, order: Sequence[Column], files: int | None = None) -> None:
    """The rows in one global order over part files: file by file in name order, each sorted inside.

    Rows are dealt by ranges of the whole order and sorted there, so no task holds more than a range. The order must be total where one
    value may hold a large share of the rows: pass the remaining columns too, so that ranges can cut through ties.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a sorted export with their global position (from 1): rows of the files before, and the place in the file.

    The driver sees nothing; the counts of the files (one row each) are joined back.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    counts = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = counts.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(offsets, "__file").withColumn("position", F.col("__before") + F.col("__at") + 1).drop("__file", "__at", "__before")
