"""Readers for the driver-generated parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# (id(session), path) -> (session, scan).  Holding the session keeps its id from
# being reused by a later session, so a scan is never served to the wrong one.
_SCANS: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters still reach the scan via Catalyst.

    The driver's test tables are read-only, so the scan (file listing and footer
    read happen eagerly when a reader is created) is built once per session and
    path; it holds no data.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _SCANS.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, spark.read.parquet(path))
        _SCANS[key] = hit
    return hit[1]


class Tables:
    """Attribute access to the test tables of one scale factor (each table read once)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            cache = self.__dict__.setdefault("_cache", {})
            if name not in cache:
                cache[name] = table(self.spark, self.sf_dir, name)
            return cache[name]
        raise AttributeError(name)
