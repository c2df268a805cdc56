"""Session construction and cluster-safe helpers (checkpointing, shipping the package)."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  UTC keeps date arithmetic on
# timestamp_ntz parquet columns identical to the SQL oracle; AQE coalesces
# small shuffle partitions, splits skewed ones and turns sort-merge joins into
# broadcast joins when the runtime size of a side is proven small.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shelfwise", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults applied.

    On a cluster pass ``master=None`` so spark-submit decides; tests and the
    bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a pre-existing session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A cluster must name one that all its machines share; without one this raises.
    Only a ``local[...]`` session, where driver and executors are one process, gets a
    scratch folder of its own when the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that Python functions run where it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfwise-"), "shelfwise.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def materialized(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    For a staged or conformed frame that several branches of one query read: its joins and parsing run once, and every
    branch reads only its own columns. The files survive lost executors.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and stops long operator
    chains from re-expanding to the raw scans.
    """
    spark = df.sparkSession
    spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)
