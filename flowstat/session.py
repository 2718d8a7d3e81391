"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every flowstat job wants.  They only fill gaps: a value set by the
# caller or already present in the Spark configuration (spark-defaults.conf,
# --conf) wins.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Only a dimension that is proven small (by Spark's size estimate, or by
    # AQE's runtime statistics) is broadcast; everything else sort-merges.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "flowstat", extra: dict | None = None) -> SparkSession:
    running = SparkSession.getActiveSession()
    present = (running.sparkContext.getConf() if running else SparkConf())
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    given = extra or {}
    for k, v in given.items():
        builder = builder.config(k, v)
    for k, v in DEFAULT_CONF.items():
        if k not in given and not present.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, so that later
    stages restart from its files; the folder stays until the caller clears ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_PRIVATE: dict[str, str] = {}  # application id -> folder of a local run


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    The setting itself is returned, not the context's checkpoint folder: that
    one has a new random name for each driver, so a restarted stream would not
    find what it wrote.  Only a local run without the setting gets a private
    folder; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if sc.applicationId not in _PRIVATE:
        _PRIVATE[sc.applicationId] = tempfile.mkdtemp(prefix="flowstat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _PRIVATE[sc.applicationId]
