"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job should start with; all are public Spark options.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Used where spark.checkpoint.dir is unset. Without a scheme, so it lies in the cluster's
# default file system; in a local session that is the local disk.
DEFAULT_SHARED_DIR = "/tmp/checkpoints"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Where that is unset, a cluster whose default file system is each machine's own disk is refused:
    readers would miss what other machines wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base, context = DEFAULT_SHARED_DIR, spark.sparkContext
        default = context._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if not context.master.startswith("local") and default.startswith("file:"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table written to a new shared folder and read back: worked out once, lineage cut."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
