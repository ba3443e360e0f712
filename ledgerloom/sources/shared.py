"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of local sessions, by application.
_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset and all runs on this machine (tests), a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(spark.sparkContext.applicationId)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = _OWN[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    return root.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """df written once and read back: what reads it twice sees the same rows, and a lost executor costs nothing."""
    path = f"{shared_root(df.sparkSession)}/ledgerloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished stages; useful after stored()."""
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for work on each row that costs more than moving it.

    A table of a few large row groups is read by as many tasks, whatever the cluster; one with more is left as it is, and so is what
    a shuffle has dealt, whose partitions are not known before it runs.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
