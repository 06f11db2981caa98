"""Session construction, shared storage and ad-hoc SQL."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; sizing (executors, memory, shuffle partitions) is left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str, conf: dict[str, str] | None = None, master: str | None = None) -> SparkSession:
    """One UTC session with adaptive execution; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a fresh local one in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(base)
    return shared_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once as parquet in the shared folder and read it back, which cuts its lineage.

    The result survives the loss of executors and is not recomputed by the several branches that read it.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run ad-hoc SQL; `tables` are registered as temporary views under their names first."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)
