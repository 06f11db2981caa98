"""Running streaming queries over all available input, with state and output in shared storage."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> None:
    """Process what is available and append to `path`; the checkpoint makes each row appear once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def run_batches(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process what is available, one call per micro-batch."""
    query = (
        stream.writeStream.foreachBatch(fn)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def collect_stream(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its end and read back what it wrote."""
    spark: SparkSession = stream.sparkSession
    out = scratch_path(spark, name)
    run_to_parquet(stream, out, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def folders(spark: SparkSession, path: str) -> list[tuple[str, Callable[[], None]]]:
    """Names of the folders directly below `path`, each with a function that deletes it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    found = [f.getPath() for f in store.listStatus(root) if f.isDirectory()]
    return [(p.getName(), lambda p=p: store.delete(p, True)) for p in found]


class Versions:
    """Stored rows of a `foreachBatch` job: one folder per micro-batch, so a repeated batch overwrites its own.

    With `keep`, state whose older versions nobody reads, only so many of the newest folders stay. Two are enough to repeat
    a batch, which reads the one before it.
    """

    def __init__(self, spark: SparkSession, base: str, keep: int | None = None):
        self.spark, self.base, self.keep = spark, base, keep

    def read_before(self, batch_id: int, schema) -> DataFrame | None:
        return None if batch_id == 0 else self.spark.read.schema(schema).parquet(f"{self.base}/batch={batch_id - 1}")

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Store the rows and read them back, so that later steps do not run the batch again."""
        path = f"{self.base}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        if self.keep is not None and batch_id >= self.keep:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/batch={batch_id - self.keep}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.spark.read.schema(df.schema).parquet(path)
