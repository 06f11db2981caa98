"""Idempotent ingestion against a manifest of loaded files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import below

MANIFEST = "src_file STRING, checksum STRING, max_tcnt BIGINT, row_count BIGINT"


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """MD5 per file, named by its path below `path`, so that files of one name in several folders stay apart."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(below(spark, path).alias("src_file"), F.md5("content").alias("checksum"))


def file_summary(rows: DataFrame, checksums: DataFrame | None = None) -> DataFrame:
    """Manifest rows of the files in `rows` (columns src_file, tcnt)."""
    per_file = rows.groupBy("src_file").agg(F.max("tcnt").alias("max_tcnt"), F.count(F.lit(1)).alias("row_count"))
    if checksums is None:
        per_file = per_file.withColumn("checksum", F.lit(None).cast("string"))
    else:
        per_file = per_file.join(checksums, "src_file", "left")
    return per_file.select("src_file", "checksum", "max_tcnt", "row_count")


def new_files_only(summary: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files not yet loaded: no manifest row with the same checksum, and none that reached the same sequence number."""
    m = manifest.alias("m")
    loaded = (F.col("f.src_file") == F.col("m.src_file")) & (
        (F.col("f.checksum") == F.col("m.checksum")) | (F.col("m.max_tcnt") >= F.col("f.max_tcnt"))
    )
    return summary.alias("f").join(m, loaded, "left_anti")


def idempotent_ingest(
    rows: DataFrame, manifest: DataFrame, checksums: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of new files, and the manifest rows to append after they are written.

    The semi join meets a list with one row per file: broadcast when Spark's size check allows, else a sort-merge
    join whose hot files adaptive execution splits.
    """
    fresh = new_files_only(file_summary(rows, checksums), manifest)
    return rows.join(fresh.select("src_file"), "src_file", "left_semi"), fresh
