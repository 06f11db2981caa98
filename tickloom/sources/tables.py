"""Table definitions and writes: append by name, partition overwrite, retention, backfill."""
from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import midnight, time_range
from ..schemas import PARTITION_DATES, TABLES


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def create_tables(
    spark: SparkSession, database: str, names: Sequence[str] | None = None, location: str | None = None
) -> None:
    """Create the database and its partitioned parquet tables where they are missing."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name in names or TABLES:
        columns, partitions = TABLES[name]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet PARTITIONED BY ({partitions})")


def with_partition_date(df: DataFrame, table: str) -> DataFrame:
    """Add the table's derived date column when the rows lack it."""
    column, ts = PARTITION_DATES.get(table.split(".")[-1], (None, None))
    return df if column is None or column in df.columns else df.withColumn(column, F.to_date(ts))


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition columns before a write, so that not every task writes to every partition.

    The rebalance hint lets adaptive execution split a partition that holds far more rows than the others.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, table: str) -> None:
    """Append by column name, whatever the order; columns missing in `df` become NULL."""
    df = with_partition_date(df, table)
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition and c.name in df.columns]
    cols = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(f"INSERT INTO {table} BY NAME SELECT {cols} FROM {{rows}}", rows=gathered(df, partitions))


def append_or_create(df: DataFrame, table: str, wait_s: float = 2.0) -> None:
    """Append; a missing table is created from the rows, any other analysis error is tried once more."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.mode("errorifexists").saveAsTable(table)
        return
    try:
        append(df, table)
    except AnalysisException:
        time.sleep(wait_s)
        append(df, table)


def recreate_table(spark: SparkSession, table: str, columns: str, partitions: str | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    by = f" PARTITIONED BY ({partitions})" if partitions else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{by}")


def overwrite_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace just the partitions of a stored table (a path) that occur in `df`."""
    (
        gathered(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(target)
    )


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").select("namespace", "tableName")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def apply_retention(df: DataFrame, date_col: str, as_of: dt.date, days: int = 30) -> DataFrame:
    """Rows of the partitions that are kept: dates not older than `days` before `as_of`."""
    return df.where(F.col(date_col) >= F.lit(as_of - dt.timedelta(days=days)))


def drop_old_partitions(spark: SparkSession, table: str, date_col: str, as_of: dt.date, days: int = 30) -> None:
    """Drop the expired partitions of a catalog table; works on the partition list, not on the rows."""
    cut = (as_of - dt.timedelta(days=days)).isoformat()
    day = F.regexp_extract("partition", rf"(?:^|/){date_col}=([^/]+)", 1)
    expired = spark.sql(f"SHOW PARTITIONS {table}").select(day.alias("day")).where(F.col("day") < cut).distinct()
    specs = ", ".join(f"PARTITION ({date_col}='{r.day}')" for r in expired.collect())  # one entry per expired day
    if specs:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def backfill(
    source: DataFrame,
    ts: str,
    date_from: dt.date,
    date_to: dt.date,
    recompute: Callable[[DataFrame], DataFrame],
    target: str,
    partition_by: Sequence[str],
) -> None:
    """Recompute the days from `date_from` to `date_to` (both included) and replace only their partitions."""
    rows = time_range(source, ts, midnight(date_from), midnight(date_to, 1), "trade_date")
    overwrite_partitions(recompute(rows), target, partition_by)


def explain_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The plan text of a query."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
