"""Streaming bars, features, recent window and scoring; the expressions are those of the batch operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import decide, feature_key
from ..operators.bars import bar_aggregates, tick_order
from ..operators.features import features
from ..schemas import ENTITY
from .run import Versions, folders, run_batches

LOOKBACK = 20  # bars before a new one that its features read


def stream_bars(silver: DataFrame, interval: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """Bars over a stream of silver ticks, emitted once the watermark has passed their end.

    State holds the open bars only, one row per entity and interval.
    """
    return (
        silver.withWatermark("ts", watermark)
        .groupBy(*ENTITY, F.window("ts", interval).alias("w"), "trade_date")
        .agg(*bar_aggregates(order=tick_order()))
        .select(*ENTITY, F.col("w.start").alias("bar_ts"), "o", "h", "l", "c", "v", "tick_count", "oi_last", "trade_date")
    )


def stream_features(bars: DataFrame, out: str, state: str, checkpoint: str, bar_s: int = 60) -> None:
    """Features of each finished bar, written to `out/batch=<id>`.

    A micro-batch joins its bars with the last 20 stored bars of each entity, which is all the rolling features read;
    the next 20 are stored for the batch after it. Input bars must arrive in time order per entity, as they do from
    `stream_bars`.
    """
    arrived, tails = Versions(bars.sparkSession, f"{state}/bars", 2), Versions(bars.sparkSession, f"{state}/tails", 2)
    results = Versions(bars.sparkSession, out)
    schema = bars.schema

    def step(batch: DataFrame, batch_id: int) -> None:
        new = arrived.write(batch, batch_id)
        before = tails.read_before(batch_id, schema)
        rows = new if before is None else new.unionByName(before)
        fresh = new.select(F.struct(*ENTITY, F.col("bar_ts").alias("asof_ts")).alias("_k"))
        keyed = features(rows, bar_s=bar_s).withColumn("_k", F.struct(*ENTITY, "asof_ts"))
        results.write(keyed.join(fresh, "_k", "left_semi").drop("_k"), batch_id)
        newest = Window.partitionBy(*ENTITY).orderBy(F.desc("bar_ts"))
        tail = rows.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= LOOKBACK)
        tails.write(tail.drop("_rn"), batch_id)

    run_batches(bars, step, checkpoint)


MINUTE = 60_000_000
# Columns and folders of the log of recent rows.
_LOG = "tl_minute BIGINT, tl_batch BIGINT"


def recent_window(rows: DataFrame, ts: str, minutes: float, state: str, checkpoint: str) -> None:
    """Keep the rows of the last minutes of stream time below `state`, for `latest_state`.

    A micro-batch appends its own rows to the log, in folders by minute of stream time, and deletes the folders of minutes that
    have left the window; rows of earlier batches are not touched. A repeated batch overwrites what it wrote. Rows without a
    time are not kept.
    """
    newest = Versions(rows.sparkSession, f"{state}/newest", 2)
    log, reach = f"{state}/log", int(minutes * MINUTE)
    number = F.floor(F.unix_micros(ts) / MINUTE)

    def step(batch: DataFrame, batch_id: int) -> None:
        before = newest.read_before(batch_id, _NEWEST)
        last = before.first().newest if before is not None else None  # one row
        now = newest.write(batch.agg(F.greatest(F.max(ts), F.lit(last).cast("timestamp")).alias("newest"), F.lit(reach).cast("long").alias("reach"), F.lit(ts).alias("ts")), batch_id).first().newest
        if now is None:
            return
        edge = F.unix_micros(F.lit(now)) - reach
        recent = batch.where(F.unix_micros(ts) > edge).withColumns({"tl_minute": number, "tl_batch": F.lit(batch_id).cast("long")})
        writer = recent.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("tl_minute", "tl_batch").parquet(log)
        oldest = batch.sparkSession.range(1).select(F.floor(edge / MINUTE)).first()[0]
        for name, delete in folders(batch.sparkSession, log):
            if name.startswith("tl_minute=") and int(name.partition("=")[2]) < oldest:
                delete()

    run_batches(rows, step, checkpoint)


_NEWEST = "newest TIMESTAMP, reach BIGINT, ts STRING"


def latest_state(spark: SparkSession, state: str, schema) -> DataFrame:
    """The rows of the window; minutes outside of it are not read."""
    known = spark.read.schema(f"{_NEWEST}, batch BIGINT").option("basePath", f"{state}/newest").parquet(f"{state}/newest")
    last = known.where("newest is not null").orderBy(F.desc("batch")).first()
    if last is None:
        return spark.createDataFrame([], schema)
    edge = F.unix_micros(F.lit(last.newest)) - last.reach
    log = spark.read.schema(StructType([*schema.fields, *StructType.fromDDL(_LOG).fields])).parquet(f"{state}/log")
    return log.where((F.col("tl_minute") >= F.floor(edge / MINUTE)) & (F.unix_micros(last.ts) > edge)).drop("tl_minute", "tl_batch")


def stream_score(features_stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Decision log of a feature stream: key, prediction and decision per row; stateless."""
    return scorer(features_stream).select(
        feature_key("asof_ts").alias("feature_key"), "asof_ts", "pred", decide("pred").alias("decision")
    )
