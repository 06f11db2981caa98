"""Streaming ingestion, late data and alerts."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.logs import error_bursts
from .run import Versions, run_batches


def without_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key in every Arrow batch of a task; stateless."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.table({**{f"k{i}": batch.column(k) for i, k in enumerate(keys)}, "at": pa.array(np.arange(batch.num_rows))})
            places = table.group_by([f"k{i}" for i in range(len(keys))]).aggregate([("at", "min")]).column("at_min")
            yield batch.take(np.sort(places.to_numpy()))

    return rows.mapInArrow(first, rows.schema)


def stream_ingest(raw: DataFrame, keys: list[str], ts: str, watermark: str = "1 hour") -> DataFrame:
    """Rows of a raw stream, each key once: copies that arrive within the watermark are dropped.

    The file source and its checkpoint give every file exactly once; state holds the keys inside the watermark, each once. The
    copies of one key are first dropped within each task's batches, without state, so that a key with very many copies
    does not meet in one task.
    """
    return without_copies(raw, keys).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def stream_error_bursts(
    logs: DataFrame, limit: int = 50, window: str = "10 minutes", slide: str = "1 minute", watermark: str = "10 minutes"
) -> DataFrame:
    return error_bursts(logs.withWatermark("event_time", watermark), limit, window, slide)


def late_data(rows: DataFrame, ts: str, delay_s: int, max_lag_s: int, out: str, state: str, checkpoint: str) -> None:
    """Per micro-batch: rows, rows older than the allowed delay, newest time, and a flag for conservative mode.

    Late rows are counted on the input against the newest time of earlier batches, because the engine's own counter
    sees rows only after partial aggregation.
    """
    stats_of = Versions(rows.sparkSession, out)
    seen = Versions(rows.sparkSession, state, 2)

    def step(batch: DataFrame, batch_id: int) -> None:
        before = seen.read_before(batch_id, "max_ts TIMESTAMP")
        prior = F.lit(before.first()[0] if before is not None else None).cast("timestamp")  # one row
        late = F.coalesce(F.col(ts) < prior - F.expr(f"interval {delay_s} seconds"), F.lit(False))
        lag = F.unix_seconds(prior) - F.unix_seconds(F.min(ts))
        stats = stats_of.write(
            batch.agg(
                F.lit(batch_id).cast("long").alias("batch_id"),
                F.count(F.lit(1)).alias("row_count"),
                F.count(F.when(late, 1)).alias("late_rows"),
                F.max(ts).alias("max_ts"),
                F.coalesce(lag > max_lag_s, F.lit(False)).alias("conservative"),
            ),
            batch_id,
        )
        seen.write(stats.select(F.greatest("max_ts", prior).alias("max_ts")), batch_id)

    run_batches(rows, step, checkpoint)
