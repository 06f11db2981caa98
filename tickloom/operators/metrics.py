"""Metric samples: counter rates, utilisation, sustained alerts."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..plans.segments import over_time, running, time_segment

US = 1_000_000


def series_key(samples: DataFrame) -> DataFrame:
    """Adds `series`, the labels in a form that can be grouped (maps cannot)."""
    return samples.withColumn("series", F.array_sort(F.map_entries("labels")))


def counter_rate(samples: DataFrame, window_s: int = 300) -> DataFrame:
    """Increase per second over the trailing window of each series, ends included.

    A value below its predecessor is a counter reset and counts in full. Only steps between two samples inside the
    window count, without extrapolation to the window edges; NULL with fewer than two samples.

    A frame of time costs Spark a pass over its rows for every row. Time is cut into blocks as long as the window
    instead, so a window holds the end of one block and the start of the next: two running figures, each from one pass.
    """
    width = window_s * US

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        prev = F.lag("value").over(w)
        step = F.when(F.col("value") >= prev, F.col("value") - prev).when(prev.isNotNull(), F.col("value"))
        block = F.coalesce(F.col("_us") - F.pmod("_us", F.lit(width)), F.lit(0))
        rows = rows.withColumns({"_step": step, "_rn": F.row_number().over(w), "_block": block})
        start = Window.partitionBy("_seg", "_key", "_block")
        upto = start.orderBy("_us")  # rows of one time are peers
        rows = rows.withColumn("_first", F.first("_step").over(start.orderBy("_us", "_rn")))
        rows = rows.withColumns({"_sum": F.sum("_step").over(upto), "_n": F.count(F.lit(1)).over(upto)})

        # each row once more, at the time where its window begins, to ask for what the block there holds from then on
        asks = F.when(F.col("_home"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        rows = rows.withColumn("_asks", F.explode(asks))
        back = F.when(F.col("_asks"), F.lit(width)).otherwise(F.lit(0))
        rows = rows.withColumns({"_block": F.col("_block") - back, "_at": F.col("_us") - back})
        onward = start.orderBy(F.col("_at").desc(), "_asks", F.col("_rn").desc()).rowsBetween(Window.unboundedPreceding, 0)
        sample = F.when(~F.col("_asks"), F.struct("_step"))
        rows = rows.withColumns(
            {
                "_end_sum": F.sum(sample["_step"]).over(onward),
                "_end_n": F.count(sample).over(onward),
                "_end_first": F.last(sample, ignorenulls=True).over(onward),
            }
        ).where("_asks")
        known = F.col("_end_sum").isNotNull() | F.col("_sum").isNotNull()
        total = F.when(known, F.coalesce("_end_sum", F.lit(0)) + F.coalesce("_sum", F.lit(0)))
        first = F.when(F.col("_end_n") > 0, F.col("_end_first._step")).otherwise(F.col("_first"))
        inside = total - F.coalesce(first, F.lit(0.0))
        return rows.withColumn("rate", F.when(F.col("_end_n") + F.col("_n") >= 2, inside / float(window_s)))

    keyed = series_key(samples)
    out = over_time(
        keyed, ["metric", "instance", "series"], "ts", compute, before_s=window_s, width_s=max(3600, 12 * window_s)
    )
    return out.select("metric", "instance", "labels", "ts", "rate")


def cpu_utilisation(idle_counter: DataFrame, window_s: int = 300) -> DataFrame:
    """100 - 100 * mean idle rate per instance and time."""
    return (
        counter_rate(idle_counter, window_s)
        .groupBy("instance", "ts")
        .agg((100.0 - 100.0 * F.avg("rate")).alias("utilisation"))
    )


def _side_by_side(samples: DataFrame, total: str, avail: str) -> DataFrame:
    def pick(m: str):
        return F.max(F.when(F.col("metric") == m, F.col("value")))

    return (
        samples.where(F.col("metric").isin(total, avail))
        .groupBy("instance", "ts")
        .agg(pick(total).alias("_total"), pick(avail).alias("_avail"))
        .where("_total is not null and _avail is not null")
    )


def disk_used_pct(samples: DataFrame, total: str = "size", avail: str = "avail") -> DataFrame:
    """100 - available / size * 100 of samples taken at one time."""
    value = 100.0 - F.try_divide("_avail", "_total") * 100.0
    return _side_by_side(samples, total, avail).select("instance", "ts", value.alias("used_pct"))


def mem_used_pct(samples: DataFrame, total: str = "size", avail: str = "avail") -> DataFrame:
    """(total - available) / total * 100 of samples taken at one time."""
    value = F.try_divide(F.col("_total") - F.col("_avail"), F.col("_total")) * 100.0
    return _side_by_side(samples, total, avail).select("instance", "ts", value.alias("used_pct"))


def islands(df: DataFrame, keys: list[str], ts: str, bad: str, slice_s: int = 3600) -> DataFrame:
    """Adds `_since`, the last time at or before the row where `bad` held; rows of one run share it."""
    return running(
        df, keys, [ts], time_segment(ts, slice_s), {"_since": ("last", F.when(F.expr(bad), F.col(ts)))}
    )


def sustained_alert(series: DataFrame, value: str, threshold: float, for_s: int) -> DataFrame:
    """Runs in which every sample exceeds the threshold for at least `for_s` seconds.

    A run is named by the sample that ended the one before, so no row numbers over a whole series are needed.
    """
    above = f"{value} > {threshold}"
    runs = (
        islands(series, ["instance"], "ts", f"not coalesce({above}, false)")
        .where(above)
        .groupBy("instance", "_since")
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.count(F.lit(1)).alias("samples"),
            F.max(value).alias("peak"),
        )
        .drop("_since")
    )
    held = F.unix_micros("end_ts") - F.unix_micros("start_ts")
    return runs.where(held >= for_s * US).withColumn(
        "fires_at", F.timestamp_micros(F.unix_micros("start_ts") + for_s * US)
    )


def latest_sample(samples: DataFrame) -> DataFrame:
    """Newest sample of every series."""
    return (
        series_key(samples)
        .groupBy("metric", "instance", "series")
        .agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
        .drop("series")
    )
