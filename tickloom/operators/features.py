"""Rolling features, labels and indicators over bars.

Row-based functions count bars, time-based functions count elapsed time; both are exact when bars are missing.
`bar_s`, the length of a bar in seconds, only sizes the time slices that share the work; results do not depend on it.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.segments import DAY, over_rows, over_time, time_segment
from ..schemas import ENTITY, FEATURE_COLS

US = 1_000_000


def bar_segment(bar_s: int, reach: int) -> Column:
    """Time slices that hold many times the rows a frame reaches: at least 1,440 bar lengths and 50 times the reach."""
    return time_segment("bar_ts", bar_s * max(1440, 50 * reach))


def _by_row(
    bars: DataFrame, compute: Callable, bar_s: int, before: int = 0, after: int = 0, by_day: bool = False
) -> DataFrame:
    keys = [*ENTITY, "trade_date"] if by_day else ENTITY
    segment = bar_segment(bar_s, before + after)
    return over_rows(bars, keys, ["bar_ts"], compute, segment=segment, before=before, after=after)


def change(col: str, n: int, w: WindowSpec) -> Column:
    """Relative change against the value n rows back (n < 0: n rows ahead); NULL at the ends or for a zero base."""
    here, other = F.col(col), F.lag(col, n).over(w)
    return (F.try_divide(here, other) if n > 0 else F.try_divide(other, here)) - 1.0


def features(bars: DataFrame, by_day: bool = False, bar_s: int = 60) -> DataFrame:
    """The seven model features. Frames cross day boundaries unless `by_day`; early frames emit partial values."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        base = rows.withColumns(
            {
                "f_ret_1": change("c", 1, w),
                "f_ret_5": change("c", 5, w),
                "f_oi_chg_5": F.col("oi_last") - F.lag("oi_last", 5).over(w),
                "range_1": F.try_divide(F.col("h") - F.col("l"), F.col("c")),
            }
        )
        return base.withColumns(
            {
                "f_vol_20": F.stddev_samp("f_ret_1").over(w.rowsBetween(-19, 0)),
                "f_range_5": F.avg("range_1").over(w.rowsBetween(-4, 0)),
            }
        )

    # 19 rows of returns need one more row for the oldest return
    return _by_row(bars, compute, bar_s, before=20, by_day=by_day).select(
        *ENTITY,
        F.col("bar_ts").alias("asof_ts"),
        "f_ret_1",
        "f_ret_5",
        "f_vol_20",
        "f_range_5",
        "f_oi_chg_5",
        F.col("f_range_5").alias("f_spread_proxy"),
        F.col("f_vol_20").alias("f_iv_proxy"),
        "trade_date",
    )


def feature(bars: DataFrame, name: str, bar_s: int = 60) -> DataFrame:
    """One feature column; Catalyst prunes the window expressions of the others."""
    return features(bars, bar_s=bar_s).select(*ENTITY, "asof_ts", name)


def range_1(bars: DataFrame) -> DataFrame:
    """(high - low) / close of each bar, NULL for a zero close."""
    value = F.try_divide(F.col("h") - F.col("l"), F.col("c"))
    return bars.select(*ENTITY, F.col("bar_ts").alias("asof_ts"), value.alias("range_1"))


def features_time(bars: DataFrame, unit_s: int = 60) -> DataFrame:
    """The features over elapsed time: values exactly 1 or 5 units earlier, deviation over the trailing 20 units."""
    unit = unit_s * US

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        def back(col: str, n: int) -> Column:
            # at most one bar starts at that instant
            return F.max(col).over(w.rangeBetween(-n * unit, -n * unit))

        base = rows.withColumns(
            {
                "ft_ret_1": F.try_divide("c", back("c", 1)) - 1.0,
                "ft_ret_5": F.try_divide("c", back("c", 5)) - 1.0,
                "ft_oi_chg_5": F.col("oi_last") - back("oi_last", 5),
                "range_1": F.try_divide(F.col("h") - F.col("l"), F.col("c")),
            }
        )
        return base.withColumns(
            {
                "ft_vol_20": F.stddev_samp("ft_ret_1").over(w.rangeBetween(-19 * unit, 0)),
                "ft_range_5": F.avg("range_1").over(w.rangeBetween(-4 * unit, 0)),
            }
        )

    out = over_time(bars, ENTITY, "bar_ts", compute, before_s=20 * unit_s, width_s=max(DAY, 400 * unit_s))
    cols = ["ft_ret_1", "ft_ret_5", "ft_vol_20", "ft_range_5", "ft_oi_chg_5"]
    return out.select(*ENTITY, F.col("bar_ts").alias("asof_ts"), *cols, "trade_date")


def labels(bars: DataFrame, bar_s: int = 60) -> DataFrame:
    """Forward returns over 5 and 15 bars; computed from the bars directly, so NULL keys keep their labels."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({f"y_fwd_ret_{n}": change("c", -n, w) for n in (5, 15)})

    return _by_row(bars, compute, bar_s, after=15).select(
        *ENTITY, F.col("bar_ts").alias("asof_ts"), "y_fwd_ret_5", "y_fwd_ret_15", "trade_date"
    )


def labels_time(bars: DataFrame, unit_s: int = 60) -> DataFrame:
    """Return to the bar exactly 5 and 15 units later, NULL when that bar does not exist."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        def ahead(n: int) -> Column:
            return F.max("c").over(w.rangeBetween(n * unit_s * US, n * unit_s * US))

        return rows.withColumns({f"yt_fwd_ret_{n}": F.try_divide(ahead(n), "c") - 1.0 for n in (5, 15)})

    out = over_time(bars, ENTITY, "bar_ts", compute, after_s=15 * unit_s, width_s=max(DAY, 300 * unit_s))
    return out.select(*ENTITY, F.col("bar_ts").alias("asof_ts"), "yt_fwd_ret_5", "yt_fwd_ret_15", "trade_date")


def max_favourable_return(bars: DataFrame, horizon_s: int = 1200) -> DataFrame:
    """Highest high strictly after the bar and within the horizon, relative to the close."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        best = F.max("h").over(w.rangeBetween(1, horizon_s * US))
        return rows.withColumn("max_fav_ret", F.try_divide(best, "c") - 1.0)

    out = over_time(bars, ENTITY, "bar_ts", compute, after_s=horizon_s, width_s=max(DAY, 20 * horizon_s))
    return out.select(*ENTITY, F.col("bar_ts").alias("asof_ts"), "max_fav_ret")


def _indicator(
    bars: DataFrame, compute: Callable, names: Sequence[str], bar_s: int, before: int, after: int = 0
) -> DataFrame:
    return _by_row(bars, compute, bar_s, before=before, after=after).select(*ENTITY, "bar_ts", *names)


def _full(value: Column, n: int, w: WindowSpec) -> Column:
    """`value` once the frame holds n rows, NULL before."""
    return F.when(F.count(F.lit(1)).over(w.rowsBetween(-(n - 1), 0)) == n, value)


def moving_average(bars: DataFrame, n: int, bar_s: int = 60) -> DataFrame:
    """Mean close of the last n bars, NULL until n bars exist."""

    def compute(rows, w):
        return rows.withColumn(f"ma_{n}", _full(F.avg("c").over(w.rowsBetween(-(n - 1), 0)), n, w))

    return _indicator(bars, compute, [f"ma_{n}"], bar_s, n - 1)


def bollinger(bars: DataFrame, n: int = 20, k: float = 2.0, bar_s: int = 60) -> DataFrame:
    """Moving average and the band k sample deviations around it."""

    def compute(rows, w):
        frame = w.rowsBetween(-(n - 1), 0)
        dev = F.stddev_samp("c").over(frame)
        mid = F.avg("c").over(frame)
        return rows.withColumns(
            {"bb_mid": _full(mid, n, w), "bb_upper": _full(mid + k * dev, n, w), "bb_lower": _full(mid - k * dev, n, w)}
        )

    return _indicator(bars, compute, ["bb_mid", "bb_upper", "bb_lower"], bar_s, n - 1)


def rsi(bars: DataFrame, n: int = 14, bar_s: int = 60) -> DataFrame:
    """100 - 100 / (1 + mean gain / mean loss) over n changes; 100 without losses, NULL until n changes exist."""

    def compute(rows, w):
        frame = w.rowsBetween(-(n - 1), 0)
        rows = rows.withColumn("_d", F.col("c") - F.lag("c").over(w))
        gain = F.avg(F.greatest("_d", F.lit(0.0))).over(frame)
        loss = F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(frame)
        value = F.when(loss == 0, F.lit(100.0)).otherwise(100.0 - 100.0 / (1.0 + F.try_divide(gain, loss)))
        rows = rows.withColumn("_n", F.count("_d").over(frame))
        return rows.withColumn("rsi", F.when(F.col("_n") == n, value))

    # greatest() skips NULL, so the first bar of an entity must not count as a zero change: _n guards it
    return _indicator(bars, compute, ["rsi"], bar_s, n)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, bar_s: int = 60) -> DataFrame:
    """Difference of two exponential means, its own exponential mean (signal) and their distance.

    Means reach back until the weight left out is below the precision of a double, so results do not depend on how the
    rows are cut. Every slice of time of an entity is one group, whose means are the plain recursion.
    """
    reach = lambda span: 1 if span <= 1 else math.ceil(37.0 / -math.log(1.0 - 2.0 / (span + 1.0)))
    back = max(reach(fast), reach(slow)) + reach(signal)

    def means(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar_ts", kind="stable")
        ewm = lambda x, span: x.ewm(span=max(1, span), adjust=True).mean()
        pdf["macd"] = ewm(pdf["c"], fast) - ewm(pdf["c"], slow)
        pdf["macd_signal"] = ewm(pdf["macd"], signal)
        return pdf

    def compute(rows, w):
        rows = rows.select("_seg", "_key", "_home", "bar_ts", "c")
        schema = T.StructType([*rows.schema.fields, T.StructField("macd", T.DoubleType()), T.StructField("macd_signal", T.DoubleType())])
        return rows.groupBy("_seg", "_key").applyInPandas(means, schema)

    slim = bars.select(*ENTITY, "bar_ts", F.col("c").cast("double").alias("c"))
    out = over_rows(slim, ENTITY, ["bar_ts"], compute, segment=time_segment("bar_ts", max(1440, 8 * back) * bar_s), before=back)
    return out.select(
        *ENTITY, "bar_ts", "macd", "macd_signal", (F.col("macd") - F.col("macd_signal")).alias("macd_hist")
    )


def momentum(bars: DataFrame, n: int = 10, bar_s: int = 60) -> DataFrame:
    """Relative and absolute change against the close n bars back."""

    def compute(rows, w):
        return rows.withColumns(
            {f"mom_rel_{n}": change("c", n, w), f"mom_abs_{n}": F.col("c") - F.lag("c", n).over(w)}
        )

    return _indicator(bars, compute, [f"mom_rel_{n}", f"mom_abs_{n}"], bar_s, n)


def smooth(bars: DataFrame, n: int = 5, bar_s: int = 60) -> DataFrame:
    """Rolling median of the last n closes (fewer at the start)."""

    def compute(rows, w):
        return rows.withColumn("c_smooth", F.percentile("c", F.lit(0.5)).over(w.rowsBetween(-(n - 1), 0)))

    return _indicator(bars, compute, ["c_smooth"], bar_s, n - 1)


def lag_features(bars: DataFrame, cols: Sequence[str], lags: Sequence[int], bar_s: int = 60) -> DataFrame:
    """One column `<col>_lag_<n>` per column and lag."""

    def compute(rows, w):
        return rows.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c in cols for n in lags})

    return _indicator(bars, compute, [f"{c}_lag_{n}" for c in cols for n in lags], bar_s, max(lags))


def seasonal_decompose(bars: DataFrame, period: int = 24, step_s: int = 3600) -> DataFrame:
    """Additive parts of the close: centred moving average, mean detrended value per phase, residual.

    The phase is the time step number modulo the period; the trend is NULL until the centred frame is full. With an even
    period both ends of the frame weigh one half, so that every phase weighs the same.
    """
    half = period // 2

    def compute(rows, w):
        frame = w.rowsBetween(-half, half)
        whole = F.count(F.lit(1)).over(frame) == 2 * half + 1
        if period % 2:
            mean = F.avg("c").over(frame)
        else:
            mean = (F.sum("c").over(frame) - (F.lag("c", half).over(w) + F.lead("c", half).over(w)) / 2) / period
        return rows.withColumn("trend", F.when(whole, mean))

    parts = _indicator(bars, compute, ["c", "trend"], step_s, half, half).withColumn(
        "phase", F.pmod(F.floor(F.unix_seconds("bar_ts") / step_s), F.lit(period)).cast("int")
    )
    # at most `period` rows per entity; the join is left to adaptive execution
    key = F.struct(*ENTITY)
    seasonal = (
        parts.withColumn("_key", key).groupBy("_key", "phase").agg(F.avg(F.col("c") - F.col("trend")).alias("seasonal"))
    )
    return (
        parts.withColumn("_key", key)
        .join(seasonal, ["_key", "phase"], "left")
        .select(
            *ENTITY,
            "bar_ts",
            "phase",
            "trend",
            "seasonal",
            (F.col("c") - F.col("trend") - F.col("seasonal")).alias("residual"),
        )
    )


def latest_per_key(features_df: DataFrame) -> DataFrame:
    """Newest feature row per entity; partial aggregation keeps one row per entity and task."""
    row = F.struct("asof_ts", *FEATURE_COLS)
    return (
        features_df.groupBy(*ENTITY)
        .agg(F.max_by(row, "asof_ts").alias("r"))
        .select(*ENTITY, "r.*")
    )


def features_with_close(features_df: DataFrame, bars: DataFrame) -> DataFrame:
    """Features with the close of the same bar; an equi-join, so NULL strikes find no close."""
    close = bars.select(*ENTITY, F.col("bar_ts").alias("asof_ts"), F.col("c").alias("close"))
    return features_df.join(close, [*ENTITY, "asof_ts"], "left")


def training_set(features_df: DataFrame, labels_df: DataFrame) -> DataFrame:
    """Features joined with known 5-bar labels, rows with any missing feature dropped."""
    y = labels_df.select(*ENTITY, "asof_ts", "trade_date", "y_fwd_ret_5").where("y_fwd_ret_5 is not null")
    return features_df.dropna(subset=FEATURE_COLS).join(y, [*ENTITY, "asof_ts", "trade_date"])
