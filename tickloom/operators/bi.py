"""Dashboard queries over quotes: filters, aggregates, ordering and paging.

`as_of` is a literal time, so the time filters reach the parquet scan.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import midnight, one_value, time_range


DATE = "quote_date"  # derived partition column of the quote table


def since(df: DataFrame, ts: str, as_of: dt.datetime, span: dt.timedelta, date_col: str | None = None) -> DataFrame:
    """Rows not older than `span` before `as_of`."""
    return time_range(df, ts, as_of - span, date_col=date_col)


def price_series(quotes: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    rows = since(quotes, "timestamp", as_of, dt.timedelta(days=days), DATE)
    return rows.select("timestamp", "symbol", "last_price").orderBy(F.desc("timestamp"))


def symbol_window_scan(quotes: DataFrame, symbol: str, as_of: dt.datetime, days: int = 1) -> DataFrame:
    rows = since(quotes, "timestamp", as_of, dt.timedelta(days=days), DATE)
    return rows.where(F.col("symbol") == symbol)


def dashboard_filters(
    df: DataFrame,
    ts: str = "timestamp",
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    **members: Sequence[str] | None,
) -> DataFrame:
    """Shared filters of a dashboard: dates (both included) and allowed values per column; None restricts nothing."""
    start = None if date_from is None else midnight(date_from)
    end = None if date_to is None else midnight(date_to, 1)
    df = time_range(df, ts, start, end, DATE)
    for column, allowed in members.items():
        if allowed is not None:
            df = df.where(F.col(column).isin(list(allowed)))
    return df


def symbol_counts(quotes: DataFrame) -> DataFrame:
    return (
        quotes.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("last_price").alias("avg_price"))
        .orderBy(F.desc("n"))
    )


def symbol_volume(quotes: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    rows = since(quotes, "timestamp", as_of, dt.timedelta(days=days), DATE)
    return rows.groupBy("symbol").agg(F.sum("volume").alias("total_volume")).orderBy(F.desc("total_volume"))


def _daily(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy(F.to_date("timestamp").alias("day"), "symbol").agg(
        F.avg("last_price").alias("avg_price"), F.sum("volume").alias("total_volume"), F.count(F.lit(1)).alias("n")
    )


def daily_symbol_stats(quotes: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    rows = since(quotes, "timestamp", as_of, dt.timedelta(days=days), DATE)
    return _daily(rows).select("day", "symbol", "avg_price", "total_volume").orderBy(F.desc("day"), "symbol")


def daily_pivot(quotes: DataFrame, as_of: dt.datetime, symbols: Sequence[str], days: int = 30) -> DataFrame:
    """Daily statistics with one column pair per symbol; the symbols are given, so no extra job lists them."""
    rows = since(quotes, "timestamp", as_of, dt.timedelta(days=days), DATE)
    return (
        rows.groupBy(F.to_date("timestamp").alias("day"))
        .pivot("symbol", list(symbols))
        .agg(F.avg("last_price").alias("avg_price"), F.sum("volume").alias("total_volume"))
    )


def symbol_24h(quotes: DataFrame, as_of: dt.datetime, top: int = 20) -> DataFrame:
    """Count, mean, extremes per symbol in the last day; the `top` busiest symbols, name as tie-break."""
    return (
        since(quotes, "timestamp", as_of, dt.timedelta(days=1), DATE)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("last_price").alias("avg_price"),
            F.max("last_price").alias("max_price"),
            F.min("last_price").alias("min_price"),
        )
        .orderBy(F.desc("n"), "symbol")
        .limit(top)
    )


def daily_stats(quotes: DataFrame, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Rows of the stored daily table, for all or only the given days."""
    if days is not None:
        quotes = time_range(quotes, "timestamp", midnight(min(days)), midnight(max(days), 1), DATE)
        quotes = quotes.where(F.to_date("timestamp").isin(list(days)))
    return _daily(quotes)


def refresh_daily_stats(quotes: DataFrame, path: str, days: Sequence[dt.date]) -> None:
    """Recompute the changed days and replace just their partitions of the stored table."""
    from ..sources.tables import overwrite_partitions

    overwrite_partitions(daily_stats(quotes, days), path, ["day"])


def avg_price_prev_day(quotes: DataFrame, as_of: dt.datetime) -> DataFrame:
    rows = time_range(quotes, "timestamp", midnight(as_of.date(), -1), midnight(as_of.date()), DATE)
    return rows.groupBy("symbol").agg(F.avg("last_price").alias("avg_price"))


def price_line(quotes: DataFrame, grain: str = "hour") -> DataFrame:
    return quotes.groupBy(F.date_trunc(grain, "timestamp").alias("bucket"), "symbol").agg(
        F.avg("last_price").alias("avg_price")
    )


def table_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values: values are reduced per task first."""
    return df.agg(F.countDistinct(column).alias("n_distinct"))


def volume_change_vs_prev_day(quotes: DataFrame) -> DataFrame:
    """Total volume per day and percent change against the day before it in the data.

    The window runs over one row per calendar day.
    """
    from pyspark.sql import Window

    daily = quotes.groupBy(F.to_date("timestamp").alias("day")).agg(F.sum("volume").alias("total_volume"))
    prev = F.lag("total_volume").over(Window.orderBy("day"))
    return daily.select(
        "day", "total_volume", (100.0 * (F.try_divide(F.col("total_volume").cast("double"), prev) - 1.0)).alias("pct_change")
    )


def latest_rows(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    """The first n rows of an order; each task keeps only n rows."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def page(df: DataFrame, order: Sequence[Column], page_no: int, size: int = 20) -> DataFrame:
    """Rows of one page (1-based) of an order that has no ties, with the number of pages."""
    pages = one_value(df, (F.floor((F.count(F.lit(1)) - 1) / size) + 1).cast("long"))
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size).withColumn("total_pages", pages)


def page_after(df: DataFrame, key: str, last_key, size: int = 20) -> DataFrame:
    """Next page after the last key seen; the cost does not grow with the depth of the page."""
    rows = df if last_key is None else df.where(F.col(key) > F.lit(last_key))
    return rows.orderBy(key).limit(size)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same ones on every run: smallest hash of key and seed."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    return df.withColumn("_draw", draw).orderBy("_draw").limit(n).drop("_draw")


def row_filter(df: DataFrame, grants: DataFrame, user: str, column: str = "symbol") -> DataFrame:
    """Rows whose `column` value is granted to the user (grants: user, value)."""
    allowed = grants.where(F.col("user") == user).select(F.col("value").alias(column))
    return df.join(allowed, column, "left_semi")


def mask_columns(df: DataFrame, policy: dict[str, str]) -> DataFrame:
    """Mask per column: `hash` (SHA-256), `keep_last4`, `digits` (digits become #) or `null`."""
    rules = {
        "hash": lambda c: F.sha2(c.cast("string"), 256),
        "keep_last4": lambda c: F.concat(F.lit("****"), F.right(c.cast("string"), F.lit(4))),
        "digits": lambda c: F.regexp_replace(c.cast("string"), r"\d", "#"),
        "null": lambda c: F.lit(None).cast("string"),
    }
    return df.withColumns({name: rules[rule](F.col(name)) for name, rule in policy.items()})
