"""Column expressions and small projections; all run inside whole-stage code generation."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extensions that count as images.
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "gif", "webp"]


def instant(when: dt.datetime | dt.date) -> Column:
    """Literal instant of a zone-free time, read in the session time zone and not in that of the driver machine."""
    return F.lit(when.isoformat()).cast("timestamp")


def time_range(
    df: DataFrame,
    ts: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    date_col: str | None = None,
) -> DataFrame:
    """Rows from `start` up to but not at `end`.

    Both limits are literals on the time itself, so file statistics prune; where the table has a derived date
    partition column, the same range on it prunes partitions.
    """
    if start is not None:
        df = df.where(F.col(ts) >= instant(start))
    if end is not None:
        df = df.where(F.col(ts) < instant(end))
    if date_col and date_col in df.columns:
        if start is not None:
            df = df.where(F.col(date_col) >= F.lit(start.date()))
        if end is not None:
            df = df.where(F.col(date_col) <= F.lit(end.date()))
    return df


def midnight(day: dt.date, add: int = 0) -> dt.datetime:
    return dt.datetime.combine(day, dt.time()) + dt.timedelta(days=add)


def one_value(df: DataFrame, value: Column) -> Column:
    """An aggregate over all of `df` as a scalar subquery, for use in another query without any join."""
    return df.agg(value.alias("value")).scalar()


def decide(pred: str | Column, limit: float = 0.001) -> Column:
    """BUY above the limit, SELL below its negative, HOLD between (limits included)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    return F.when(p > limit, "BUY").when(p < -limit, "SELL").otherwise("HOLD")


def feature_key(ts: str) -> Column:
    """Cache key of a feature row: options:ymcode:side:code:strike:time."""
    stamp = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat_ws(":", F.lit("options"), "ymcode", "side", "code", F.col("strike").cast("string"), stamp)


def time_features(ts: str) -> list[Column]:
    """Calendar parts of a time; the first part of the day starts after hour 0, which therefore has no name."""
    hour, dow = F.hour(ts), F.weekday(ts)
    part = (
        F.when(hour == 0, None)
        .when(hour <= 6, "night")
        .when(hour <= 12, "morning")
        .when(hour <= 18, "afternoon")
        .otherwise("evening")
    )
    return [
        hour.alias("hour"),
        dow.alias("day_of_week"),
        F.month(ts).alias("month"),
        F.quarter(ts).alias("quarter"),
        (dow >= 5).alias("is_weekend"),
        part.alias("time_of_day"),
    ]


def season(ts: str) -> Column:
    m = F.month(ts)
    return (
        F.when(m.between(3, 5), "spring").when(m.between(6, 8), "summer").when(m.between(9, 11), "autumn")
        .when(m.isNotNull(), "winter")
    )


def kst_to_utc(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Text without an offset is Korean time; store the instant."""
    return df.withColumn(out_col, F.to_utc_timestamp(F.try_to_timestamp(F.col(text_col)), "Asia/Seoul"))


def daily_slice(df: DataFrame, ts: str, ds: str, date_col: str | None = "trade_date") -> DataFrame:
    """Rows of one date."""
    day = dt.date.fromisoformat(ds)
    return time_range(df, ts, midnight(day), midnight(day, 1), date_col)


def is_image(mime: str = "mime_type", path: str = "s3_path") -> Column:
    """MIME type starts with image/, or the path ends with an image extension; never NULL."""
    ext = F.lower(path).rlike(r"\.(" + "|".join(IMAGE_EXTENSIONS) + r")$")
    return F.coalesce(F.col(mime).startswith("image/"), F.lit(False)) | F.coalesce(ext, F.lit(False))


def parse_object_path(df: DataFrame, path: str = "s3_path") -> DataFrame:
    """Bucket and key of s3a:// or s3:// paths; other paths get `path_error`."""
    pattern = r"^s3a?://([^/]+)/(.+)$"
    good = F.coalesce(F.col(path).rlike(pattern), F.lit(False))
    return df.withColumns(
        {
            "bucket": F.when(good, F.regexp_extract(path, pattern, 1)),
            "object_key": F.when(good, F.regexp_extract(path, pattern, 2)),
            "path_error": F.when(~good, F.concat(F.lit("invalid object path: "), F.coalesce(path, F.lit("NULL")))),
        }
    )


def human_sizes(df: DataFrame) -> DataFrame:
    """Display forms of size, dimensions and checksum."""
    size = F.col("file_size")
    return df.select(
        "image_id",
        F.round(size / 1024, 2).alias("size_kb"),
        F.round(size / (1024 * 1024), 2).alias("size_mb"),
        F.concat("width", F.lit("x"), "height").alias("dimensions"),
        F.concat(F.substring("checksum", 1, 8), F.lit("...")).alias("checksum_short"),
    )


def object_caption(path: str = "s3_path") -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)
