"""Media catalogue queries."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_image, midnight, one_value, time_range

# Sort modes of the gallery.
SORTS = {
    "newest": ("upload_time", False),
    "oldest": ("upload_time", True),
    "largest": ("file_size", False),
    "smallest": ("file_size", True),
}


def filter_media_tag(images: DataFrame, tag: str = "all") -> DataFrame:
    return images if tag == "all" else images.where(F.col("tag") == tag)


def filter_media(
    images: DataFrame,
    tag: str | None = None,
    dates: tuple[dt.date, dt.date] | None = None,
    kb_range: tuple[float, float] | None = None,
) -> DataFrame:
    """Tag, upload dates (both included) and size in KB (both included); absent filters restrict nothing."""
    if tag is not None:
        images = images.where(F.col("tag") == tag)
    if dates is not None:
        images = time_range(images, "upload_time", midnight(dates[0]), midnight(dates[1], 1), "upload_date")
    if kb_range is not None:
        images = images.where(F.col("file_size").between(int(kb_range[0] * 1024), int(kb_range[1] * 1024)))
    return images


def search_media(images: DataFrame, field: str, text: str, regex: bool = True) -> DataFrame:
    """Case-insensitive match in one of the three search fields, as a regular expression or literally."""
    if field not in ("image_id", "tag", "source_system"):
        raise ValueError(f"unknown search field {field}")
    hit = F.col(field).rlike("(?i)" + text) if regex else F.lower(field).contains(text.lower())
    return images.where(hit)


def media_summary(images: DataFrame) -> DataFrame:
    """Count, total MB, mean KB and number of tags; zeros for an empty set."""
    return images.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("file_size") / (1024.0 * 1024.0), F.lit(0.0)).alias("total_mb"),
        F.coalesce(F.avg("file_size") / 1024.0, F.lit(0.0)).alias("avg_kb"),
        F.countDistinct("tag").alias("n_tags"),
    )


def tag_counts(images: DataFrame) -> DataFrame:
    return (
        images.where("tag is not null").groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag")
    )


def upload_timeline(images: DataFrame) -> DataFrame:
    return images.groupBy(F.to_date("upload_time").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def size_histogram(images: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width size buckets with counts, empty buckets included; the greatest size falls into the last bucket."""
    lo, hi = one_value(images, F.min("file_size")), one_value(images, F.max("file_size"))
    pos = F.try_divide((F.col("file_size") - lo) * F.lit(float(bins)), hi - lo)
    bucket = F.least(F.floor(F.coalesce(pos, F.lit(0.0))), F.lit(bins - 1)).cast("int")
    counts = (
        images.where("file_size is not null").select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    span = images.agg(F.min("file_size").alias("lo"), F.max("file_size").alias("hi"))  # one row
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    grid = span.where("lo is not null").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bucket"), "lo", width.alias("_w")
    )
    return grid.join(counts, "bucket", "left").select(
        "bucket",
        (F.col("lo") + F.col("bucket") * F.col("_w")).alias("size_from"),
        (F.col("lo") + (F.col("bucket") + 1) * F.col("_w")).alias("size_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def image_count(images: DataFrame) -> DataFrame:
    return images.where(is_image()).agg(F.count(F.lit(1)).alias("n"))


def duplicate_objects(images: DataFrame) -> DataFrame:
    """Checksums shared by several objects, with their number and first id; copies are counted before the shuffle."""
    return (
        images.where("checksum is not null")
        .groupBy("checksum")
        .agg(F.count(F.lit(1)).alias("n"), F.min("image_id").alias("first_id"))
        .where("n > 1")
    )


def sort_media(images: DataFrame, mode: str = "newest") -> DataFrame:
    column, ascending = SORTS[mode]
    return images.orderBy(F.col(column).asc() if ascending else F.col(column).desc(), "image_id")


def distinct_tags(images: DataFrame) -> DataFrame:
    return images.select("tag").distinct()
