"""Semi-structured logs: filters, search, aggregates and search documents."""
from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import time_range

META = "struct<user:string,order_id:string>"


def meta(field: str) -> Column:
    return F.get_json_object("meta", f"$.{field}")


def log_json_extract(logs: DataFrame) -> DataFrame:
    """ERROR rows with user and order taken from the JSON text, newest first."""
    return (
        logs.where("level = 'ERROR'")
        .select("event_time", "message", meta("user").alias("user"), meta("order_id").alias("order_id"))
        .orderBy(F.desc("event_time"))
    )


def recent_errors(logs: DataFrame, as_of: dt.datetime, hours: float = 1) -> DataFrame:
    rows = time_range(logs, "event_time", as_of - dt.timedelta(hours=hours), date_col="log_date")
    return rows.where("level = 'ERROR'").orderBy(F.desc("event_time"))


def logs_by_user(logs: DataFrame, user: str) -> DataFrame:
    return logs.where(meta("user") == user)


def logs_by_order(logs: DataFrame, order_id: str) -> DataFrame:
    return logs.where(meta("order_id") == order_id)


def drop_debug(logs: DataFrame) -> DataFrame:
    """Rows whose message does not start with DBG; rows without a message stay."""
    return logs.where(~F.coalesce(F.col("message").startswith("DBG"), F.lit(False)))


def parse_meta(logs: DataFrame) -> DataFrame:
    """`meta` as a typed object; text that is not JSON gives NULL."""
    return logs.withColumn("meta_obj", F.from_json("meta", META, {"mode": "PERMISSIVE"})).withColumn(
        "meta_obj", F.when(F.try_parse_json("meta").isNotNull(), F.col("meta_obj"))
    )


LETTER = r"[\p{L}\p{N}]"


def search_messages(df: DataFrame, terms: Sequence[str], mode: str = "all", column: str = "message") -> DataFrame:
    """Rows that hold any or all of the words, in any case, anywhere in the whole text; letters of any script bound a word."""
    text = F.lower(column)
    # the plain substring test is cheap and spares most rows the regular expression
    hits = [
        text.contains(t.lower()) & text.rlike(rf"(?<!{LETTER}){re.escape(t.lower())}(?!{LETTER})") for t in terms
    ]
    cond = hits[0]
    for h in hits[1:]:
        cond = (cond & h) if mode == "all" else (cond | h)
    return df.where(cond)


# Rows looked up by number; more are found by a join.
FEW = 1000
# A term this many times as frequent as the rarest one is left to the final test.
COMMON = 20
POSTINGS = "word STRING, _row BIGINT, bucket INT"
FREQUENCY = "word STRING, n BIGINT, bucket INT"


def _tokens(text: Column) -> Column:
    """Distinct words of a text in lower case."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), rf"(?:(?!{LETTER}).)+|\n+"), ""))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def build_search_index(docs: DataFrame, column: str, path: str, buckets: int = 64) -> None:
    """Write the rows, and which words stand in which of them, below `path` for `search_index`.

    Three tables: `rows` with a number each, parted by its hash; `postings` (word, row), parted by the word's hash and sorted by
    word; `frequency`, the number of rows per word. A bucket with a very frequent word becomes several files.
    """
    spark = docs.sparkSession
    if {"_row", "_part"} & set(docs.columns):
        raise ValueError("columns _row and _part are the index's own")
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_part", _bucket(F.col("_row"), buckets))
    # numbers are given once: what follows reads the written rows
    numbered.hint("rebalance", "_part").sortWithinPartitions("_part", "_row").write.partitionBy("_part").parquet(f"{path}/rows")
    rows = spark.read.schema(numbered.schema).parquet(f"{path}/rows")
    words = rows.select(F.explode(_tokens(F.col(f"`{column}`"))).alias("word"), "_row").withColumn("bucket", _bucket(F.col("word"), buckets))
    words.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "_row").write.partitionBy("bucket").parquet(f"{path}/postings")
    counts = spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("bucket", "word").agg(F.count(F.lit(1)).alias("n"))
    counts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(f"{path}/frequency")
    spark.createDataFrame([(column, buckets, numbered.schema.json())], "column STRING, buckets INT, rows STRING").coalesce(1).write.parquet(f"{path}/about")


def search_index(spark: SparkSession, path: str, terms: Sequence[str], mode: str = "all") -> DataFrame:
    """The rows that `search_messages` finds among those indexed, for any terms.

    The words of a term bound the rows it can stand in. Of words that all have to be there the rarest come first and their
    rows are intersected; much more frequent ones need no look-up, since the found rows are tested against their text in the
    end. Only buckets of looked-up words are read, and of the rows, where few are found, only the parts that hold them. A term
    without any word has every row tested.
    """
    about = spark.read.parquet(f"{path}/about").first()
    rows = spark.read.schema(T.StructType.fromJson(json.loads(about.rows))).parquet(f"{path}/rows")
    each = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "i INT, term STRING")
    each = each.select("i", F.explode(_tokens(F.col("term"))).alias("word"))
    asked = each.withColumn("bucket", _bucket(F.col("word"), about.buckets)).collect()  # the words of the query
    found = lambda df: search_messages(df, terms, mode, about.column).drop("_row", "_part")
    needed = [{(r.bucket, r.word) for r in asked if r.i == i} for i in range(len(terms))]
    needed = [set().union(*needed)] if mode == "all" else needed
    if not all(needed):
        return found(rows)
    count = spark.read.schema(FREQUENCY).parquet(f"{path}/frequency")
    count = count.where(F.col("bucket").isin(sorted({b for n in needed for b, _ in n})) & F.col("word").isin(sorted({w for n in needed for _, w in n})))
    known = {(r.bucket, r.word): r.n for r in count.collect()}
    places = [_intersected(spark, path, words, known) for words in needed if words <= set(known)]
    if not places:
        return found(rows.where(F.lit(False)))
    numbers = reduce(DataFrame.unionByName, places).distinct()
    few = [r._row for r in numbers.limit(FEW + 1).collect()]
    if len(few) > FEW:
        return found(rows.join(numbers, "_row", "left_semi"))
    parts = spark.createDataFrame([(n,) for n in few], "n BIGINT").select(_bucket(F.col("n"), about.buckets).alias("part")).distinct().collect()
    return found(rows.where(F.col("_part").isin([r.part for r in parts]) & F.col("_row").isin(few)))


def _intersected(spark: SparkSession, path: str, words: set[tuple[int, str]], known: dict[tuple[int, str], int]) -> DataFrame:
    """Numbers of the rows that hold the rarer ones of the words."""
    order = sorted(words, key=lambda w: (known[w], w))
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    held = [postings.where((F.col("bucket") == b) & (F.col("word") == w)).select("_row") for b, w in order if known[b, w] <= COMMON * known[order[0]]]
    return reduce(lambda x, y: x.join(y, "_row", "left_semi"), held)


def log_level_counts(logs: DataFrame, levels: Sequence[str] = ("INFO", "WARN", "ERROR")) -> DataFrame:
    return logs.where(F.col("level").isin(list(levels))).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


def user_activity(logs: DataFrame) -> DataFrame:
    user = meta("user")
    return logs.where(user.isNotNull()).groupBy(user.alias("user")).agg(F.count(F.lit(1)).alias("n"))


def error_trend(logs: DataFrame, grain_s: int = 3600) -> DataFrame:
    """ERROR rows per time bucket from the first to the last log row, empty buckets included.

    Rows are counted per bucket first, so the bucket list and the join are as long as the time range, not the data.
    """
    bucket = F.floor(F.unix_seconds("event_time") / grain_s)
    counts = logs.groupBy(bucket.alias("_b")).agg(F.count(F.when(F.col("level") == "ERROR", 1)).alias("errors"))
    span = counts.agg(F.min("_b").alias("lo"), F.max("_b").alias("hi"))
    grid = span.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("_b"))
    return grid.join(counts, "_b", "left").select(
        F.timestamp_seconds(F.col("_b") * grain_s).alias("bucket"), F.coalesce("errors", F.lit(0)).alias("errors")
    )


def error_rate(logs: DataFrame, grain_s: int = 3600, limit: float = 0.05) -> DataFrame:
    """Share of ERROR rows per bucket and whether it exceeds the limit."""
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds("event_time") / grain_s) * grain_s)
    counts = logs.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("level") == "ERROR", 1)).alias("errors")
    )
    rate = F.try_divide(F.col("errors").cast("double"), "total")
    return counts.withColumn("rate", rate).withColumn("alert", F.col("rate") > limit)


def error_bursts(logs: DataFrame, limit: int = 50, window: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    """Sliding windows with more than `limit` ERROR rows; works on batch and streaming input alike.

    ERROR rows of a batch are counted per slide, and the counts, not the rows, are expanded to the windows that hold the
    slide. A stream keeps one state, so its rows are expanded and reduced again by the partial aggregate of the same task.
    """
    errors = logs.where("level = 'ERROR'")
    if errors.isStreaming:
        counted = errors.groupBy(F.window("event_time", window, slide).alias("w")).agg(F.count(F.lit(1)).alias("errors"))
    else:
        slides = errors.groupBy(F.window("event_time", slide)["start"].alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
        counted = slides.groupBy(F.window("_at", window, slide).alias("w")).agg(F.sum("_n").alias("errors"))
    return (
        counted
        .where(F.col("errors") > limit)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "errors")
    )


def daily_index(logs: DataFrame) -> DataFrame:
    """Name of the daily search index each row belongs to."""
    return logs.withColumn("index_name", F.concat(F.lit("logs-"), F.date_format("event_time", "yyyy.MM.dd")))


def iso_text(ts: str) -> Column:
    """ISO time without zone; microseconds only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def _last_write_wins(docs: DataFrame, order: Column) -> DataFrame:
    """One document per id, the one latest in `order`; copies are dropped already before the shuffle."""
    row = F.struct(*[c for c in docs.columns if c != "doc_id"])
    return docs.groupBy("doc_id").agg(F.max_by(row, order).alias("d")).select("doc_id", "d.*")


def log_documents(logs: DataFrame, version: Column | None = None) -> DataFrame:
    """Search documents of log rows; `meta` is an object when it is valid JSON and a JSON string otherwise.

    `version` orders writes to the same id; by default the greatest (message, meta) wins, which is deterministic.
    """
    stamp = iso_text("event_time")
    parsed = F.to_json(F.try_parse_json("meta"))
    docs = logs.select(
        F.concat(F.lit("log-"), stamp, F.lit("-"), "level").alias("doc_id"),
        stamp.alias("event_time"),
        "level",
        "message",
        F.coalesce(parsed, F.to_json(F.col("meta").cast("variant"))).alias("meta"),
        (version if version is not None else F.struct("message", "meta")).alias("_v"),
    )
    return _last_write_wins(docs, F.col("_v")).drop("_v")


def media_documents(images: DataFrame, version: Column | None = None) -> DataFrame:
    """Search documents of media rows."""
    docs = images.select(
        F.concat(F.lit("img-"), "image_id").alias("doc_id"),
        "image_id",
        "s3_path",
        "file_size",
        "mime_type",
        iso_text("upload_time").alias("upload_time"),
        "source_system",
        "tag",
        (version if version is not None else F.struct("upload_time", "s3_path")).alias("_v"),
    )
    return _last_write_wins(docs, F.col("_v")).drop("_v")


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON line per document, `meta` written as JSON rather than as text."""
    if "meta" in docs.columns:
        docs = docs.withColumn("meta", F.try_parse_json("meta"))
    docs.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
