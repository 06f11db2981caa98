"""Joins beyond the plain equi-join, and the union of option sides."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.segments import MINUTE_US, Slices, epoch_us, running


def union_sides(call: DataFrame, put: DataFrame) -> DataFrame:
    """Rows of both sides by column name, duplicates kept."""
    return call.unionByName(put)


def pit_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    ts: str,
    tolerance_s: int | None = None,
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """For each left row the latest right row of its key at or before its time, NULL when there is none.

    Both sides are stacked and the right rows are carried forward, so no range join and no pairs of rows arise; a hot
    key is cut where its rows pass a number, other keys stay whole. Of several right rows at one time the greatest is taken.
    """
    values = [c for c in right.columns if c not in (*on, ts)]
    seen = right.groupBy(*on, ts).agg(F.max(F.struct(*values)).alias("_r"))
    lkeep = [c for c in left.columns if c not in (*on, ts)]
    stacked = (
        left.select(*on, ts, F.struct(*lkeep).alias("_l"), F.lit(1).alias("_side"))
        .unionByName(
            seen.select(*on, ts, F.struct(F.col(ts).alias(f"right_{ts}"), "_r.*").alias("_r"), F.lit(0).alias("_side")),
            allowMissingColumns=True,
        )
    )
    carried = running(stacked, on, [ts, "_side"], Slices(epoch_us(ts), rows_per_slice, MINUTE_US), {"_hit": ("last", F.col("_r"))})
    out = carried.where("_side = 1")
    if tolerance_s is not None:
        age = F.unix_micros(ts) - F.unix_micros(F.col(f"_hit.right_{ts}"))
        out = out.withColumn("_hit", F.when(age <= tolerance_s * 1_000_000, F.col("_hit")))
    return out.select(*on, ts, "_l.*", F.col(f"_hit.right_{ts}").alias(f"right_{ts}"), *[f"_hit.{v}" for v in values])


def nearest_strike(surface: DataFrame, quotes: DataFrame) -> DataFrame:
    """Surface value at the strike nearest to each quoted strike of the same (ymcode, ts); lower strike on ties.

    Instead of joining all pairs, the surface strikes are carried up and down to the distinct quoted strikes of their
    group; the quotes then look their strike up.
    """
    keys = ["ymcode", "ts"]
    wanted = quotes.select(*keys, "strike").distinct()
    stacked = wanted.select(*keys, "strike", F.lit(None).cast("struct<strike:int,iv:double>").alias("_s")).unionByName(
        surface.select(*keys, "strike", F.struct("strike", "iv").alias("_s"))
    )
    # surface rows come first at their strike, so `last` is the strike at or below and `next` the one above
    near = running(
        stacked,
        keys,
        ["strike", F.col("_s").isNull()],
        F.floor(F.col("strike") / 1000).cast("long"),
        {"_lo": ("last", F.col("_s")), "_hi": ("next", F.col("_s"))},
    ).where("_s is null")
    up, down = F.col("_hi.strike") - F.col("strike"), F.col("strike") - F.col("_lo.strike")
    best = F.when(F.col("_lo").isNull() | (up < down), F.col("_hi")).otherwise(F.col("_lo"))
    found = (
        near.withColumn("_b", best)
        .where("_b is not null")
        .select(*keys, "strike", F.col("_b.strike").alias("near_strike"), F.col("_b.iv").alias("near_iv"))
    )
    return quotes.join(found, [*keys, "strike"])


def parity_diff(batch: DataFrame, stream: DataFrame, keys: Sequence[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows missing on either side or whose value differs by more than the tolerance; NULL keys match each other."""
    k = F.struct(*keys).alias("_k")
    b = batch.select(k, F.col(value).alias("batch_value"), F.lit(True).alias("_b"))
    s = stream.select(k, F.col(value).alias("stream_value"), F.lit(True).alias("_s"))
    both = b.join(s, "_k", "full_outer")
    reason = (
        F.when(F.col("_s").isNull(), "missing_in_stream")
        .when(F.col("_b").isNull(), "missing_in_batch")
        .when(
            (F.abs(F.col("batch_value") - F.col("stream_value")) > tolerance)
            | (F.col("batch_value").isNull() != F.col("stream_value").isNull()),
            "differs",
        )
    )
    return (
        both.withColumn("reason", reason)
        .where("reason is not null")
        .select(*[F.col(f"_k.{c}").alias(c) for c in keys], "batch_value", "stream_value", "reason")
    )


def assign_folds(df: DataFrame, folds: DataFrame, date_col: str) -> DataFrame:
    """Rows with the fold and part (train / validation) whose date interval holds them.

    The folds are expanded to one row per day, which turns the range join into an equi-join on the date.
    """
    parts = folds.select(
        "fold",
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("part"), F.col("train_start").alias("_from"), F.col("train_end").alias("_to")),
                F.struct(F.lit("valid").alias("part"), F.col("val_start").alias("_from"), F.col("val_end").alias("_to")),
            )
        ),
    )
    # an empty interval holds no day; a sequence over it would run backwards
    days = parts.where("_from < _to").select("fold", "part", F.explode(F.sequence("_from", F.date_sub("_to", 1))).alias(date_col))
    return df.join(F.broadcast(days), date_col)  # folds times days, whatever the number of rows


def federated_join(lake: DataFrame, external: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Lake rows with columns of a table from another source (JDBC, files); prune the external side first."""
    return lake.join(external, list(on), how)
