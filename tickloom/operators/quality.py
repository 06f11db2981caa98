"""Data-quality rules and layer metrics."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import one_value
from ..plans.segments import MINUTE_US, Slices, epoch_us, over_rows
from ..schemas import ENTITY


def _unpivot(one_row: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per name out of a single row with columns `<field>__<name>`."""
    entries = [F.struct(F.lit(n).alias("column"), *[F.col(f"`{f}__{n}`").alias(f) for f in fields]) for n in names]
    return one_row.select(F.inline(F.array(*entries)))


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column; all columns in one aggregate."""
    cols = list(cols or df.columns)
    share = lambda c: F.try_divide(F.count(F.when(F.col(c).isNull(), 1)).cast("double"), F.count(F.lit(1)))
    one = df.agg(*[share(c).alias(f"null_rate__{c}") for c in cols])
    return _unpivot(one, cols, ["null_rate"])


def null_threshold_gate(df: DataFrame, limit: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns whose NULL share exceeds the limit; the load passes when there are none."""
    return null_rates(df, cols).where(F.col("null_rate") > limit)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(cols) if cols else None)


def drop_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows before and after dropping incomplete rows, and the share dropped in percent."""
    whole = None
    for c in cols or df.columns:
        whole = F.col(c).isNotNull() if whole is None else whole & F.col(c).isNotNull()
    counts = df.agg(F.count(F.lit(1)).alias("rows_before"), F.count(F.when(whole, 1)).alias("rows_after"))
    kept = F.try_divide(F.col("rows_after").cast("double"), "rows_before")
    return counts.withColumn("null_percentage", (1.0 - kept) * 100.0)


def price_outliers(silver: DataFrame, jump: float = 0.5) -> DataFrame:
    """Ticks with a zero or negative price, or a jump beyond the share `jump` against the tick before."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        prev = F.lag("price").over(w)
        moved = F.try_divide(F.abs(F.col("price") - prev), F.abs(prev))
        return rows.withColumns(
            {
                "zero_price": F.coalesce(F.col("price") == 0, F.lit(False)),
                "negative_price": F.coalesce(F.col("price") < 0, F.lit(False)),
                "price_jump": F.coalesce(moved > jump, F.lit(False)),
            }
        )

    ticks = silver.select(*ENTITY, "ts", "tcnt", "price")
    flagged = over_rows(ticks, ENTITY, ["ts", "tcnt"], compute, segment=Slices(epoch_us("ts"), slot=MINUTE_US), before=1)
    return flagged.where("zero_price or negative_price or price_jump")


def duplicate_ticks(ticks: DataFrame, ts: str = "tdate") -> DataFrame:
    """Keys (entity, time, sequence) that occur more than once, with the number of copies."""
    return ticks.groupBy(*ENTITY, ts, "tcnt").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def dedupe_ticks(ticks: DataFrame, ts: str = "tdate") -> DataFrame:
    """One row per (entity, time, sequence): the one ingested last.

    An aggregate and not a ranking window: many copies of one tick are reduced in each task before the shuffle.
    """
    keys = [*ENTITY, ts, "tcnt"]
    rest = [c for c in ticks.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct("ingest_ts", *[c for c in rest if c != "ingest_ts"]))
    return ticks.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*").select(*ticks.columns)


def time_reversals(silver: DataFrame) -> DataFrame:
    """Ticks whose time is lower than that of the tick with the previous sequence number."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("prev_ts", F.lag("ts").over(w))

    ticks = silver.select(*ENTITY, "ts", "tcnt")
    out = over_rows(ticks, ENTITY, ["tcnt", "ts"], compute, segment=Slices(F.col("tcnt"), slot=1024), before=1)
    return out.where("ts < prev_ts")


def _reasons(df: DataFrame, rules: dict[str, tuple[str, bool]]) -> Column:
    checks = []
    for name, (kind, required) in rules.items():
        c = F.col(name)
        checks.append(F.when(c.isNotNull() & c.try_cast(kind).isNull(), F.lit(f"{name}: not {kind}")))
        if required:
            checks.append(F.when(c.isNull(), F.lit(f"{name}: missing")))
    return F.array_compact(F.array(*checks))


def enforce_schema(df: DataFrame, rules: dict[str, tuple[str, bool]]) -> DataFrame:
    """Rows that satisfy every rule (column -> type, required), cast to the types."""
    good = df.where(F.size(_reasons(df, rules)) == 0)
    return good.select(*[F.col(c).try_cast(rules[c][0]).alias(c) if c in rules else F.col(c) for c in df.columns])


def quarantine(df: DataFrame, rules: dict[str, tuple[str, bool]]) -> DataFrame:
    """Rows that break a rule, unchanged, with the reasons."""
    bad = df.withColumn("_r", _reasons(df, rules)).where(F.size("_r") > 0)
    return bad.withColumn("reason", F.array_join("_r", "; ")).drop("_r")


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per column, with the number of columns; one aggregate."""
    fns = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[fn(F.col(c).cast("double")).alias(f"{f}__{c}") for c in cols for f, fn in fns.items()])
    return _unpivot(one, cols, list(fns)).withColumn("feature_count", F.lit(len(cols)))


def layer_metrics(bronze: DataFrame, clean: DataFrame, gold: DataFrame, symbol: str = "code") -> DataFrame:
    """Key/value figures of one pipeline run; each layer is reduced to one row first."""
    rows = F.count(F.lit(1)).cast("double")
    one = bronze.agg(rows.alias("i"), F.countDistinct(symbol).cast("double").alias("u")).withColumns(
        {"c": one_value(clean, rows), "g": one_value(gold, rows)}
    )
    filtered = F.col("i") - F.col("c")
    pairs = [
        ("bronze", "rows_ingested", F.col("i")),
        ("bronze", "unique_symbols", F.col("u")),
        ("silver", "rows_cleaned", F.col("c")),
        ("silver", "rows_filtered", filtered),
        ("silver", "quality_score", F.try_divide(F.col("c"), F.col("c") + filtered)),
        ("gold", "rows_aggregated", F.col("g")),
    ]
    rows = [F.struct(F.lit(a).alias("layer"), F.lit(k).alias("key"), v.alias("value")) for a, k, v in pairs]
    return one.select(F.inline(F.array(*rows)))
