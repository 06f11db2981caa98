"""Exact quantiles and cumulative counts over values without collecting a column into one task."""
from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .segments import running

_LARGEST = 800  # above the size of every double's logarithm
_END = 2**61


def value_segment(value: Column, per_e_fold: int = 1000) -> Column:
    """Slice number that grows with the value: slices are equally wide in the logarithm, on both sides of zero.

    Java's logarithm never decreases when its argument grows, so the slices follow the order of the values. Infinities
    have slices of their own at the ends, and NaN one above all, as Spark orders them.
    """
    value = value.cast("double")
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    size = F.floor(F.ln(F.when(finite, F.abs(value))) * per_e_fold) + _LARGEST * per_e_fold
    ends = F.when(F.isnan(value), F.lit(_END + 1)).when(value == float("inf"), F.lit(_END)).when(value == float("-inf"), F.lit(-_END))
    return F.coalesce(ends, F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))).cast("long")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles per key as columns `q0`, `q1`, ...

    Equal values are counted first, the counts are summed along the value slices, and only the few values around each
    wanted rank leave the executors' rows. NaN counts as the largest value; NULL does not count.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    specs = {"_upto": ("sum", F.col("_n")), "_all": ("total", F.col("_n"))}
    ranked = running(counts, keys, [value], value_segment(F.col(value)), specs)
    ranked = ranked.withColumn("_k", F.struct(*keys) if keys else F.struct(F.lit(0).alias("all")))
    aggs = []
    for i, p in enumerate(probs):
        rank = (F.col("_all") - 1) * F.lit(p)
        for name, r in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            holds = (F.col("_upto") > r) & (F.col("_upto") - F.col("_n") <= r)
            aggs.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}{i}"))
        aggs.append(F.max(rank - F.floor(rank)).alias(f"_f{i}"))
    found = ranked.groupBy("_k").agg(*aggs)
    between = lambda lo, hi, f: F.when((lo == hi) | (f == 0), lo).otherwise(lo + (hi - lo) * f)  # noqa: E731  infinities have no difference
    cols = [between(F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")).alias(f"q{i}") for i in range(len(probs))]
    return found.select(*[F.col(f"_k.{c}").alias(c) for c in keys], *cols)


# Slices an e-fold, of a first histogram and of finer ones; powers of two, so that finer slices lie within coarser ones.
_WIDTHS = (2**8, 2**20, 2**32, 2**44)


@dataclass
class _Scope:
    """The slices that hold the wanted ranks of a column, with the rows before each."""

    width: int
    rows: int
    before: dict[int, int]


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], limit: int = 1 << 20
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of several columns by rank selection; None for a column without values.

    A histogram over value slices, added up in every task before its shuffle, tells which slices hold the wanted ranks. Only
    the values in those are then counted one by one; while they are more than `limit` rows, narrower slices within them come
    first. Each column is read alone and no row is copied per column; what is shuffled are counts, and the driver gets the
    slices and values at the wanted ranks. NaN counts as the largest value; NULL does not count.
    """
    scopes: dict[str, _Scope | None] = dict.fromkeys(columns)
    todo = list(columns)
    for width in _WIDTHS:
        found = _holding(df, {c: scopes[c] for c in todo}, lambda v, width=width: value_segment(v, width), probs)
        scopes.update({c: _Scope(width, rows[0].total, {r.item: r.upto - r.n for r in rows}) for c, rows in found.items()})
        todo = [c for c, rows in found.items() if sum(r.n for r in rows) > limit]
        if not todo:
            break
    values = _holding(df, {c: s for c, s in scopes.items() if s}, lambda v: v, probs)
    return {c: [_between(values[c], p) if c in values else None for p in probs] for c in columns}


def _holding(
    df: DataFrame, scopes: dict[str, _Scope | None], item: Callable[[Column], Column], probs: Sequence[float]
) -> dict[str, list[Row]]:
    """Per column the items (slices, or values) at wanted ranks: item, n rows, upto (rows up to its end), total."""
    if not scopes:
        return {}
    parts, before, rows_of = [], {}, {}
    for c, scope in scopes.items():
        value = F.col(f"`{c}`").cast("double")
        rows = df.where(value.isNotNull())
        inside = F.lit(0).cast("long")
        if scope:
            inside = value_segment(value, scope.width)
            rows = rows.where(inside.isin(list(scope.before)))
            before.update({f"{c} {place}": n for place, n in scope.before.items()})
            rows_of[c] = scope.rows
        counted = rows.groupBy(inside.alias("inside"), item(value).alias("item")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counted.select(F.lit(c).alias("column"), "inside", "item", "n"))
    counts = reduce(DataFrame.unionByName, parts)

    def known(values: dict[str, int], key: Column) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key].cast("long")

    line = Window.partitionBy("column", "inside").orderBy("item")
    own = F.sum("n").over(line)
    summed = counts.withColumns(
        {
            "upto": own + known(before, F.concat_ws(" ", "column", "inside")) if before else own,
            "total": known(rows_of, F.col("column")) if rows_of else F.sum("n").over(Window.partitionBy("column", "inside")),
        }
    )
    ranks = [end((F.col("total") - 1) * F.lit(p)) for p in probs for end in (F.floor, F.ceil)]
    wanted = F.exists(F.array(*ranks), lambda r: (F.col("upto") > r) & (F.col("upto") - F.col("n") <= r))
    found: dict[str, list[Row]] = {}
    for row in summed.where(wanted).select("column", "item", "n", "upto", "total").collect():  # a few per column and prob
        found.setdefault(row.column, []).append(row)
    return found


def _between(rows: list[Row], prob: float) -> float:
    rank = (rows[0].total - 1) * prob
    low, high = (next(r.item for r in rows if r.upto - r.n <= end < r.upto) for end in (math.floor(rank), math.ceil(rank)))
    share = rank - math.floor(rank)
    return low if low == high or not share else low + (high - low) * share
