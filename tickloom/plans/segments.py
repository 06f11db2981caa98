"""Window evaluation that splits one hot key over many tasks.

A plain `Window.partitionBy(key)` sorts all rows of a key in one task, so a key that holds a third of the data
decides the run time. The helpers here cut every key into segments and give each segment exactly the neighbour rows
(or the carried state) that its frames need. Results equal the plain window.

* `over_rows`  - frames counted in rows (lag, lead, rolling rows)
* `over_time`  - frames counted in time (range frames)
* `running`    - frames that reach back to the first or forward to the last row (running sum, fill forward, ...)
* `scanned`    - values that follow from the state at the end of earlier segments, as running peaks and streaks do
* `positions`  - row number within the key

`segment` is either a column that never decreases along the order (a day number, a price bucket, ...) or `Slices`, which
cuts only keys with very many rows. Each helper shuffles the rows once, by key and segment. What passes between segments
is reduced before its own shuffle: one aggregate row per key and segment, or the few rows at a segment's edge. The input
is read again for it, and when `Slices` counts its rows (once per key, and by slot for large keys), so pass a stored table or a plain scan.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import materialise

DAY = 86_400
_NULL_SEGMENT = -(2**62)


@dataclass(frozen=True)
class Slices:
    """Segments for keys of very unequal size: a key with more than `rows` rows is cut where the count of its rows along
    `position`, a whole number that never decreases along the order, passes a multiple of `rows`; other keys stay whole and
    exchange nothing. Rows are counted per `slot` units of the position, and a slot is never divided."""

    position: Column
    rows: int = 1_000_000
    slot: int = 1


MINUTE_US = 60_000_000


def epoch_us(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def time_segment(ts: str | Column, seconds: int = DAY) -> Column:
    """Number of the time slice that holds `ts`."""
    return F.floor(epoch_us(ts) / F.lit(seconds * 1_000_000)).cast("long")


def _keyed(df: DataFrame, keys: Sequence[str], segment: Column | Slices) -> DataFrame:
    """Rows with their keys packed into `_key`, their `_seg`, and `_cut`: whether the key has several segments.

    A struct compares NULL fields as equal, so NULL keys stay one group in joins as in windows. Groupings name `_seg`
    first: it is a number, so sorts settle most comparisons on their eight-byte prefix.
    """
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rest = [c for c in df.columns if c not in keys]
    if not isinstance(segment, Slices):
        seg = F.coalesce(segment, F.lit(_NULL_SEGMENT)).alias("_seg")
        return df.select(key.alias("_key"), seg, F.lit(True).alias("_cut"), *rest)
    slot = F.coalesce(F.floor(segment.position.cast("long") / segment.slot), F.lit(_NULL_SEGMENT))
    rows = df.select(key.alias("_key"), slot.alias("_slot"), *rest)
    large = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_all")).where(F.col("_all") > segment.rows)
    large = materialise(large.select("_key"), "large-keys")
    if large.isEmpty():
        return rows.select("_key", F.lit(_NULL_SEGMENT).alias("_seg"), F.lit(False).alias("_cut"), *rest)
    counts = rows.join(large, "_key", "left_semi").groupBy("_slot", "_key").agg(F.count(F.lit(1)).alias("_n"))
    line = Window.partitionBy("_key").orderBy("_slot")
    number = F.floor((F.sum("_n").over(line) - F.col("_n")) / segment.rows)
    # a row per slot of the large keys, stored so that every branch of a plan reads the same cuts
    cuts = materialise(counts.select("_key", "_slot", number.alias("_seg")), "slices")
    return rows.join(cuts, ["_key", "_slot"], "left").select(
        "_key", F.coalesce("_seg", F.lit(_NULL_SEGMENT)).alias("_seg"), F.col("_seg").isNotNull().alias("_cut"), *rest
    )


def _unpacked(df: DataFrame, keys: Sequence[str], first: Sequence[str]) -> DataFrame:
    """Key columns restored, columns in the order of `first`, added ones after them, helper columns gone."""
    added = [c for c in df.columns if c not in first and not c.startswith("_key") and c not in ("_seg", "_home", "_cut")]
    return df.select(*[F.col(f"_key.{c}").alias(c) if c in keys else F.col(c) for c in (*first, *added)])


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], segment: Column | Slices) -> DataFrame:
    """Adds `_pos`, the 0-based row number within the key, and `_total`, the rows of the key."""
    keyed = _keyed(df, keys, segment)
    earlier = Window.partitionBy("_key").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.where("_cut")
        .groupBy("_seg", "_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_key",
            "_seg",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy("_key")).alias("_all"),
        )
    )
    within = Window.partitionBy("_seg", "_key")
    numbered = keyed.withColumn("_rn", F.row_number().over(within.orderBy(*_order(order)))).withColumn(
        "_own", F.count(F.lit(1)).over(within)
    )
    pos = F.coalesce("_before", F.lit(0)) + F.col("_rn") - 1
    numbered = numbered.join(offsets, ["_seg", "_key"], "left").withColumns(
        {"_pos": pos, "_total": F.coalesce("_all", "_own")}
    )
    numbered = numbered.drop("_rn", "_own", "_before", "_all")
    return _unpacked(numbered, keys, df.columns)


def _lent(keyed: DataFrame, order: list[Column], k: int, ahead: bool) -> DataFrame:
    """Copies of edge rows, addressed to the segments whose frames reach them.

    Per key and segment only the k rows at its edge can be needed elsewhere; Spark applies that limit before the
    shuffle. In the sequence of these edge rows a segment needs the k that lie directly before its own first one, so
    each row looks k rows along that sequence for the starts of segments. Gaps and short segments need no rule.
    """
    edge = [c.asc() for c in order] if ahead else [c.desc() for c in order]
    edges = keyed.where("_cut").withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_seg", "_key").orderBy(*edge))
    ).where(F.col("_rn") <= k)
    line = Window.partitionBy("_key").orderBy(F.col("_seg").desc() if ahead else F.col("_seg").asc(), F.col("_rn").desc())
    starts = F.when(~F.col("_seg").eqNullSafe(F.lag("_seg").over(line)), F.col("_seg"))
    return (
        edges.withColumn("_start", starts)
        .withColumn("_to", F.collect_list("_start").over(line.rowsBetween(1, k)))
        .withColumn("_seg", F.explode("_to"))
        .drop("_rn", "_start", "_to")
    )


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    segment: Column | Slices,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Apply `compute(rows, window)` where frames reach at most `before` rows back and `after` rows ahead.

    Rows at the edge of a segment are copied to the segments that need them, and the copies are removed from the
    result. `compute` may add columns but must keep every row. Segments should hold many times `before + after` rows.
    """
    cols = _order(order)
    keyed = _keyed(df, keys, segment)
    rows = keyed.withColumn("_home", F.lit(True))
    for k, ahead in ((before, False), (after, True)):
        if k:
            rows = rows.unionByName(_lent(keyed, cols, k, ahead).withColumn("_home", F.lit(False)))
    window = Window.partitionBy("_seg", "_key").orderBy(*cols)
    return _unpacked(compute(rows, window).where("_home"), keys, df.columns)


def over_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    before_s: int = 0,
    after_s: int = 0,
    width_s: int = DAY,
) -> DataFrame:
    """Apply `compute(rows, window)` where frames reach at most `before_s` back and `after_s` ahead in time.

    The window is ordered by microseconds, so range frames are given in microseconds. One shuffle and one read; a row
    is copied only when it lies within the reach of another time slice. Rows without a time form a slice of their own,
    whose rows are peers, as in a plain window.
    """
    width = max(width_s, before_s, after_s) * 1_000_000
    us = epoch_us(ts)
    first = F.floor((us - after_s * 1_000_000) / width)
    last = F.floor((us + before_s * 1_000_000) / width)
    rows = (
        _keyed(df, keys, F.floor(us / width))
        .withColumn("_us", us)
        .withColumn("_to", F.explode(F.coalesce(F.sequence(first, last), F.array(F.lit(_NULL_SEGMENT)))))
        .withColumn("_home", F.col("_seg") == F.col("_to"))
        .drop("_seg")
        .withColumnRenamed("_to", "_seg")
    )
    window = Window.partitionBy("_seg", "_key").orderBy("_us")
    return _unpacked(compute(rows, window).where("_home").drop("_us"), keys, df.columns)


# kind -> (reduce a segment, combine the reduced rows of other segments, value inside the own segment)
_KINDS = {
    "sum": (lambda e, known: F.sum(e), lambda p, w: F.sum(p).over(w["earlier"]), lambda e, w: F.sum(e).over(w["upto"])),
    "max": (lambda e, known: F.max(e), lambda p, w: F.max(p).over(w["earlier"]), lambda e, w: F.max(e).over(w["upto"])),
    "min": (lambda e, known: F.min(e), lambda p, w: F.min(p).over(w["earlier"]), lambda e, w: F.min(e).over(w["upto"])),
    "last": (
        lambda e, known: F.max_by(e, known),
        lambda p, w: F.last(p, ignorenulls=True).over(w["earlier"]),
        lambda e, w: F.last(e, ignorenulls=True).over(w["upto"]),
    ),
    "next": (
        lambda e, known: F.min_by(e, known),
        lambda p, w: F.first(p, ignorenulls=True).over(w["later"]),
        lambda e, w: F.first(e, ignorenulls=True).over(w["onward"]),
    ),
    "total": (lambda e, known: F.sum(e), lambda p, w: F.sum(p).over(w["all"]), lambda e, w: F.sum(e).over(w["own"])),
}


def _merge(kind: str, own: Column, carried: Column) -> Column:
    if kind == "sum":
        known = own.isNotNull() | carried.isNotNull()
        return F.when(known, F.coalesce(own, F.lit(0)) + F.coalesce(carried, F.lit(0)))
    if kind in ("max", "min"):
        return (F.greatest if kind == "max" else F.least)(own, carried)
    return F.coalesce(carried, own) if kind == "total" else F.coalesce(own, carried)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    segment: Column | Slices,
    specs: dict[str, tuple[str, Column]],
) -> DataFrame:
    """Adds running values whose frames have no bound on one side.

    `specs` maps an output name to (kind, expression); kinds: `sum`, `max`, `min`, `last` (latest non-NULL value up to
    the row), `next` (first non-NULL value from the row on) and `total` (sum over the whole key). Each segment is
    reduced to one row, the carried value is worked out over those rows, and every row combines it with the value
    inside its own segment.
    """
    keyed = _keyed(df, keys, segment)
    cols = _order(order)
    rank = cols[0] if len(cols) == 1 else F.struct(*cols)
    by_seg = Window.partitionBy("_key").orderBy("_seg")
    within = Window.partitionBy("_seg", "_key").orderBy(*cols)
    w = {
        "earlier": by_seg.rowsBetween(Window.unboundedPreceding, -1),
        "later": by_seg.rowsBetween(1, Window.unboundedFollowing),
        "all": Window.partitionBy("_key"),
        "own": Window.partitionBy("_seg", "_key"),
        "upto": within.rowsBetween(Window.unboundedPreceding, 0),
        "onward": within.rowsBetween(0, Window.unboundedFollowing),
    }
    reduced, carried, own, merged = [], [], {}, {}
    for i, (name, (kind, expr)) in enumerate(specs.items()):
        reduce_seg, combine, inside = _KINDS[kind]
        reduced.append(reduce_seg(expr, F.when(expr.isNotNull(), rank)).alias(f"_p{i}"))
        carried.append(combine(f"_p{i}", w).alias(f"_c{i}"))
        own[f"_l{i}"] = inside(expr, w)
        merged[name] = _merge(kind, F.col(f"_l{i}"), F.col(f"_c{i}"))
    carry = keyed.where("_cut").groupBy("_seg", "_key").agg(*reduced).select("_key", "_seg", *carried)
    out = keyed.withColumns(own).join(carry, ["_seg", "_key"], "left").withColumns(merged)
    scratch = [f"_{t}{i}" for i in range(len(specs)) for t in "lc"]
    return _unpacked(out.drop(*scratch), keys, df.columns)


@dataclass(frozen=True)
class Scan:
    """A scan over segments: `rows` with their local columns, and one row of `states` for each segment, which carries what
    the segments before it amount to."""

    rows: DataFrame
    states: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]

    def joined(self, outputs: dict[str, Column]) -> DataFrame:
        """Every row with `outputs`, which may name local and carried columns."""
        both = self.rows.join(self.states, ["_seg", "_key"], "left").withColumns(outputs)
        return _unpacked(both.select("_key", *self.columns, *outputs), self.keys, [*self.keys, *self.columns])


def scanned(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    segment: Column,
    local: Callable[[DataFrame, WindowSpec], DataFrame],
    state: dict[str, Column],
    carry: Sequence[Callable[[WindowSpec, WindowSpec], dict[str, Column]]],
) -> Scan:
    """An associative scan with a state of several values.

    `local` adds columns from the rows of the own segment up to each row; `state` reduces a segment to one row; each step
    of `carry` adds columns to those rows, from windows over the earlier segments and over those up to the own one. Rows are
    shuffled once, by key and segment, where the reduction needs the same columns as the rows; else the columns it needs are
    shuffled once more for it.
    """
    keyed = _keyed(df, keys, segment)
    within = Window.partitionBy("_seg", "_key").orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, 0)
    rows = local(keyed, within)
    states = rows.groupBy("_seg", "_key").agg(*[e.alias(n) for n, e in state.items()])
    line = Window.partitionBy("_key").orderBy("_seg")
    earlier, upto = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.unboundedPreceding, 0)
    for step in carry:
        states = states.withColumns(step(earlier, upto))
    kept = [c for c in rows.columns if c not in ("_key", "_seg", "_cut")]
    return Scan(rows, states, tuple(keys), tuple(kept))
