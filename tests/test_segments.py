"""Segmented windows equal plain windows, whatever the segment width, gaps, ties of keys or NULL keys."""
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import risk as R
from tickloom.plans.quantiles import column_quantiles, exact_quantiles, value_segment
from tickloom.plans.segments import Slices, over_rows, over_time, positions, running, scanned

FEW = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "a", "a", "b", None]),
        st.integers(0, 400),
        st.one_of(st.none(), st.integers(-50, 50)),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda r: (r[0], r[1]),
)


WIDTHS = st.sampled_from([1, 7, 1000, "slices"])


def cut(width):
    """Fixed segments, or slices of keys with more than four rows."""
    return Slices(F.col("t"), 4) if width == "slices" else F.floor(F.col("t") / width).cast("long")


def frame(spark, rows):
    return spark.createDataFrame(rows, "k STRING, t BIGINT, v INT").withColumn("ts", F.timestamp_seconds("t"))


def same(left, right):
    cols = sorted(left.columns)
    assert cols == sorted(right.columns)
    a = sorted(map(repr, left.select(*cols).collect()))
    assert a == sorted(map(repr, right.select(*cols).collect()))


@FEW
@given(ROWS, WIDTHS, st.integers(0, 5), st.integers(0, 5))
def test_over_rows(spark, rows, width, before, after):
    df = frame(spark, rows)

    def compute(d, w):
        return d.withColumns(
            {
                "back": F.lag("v", before).over(w),
                "ahead": F.lead("v", after).over(w),
                "total": F.sum("v").over(w.rowsBetween(-before, after)),
                "n": F.count(F.lit(1)).over(w.rowsBetween(-before, after)),
            }
        )

    segmented = over_rows(
        df, ["k"], ["t"], compute, segment=cut(width), before=before, after=after
    )
    same(segmented, compute(df, Window.partitionBy("k").orderBy("t")))


@FEW
@given(ROWS, st.sampled_from([1, 20, 1000]), st.integers(0, 30), st.integers(0, 30))
def test_over_time(spark, rows, width, before, after):
    df = frame(spark, rows)

    def compute(d, w):
        return d.withColumn("total", F.sum("v").over(w.rangeBetween(-before * 1_000_000, after * 1_000_000)))

    segmented = over_time(df, ["k"], "ts", compute, before_s=before, after_s=after, width_s=width)
    plain = compute(df.withColumn("_us", F.unix_micros("ts")), Window.partitionBy("k").orderBy("_us")).drop("_us")
    same(segmented, plain)


@FEW
@given(ROWS, WIDTHS)
def test_running(spark, rows, width):
    df = frame(spark, rows)
    v = F.col("v")
    specs = {"s": "sum", "hi": "max", "lo": "min", "prev": "last", "nxt": "next", "all": "total"}
    segmented = running(
        df, ["k"], ["t"], cut(width), {n: (kind, v) for n, kind in specs.items()}
    )
    w = Window.partitionBy("k").orderBy("t")
    upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    plain = df.select(
        "*",
        F.sum("v").over(upto).alias("s"),
        F.max("v").over(upto).alias("hi"),
        F.min("v").over(upto).alias("lo"),
        F.last("v", ignorenulls=True).over(upto).alias("prev"),
        F.first("v", ignorenulls=True).over(onward).alias("nxt"),
        F.sum("v").over(Window.partitionBy("k")).alias("all"),
    )
    same(segmented, plain)


@FEW
@given(ROWS, WIDTHS)
def test_positions(spark, rows, width):
    df = frame(spark, rows)
    w = Window.partitionBy("k").orderBy("t")
    plain = df.select(
        "*",
        (F.row_number().over(w) - 1).cast("long").alias("_pos"),
        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("_total"),
    )
    same(positions(df, ["k"], ["t"], cut(width)), plain)


@FEW
@given(st.lists(st.floats(-1e6, 1e6, allow_subnormal=False), min_size=1, max_size=80))
def test_exact_quantiles(spark, values):
    probs = [0.0, 0.05, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    row = exact_quantiles(df, [], "v", probs).first()
    assert np.allclose(list(row), np.quantile(values, probs), rtol=1e-9, atol=1e-9)


def test_value_segment_follows_the_order(spark):
    values = sorted([0.0, 5e-324, -5e-324, 1e-300, -1e-300, 1.0, 1.0000001, -1.0, 3.5, -3.5, 1e300, -1e300])
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(value_segment(F.col("v")).alias("s"))
    segs = [r.s for r in df.collect()]
    assert segs == sorted(segs)


@pytest.mark.parametrize("share", [0.9])
def test_hot_key_is_split(spark, share):
    """A key with most of the rows is spread over many window partitions."""
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") < n * share, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds("id").alias("ts"),
        F.col("id").alias("v"),
    )
    sizes = []

    def compute(d, w):
        sizes.append(d.groupBy("_key", "_seg").count())
        return d.withColumn("prev", F.lag("v").over(w))

    out = over_rows(df, ["k"], ["ts"], compute, segment=Slices(F.col("v"), 500), before=1)
    assert out.where("k = 'hot' and v > 0 and prev = v - 1").count() == int(n * share) - 1
    assert sizes[0].agg(F.max("count")).first()[0] <= 501


@pytest.mark.parametrize("keys", [["k"], []])
def test_slices_stay_near_the_target(spark, keys):
    """One row of 1970 among many of one month does not undo the cuts, with a key or without one."""
    n, target = 20_000, 1000
    df = spark.range(n).select(F.lit("hot").alias("k"), (F.lit(1_700_000_000) + F.col("id") * 100).alias("t"))
    df = df.unionByName(spark.createDataFrame([("hot", 0)], "k STRING, t BIGINT"))
    sizes = []

    def compute(d, w):
        sizes.append(d.groupBy("_key", "_seg").count())
        return d.withColumn("prev", F.lag("t").over(w))

    out = over_rows(df, keys, ["t"], compute, segment=Slices(F.col("t"), target, slot=3600), before=1)
    assert out.where("prev is null").count() == 1
    assert sizes[0].agg(F.max("count")).first()[0] <= target + 37  # a slot of an hour holds 36 rows, and one row is lent
    assert sizes[0].count() >= n // target


@FEW
@given(ROWS, st.sampled_from([1, 7, 1000]))
def test_scanned(spark, rows, width):
    """A running sum and its peak, per key, against windows on windows."""
    df = frame(spark, rows)
    plain = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(plain)).withColumn("peak", F.max("s").over(plain))
    scan = scanned(
        df, ["k"], ["t"], F.floor(F.col("t") / width).cast("long"),
        lambda d, upto: d.withColumn("own", F.sum(F.coalesce("v", F.lit(0))).over(upto)).withColumn("top", F.max("own").over(upto)),
        {"_all": F.sum(F.coalesce("v", F.lit(0))), "_top": F.max("own")},
        [
            lambda earlier, upto: {"_before": F.coalesce(F.sum("_all").over(earlier), F.lit(0))},
            lambda earlier, upto: {"_peak": F.max(F.col("_before") + F.col("_top")).over(earlier)},
        ],
    )
    got = scan.joined({"s": F.col("_before") + F.col("own"), "peak": F.greatest("_peak", F.col("_before") + F.col("top"))})
    same(got.select(*want.columns), want)


RETURNS = st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.floats(-0.5, 0.5).map(lambda x: round(x, 3)))), min_size=1, max_size=40)


@FEW
@given(RETURNS)
def test_risk_scans(spark, steps):
    """Equity, drawdown and loss streaks over gaps of hours and days, NULL returns among them, against plain loops."""
    ts, rows = 0, []
    for gap, r in steps:
        ts += 3600 * (1 + gap * gap)
        rows.append((ts, r))
    port = spark.createDataFrame(rows, "t BIGINT, r DOUBLE").select(F.timestamp_seconds("t").alias("ts"), "r", F.lit(0.5).alias("exposure"), F.lit(None).cast("double").alias("slippage"))
    log, peak, total, streak, known, want = 0.0, -np.inf, 0.0, 0, False, []
    for _, r in rows:
        if r is not None:
            log, total, known = log + np.log1p(r), total + r, True
            peak = max(peak, log)
            streak = streak + 1 if r < 0 else 0
        want.append((np.exp(log), 1 - np.exp(log - peak), total, streak) if known else (None,) * 4)
    curve = R.equity_curve(port).orderBy("ts").collect()
    gate = R.risk_gate(port).orderBy("ts").collect()
    for c, g, w in zip(curve, gate, want, strict=True):
        got = (c.equity, c.drawdown, g.cum_ret, g.loss_streak)
        assert got == w if w[0] is None else got == pytest.approx(w, abs=1e-12)
    worst = R.max_drawdown(port).first()[0]
    assert worst is None if not known else worst == pytest.approx(max(w[1] for w in want if w[0] is not None), abs=1e-12)


DOUBLES = st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True), st.sampled_from([0.0, -0.0, 1.0, 1.0000001, -1.0]))


@FEW
@given(st.lists(st.tuples(DOUBLES, DOUBLES), min_size=1, max_size=50), st.sampled_from([1, 3, 1 << 20]))
def test_column_quantiles(spark, rows, limit):
    """Rank selection, also through narrower and narrower slices, against the sorted column."""
    df = spark.createDataFrame(rows, "a DOUBLE, `b.c` DOUBLE")
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = column_quantiles(df, ["a", "b.c"], probs, limit)
    for i, name in enumerate(["a", "b.c"]):
        values = sorted((r[i] for r in rows if r[i] is not None), key=lambda v: (v != v, 0 if v != v else v))
        for p, q in zip(probs, got[name], strict=True):
            if not values:
                assert q is None
                continue
            rank = (len(values) - 1) * p
            lo, hi, f = values[int(np.floor(rank))], values[int(np.ceil(rank))], rank - np.floor(rank)
            w = lo if lo == hi or not f else lo + (hi - lo) * f
            assert (q != q and w != w) or q == pytest.approx(w)


def test_column_quantiles_of_close_values(spark):
    """Values that share every slice but the narrowest."""
    df = spark.range(3000).select((1 + F.col("id") * 1e-13).alias("a"))
    assert column_quantiles(df, ["a"], [0.5], 10)["a"] == [pytest.approx(1 + 1499.5e-13, abs=1e-15)]
