"""Edge cases of ticks, bars, features, labels, indicators and the jobs that read them."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars as S
from tickloom.operators import bars as B
from tickloom.operators import features as X
from tickloom.operators import joins as J
from tickloom.schemas import ENTITY

T0 = dt.datetime(2024, 1, 2, 9, 0)
TICK = (
    "ymcode STRING, side STRING, code STRING, strike INT, ts TIMESTAMP, tcnt BIGINT, price DOUBLE, open DOUBLE, "
    "high DOUBLE, low DOUBLE, oi DOUBLE, ccnt BIGINT, trade_date DATE, minute_ts TIMESTAMP"
)
BAR = (
    "ymcode STRING, side STRING, code STRING, strike INT, bar_ts TIMESTAMP, o DOUBLE, h DOUBLE, l DOUBLE, c DOUBLE, "
    "v BIGINT, tick_count BIGINT, oi_last DOUBLE, trade_date DATE"
)


def ticks(spark, rows, strike=10):
    """rows: (seconds after T0, tcnt, price[, open])"""
    out = []
    for sec, tcnt, price, *rest in rows:
        ts = T0 + dt.timedelta(seconds=sec)
        op = rest[0] if rest else price
        out.append(
            ("202401", "CALL", "X", strike, ts, tcnt, price, op, price, price, 1.0, 2, ts.date(), ts.replace(second=0))
        )
    return spark.createDataFrame(out, TICK)


def bars(spark, closes, minutes=None, strike=10, code="X", start=T0):
    minutes = minutes or range(len(closes))
    rows = [
        ("202401", "CALL", code, strike, start + dt.timedelta(minutes=m), c, c, c, c, 1, 1, float(i), (start + dt.timedelta(minutes=m)).date())
        for i, (m, c) in enumerate(zip(minutes, closes))
    ]
    return spark.createDataFrame(rows, BAR)


def values(df, col, order="asof_ts"):
    return [r[0] for r in df.orderBy(order).select(col).collect()]


def test_tied_times_use_the_sequence_number(spark):
    row = B.ohlc_bars(ticks(spark, [(5, 2, 20.0), (5, 1, 10.0), (5, 3, 30.0)])).first()
    assert (row.o, row.c, row.h, row.l, row.tick_count, row.v) == (10.0, 30.0, 30.0, 10.0, 3, 6)


def test_volume_can_be_the_tick_count(spark):
    assert B.ohlc_bars(ticks(spark, [(1, 1, 1.0), (2, 2, 2.0)]), volume="tick_count").first().v == 2


def test_unique_times_give_the_same_bars(spark):
    df = ticks(spark, [(i, i, float(i % 7)) for i in range(200)])
    assert sorted(B.ohlc_bars(df).collect()) == sorted(B.ohlc_bars(df, unique_ts=True).collect())


def test_first_open_missing_stays_missing(spark):
    row = B.ohlc_bars(ticks(spark, [(1, 1, 5.0, None), (2, 2, 6.0)])).first()
    assert row.o is None and row.c == 6.0


def test_zero_price_gives_null_not_an_error(spark):
    df = bars(spark, [1.0, 0.0, 2.0, 0.0])
    assert values(X.features(df), "f_ret_1") == [None, -1.0, None, -1.0]
    assert values(X.range_1(df), "range_1") == [0.0, None, 0.0, None]
    assert values(X.labels(df), "y_fwd_ret_5") == [None] * 4


def test_gap_separates_rows_from_minutes(spark):
    df = bars(spark, [1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0], [0, 1, 2, 3, 4, 6, 7])
    assert values(X.features(df), "f_ret_5")[5] == 31.0  # five rows back
    by_time = values(X.features_time(df), "ft_ret_5")
    assert by_time[5] == 15.0 and by_time[6] == 15.0  # five minutes back
    assert values(X.labels(df), "y_fwd_ret_5")[0] == 31.0
    assert values(X.labels_time(df), "yt_fwd_ret_5") == [None, 15.0, 15.0, None, None, None, None]


def test_null_strike_is_one_group_and_keeps_its_labels(spark):
    df = bars(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], strike=None)
    assert values(X.features(df), "f_ret_1")[1] == 1.0
    assert values(X.labels(df), "y_fwd_ret_5")[:3] == [5.0, 2.5, None]
    joined = X.features_with_close(X.features(df), df)
    assert values(joined, "close") == [None] * 7  # an equi-join finds no NULL key


def test_windows_cross_the_date_unless_by_day(spark):
    df = bars(spark, [1.0, 2.0], start=dt.datetime(2024, 1, 2, 23, 59))
    assert values(X.features(df), "f_ret_1") == [None, 1.0]
    assert values(X.features(df, by_day=True), "f_ret_1") == [None, None]


def test_short_series(spark):
    df = bars(spark, [1.0, 2.0, 3.0])
    assert values(X.moving_average(df, 20), "ma_20", "bar_ts") == [None] * 3
    assert values(X.features(df), "f_vol_20")[2] is not None
    from tickloom.operators.learning import make_sequences

    assert make_sequences(df, 60).count() == 0


def test_narrow_segments_change_nothing(spark):
    rng = np.random.default_rng(1)
    closes = (100 + rng.normal(size=120).cumsum()).round(2).tolist()
    minutes = sorted(rng.choice(2000, 120, replace=False).tolist())
    df = bars(spark, closes, minutes)
    # a bar length of 1 second makes slices of 24 minutes, most of them shorter than the 20 rows of a frame
    key = lambda r: r.asof_ts
    assert sorted(X.features(df, bar_s=1).collect(), key=key) == sorted(X.features(df, bar_s=100000).collect(), key=key)
    assert sorted(X.labels(df, bar_s=1).collect(), key=key) == sorted(X.labels(df, bar_s=100000).collect(), key=key)


def test_macd_equals_pandas_ewm(spark):
    rng = np.random.default_rng(2)
    closes = (100 + rng.normal(size=900).cumsum()).tolist()
    got = X.macd(bars(spark, closes), bar_s=1).orderBy("bar_ts").toPandas()  # slices of 24 bars
    s = pd.Series(closes)
    line = s.ewm(span=12).mean() - s.ewm(span=26).mean()
    assert np.allclose(got["macd"], line, atol=1e-4)
    assert np.allclose(got["macd_signal"], line.ewm(span=9).mean(), atol=1e-4)


def test_rsi_without_losses_is_100(spark):
    got = values(X.rsi(bars(spark, [float(i) for i in range(1, 18)])), "rsi", "bar_ts")
    assert got[:14] == [None] * 14 and got[14:] == [100.0] * 3


def test_fill_gaps_interpolates(spark):
    df = bars(spark, [1.0, 4.0], [0, 3])
    assert values(B.fill_gaps(df, 60), "c", "grid_ts") == [1.0, 1.0, 1.0, 4.0]
    assert values(B.fill_gaps(df, 60, "linear"), "c", "grid_ts") == [1.0, 2.0, 3.0, 4.0]


@pytest.mark.parametrize("method", ["ffill", "linear"])
def test_long_gaps_are_cut_into_spans(spark, method):
    """Spans of any length give the same grid; a gap of ten million steps is filled by several tasks."""
    df = bars(spark, [1.0, 4.0, 2.0, 9.0], [0, 3, 60, 61])
    want = sorted(map(tuple, B.fill_gaps(df, 60, method).collect()), key=repr)
    for span in (1, 2, 7, 56, 57, 58):
        assert sorted(map(tuple, B.fill_gaps(df, 60, method, span).collect()), key=repr) == want
    steps = 10_000_000
    grid = B.fill_gaps(bars(spark, [1.0, 3.0], [0, steps]), 60, method)
    parts = grid.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("c").alias("top")).collect()
    assert sum(r.n for r in parts) == steps + 1 and sum(r.n > steps // 10 for r in parts) > 1
    assert max(r.top for r in parts) == 3.0


def test_max_favourable_return_looks_strictly_ahead(spark):
    got = values(X.max_favourable_return(bars(spark, [10.0, 12.0, 11.0], [0, 20, 41])), "max_fav_ret")
    assert got[0] == pytest.approx(0.2) and got[1:] == [None, None]


def test_rollup_equals_bars_on_ticks(spark):
    df = ticks(spark, [(i * 17, i, float((i * 31) % 13)) for i in range(500)])
    cols = [*ENTITY, "bar_ts", "o", "h", "l", "c", "v", "tick_count", "oi_last", "trade_date"]
    a = sorted(map(repr, B.rollup_bars(B.ohlc_bars(df), "1 hour").select(*cols).collect()))
    assert a == sorted(map(repr, B.ohlc_bars(df, "1 hour").select(*cols).collect()))


def test_bar_invariants(spark):
    df = ticks(spark, [(i * 7, i, float((i * 31) % 13)) for i in range(300)])
    out = B.ohlc_bars(df)
    assert out.where("l > o or l > c or h < o or h < c").count() == 0
    assert out.agg(F.sum("tick_count")).first()[0] == 300


def test_contract_without_ticks_has_strike_minus_one(spark):
    codes = spark.createDataFrame(
        [("202401", "CALL", "X", 20240131), ("202401", "PUT", "N", 20240131)], "ymcode STRING, side STRING, code STRING, lastday INT"
    )
    rows = {r.code: r for r in B.dim_contract(codes, ticks(spark, [(1, 1, 1.0)])).collect()}
    assert rows["X"].strike == 10 and rows["N"].strike == -1
    assert rows["N"].effective_to == dt.date(2999, 12, 31)


def test_strike_is_the_first_seen(spark):
    df = ticks(spark, [(9, 2, 1.0)], strike=99).unionByName(ticks(spark, [(1, 1, 1.0)], strike=11))
    assert B.strike_first_seen(df).first().strike == 11


def test_decision_limits_hold(spark):
    df = spark.createDataFrame([(0.001,), (-0.001,), (0.0011,), (-0.0011,), (None,)], "pred DOUBLE")
    assert [r[0] for r in df.select(S.decide("pred")).collect()] == ["HOLD", "HOLD", "BUY", "SELL", "HOLD"]


def test_hours_of_the_day(spark):
    rows = [(dt.datetime(2024, 1, 6, h),) for h in (0, 6, 12, 18, 23)]
    got = spark.createDataFrame(rows, "ts TIMESTAMP").select(*S.time_features("ts")).collect()
    assert [r.time_of_day for r in got] == [None, "night", "morning", "afternoon", "evening"]
    assert all(r.is_weekend and r.day_of_week == 5 for r in got)


def test_point_in_time_join_ignores_the_future(spark):
    left = spark.createDataFrame([("a", dt.datetime(2024, 1, 5), 1), ("b", dt.datetime(2024, 1, 5), 2)], "k STRING, ts TIMESTAMP, id INT")
    right = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), 1.0), ("a", dt.datetime(2024, 1, 5), 2.0), ("a", dt.datetime(2024, 1, 6), 3.0)],
        "k STRING, ts TIMESTAMP, v DOUBLE",
    )
    got = {r.id: r.v for r in J.pit_join(left, right, ["k"], "ts").collect()}
    assert got == {1: 2.0, 2: None}
    early = right.where("v = 1.0")
    assert J.pit_join(left, early, ["k"], "ts").where("id = 1").first().v == 1.0
    assert J.pit_join(left, early, ["k"], "ts", tolerance_s=3600).where("id = 1").first().v is None


def test_nearest_strike_prefers_the_lower_on_ties(spark):
    surface = spark.createDataFrame([("m", T0, 90, 0.1), ("m", T0, 110, 0.2)], "ymcode STRING, ts TIMESTAMP, strike INT, iv DOUBLE")
    quotes = spark.createDataFrame([("m", T0, s) for s in (80, 100, 101, 500)], "ymcode STRING, ts TIMESTAMP, strike INT")
    got = {r.strike: r.near_strike for r in J.nearest_strike(surface, quotes).collect()}
    assert got == {80: 90, 100: 90, 101: 110, 500: 110}


def test_parity_diff_matches_null_keys(spark):
    a = spark.createDataFrame([(None, 1.0), ("x", 1.0), ("y", None)], "k STRING, v DOUBLE")
    b = spark.createDataFrame([(None, 1.0), ("x", 2.0), ("z", 1.0), ("y", None)], "k STRING, v DOUBLE")
    got = sorted((r.k, r.reason) for r in J.parity_diff(a, b, ["k"], "v").collect())
    assert got == [("x", "differs"), ("z", "missing_in_batch")]
