"""Inputs that the generated tables lack: infinities, empty intervals, accents, comments, equal names, missing times."""
import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_market import bars

from tickloom.operators import features as X
from tickloom.operators import joins as J
from tickloom.operators import learning as L
from tickloom.operators import logs as G
from tickloom.operators.evaluation import auc
from tickloom.plans.quantiles import exact_quantiles
from tickloom.plans.segments import over_time
from tickloom.sources import files as FS
from tickloom.sources.xml import detect_row_tag


def test_quantiles_with_nan_and_infinity(spark):
    inf, nan = math.inf, math.nan
    for values, want in (
        ([1.0, 2.0, 3.0, 4.0, nan], [2.0, 3.0, 4.0]), ([-inf, 1.0, inf, inf, inf], [1.0, inf, inf]), ([inf, -inf, 0.0], [-inf, 0.0, inf]),
        ([-inf, -inf, -1e308, 1e308, 5e-324], [-inf, -1e308, 5e-324]),
    ):
        df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
        row = exact_quantiles(df, [], "v", [0.25, 0.5, 0.75]).first()
        if len(values) == 3:
            assert row.q1 == want[1]
        else:
            assert list(row) == want
    assert math.isnan(exact_quantiles(spark.createDataFrame([(1.0,), (nan,)], "v DOUBLE"), [], "v", [1.0]).first().q0)


def test_auc_with_infinite_scores(spark):
    df = spark.createDataFrame([(math.inf, 1), (0.5, 0), (-math.inf, 0), (0.7, 1)], "score DOUBLE, label INT")
    assert auc(df).first().auc == 1.0


@pytest.mark.parametrize("spans", [(12, 26, 9), (3, 10, 5), (1, 2, 1)])
def test_macd_of_dense_bars_and_short_spans(spark, spans):
    closes = (100 + np.random.default_rng(2).normal(size=5000).cumsum()).tolist()
    start = dt.datetime(2024, 1, 2)
    df = bars(spark, closes).withColumn("bar_ts", F.timestamp_seconds(F.lit(int(start.timestamp())) + F.col("oi_last").cast("long")))
    got = X.macd(df, *spans).orderBy("bar_ts").toPandas()
    s = pd.Series(closes)
    line = s.ewm(span=spans[0]).mean() - s.ewm(span=spans[1]).mean()
    assert np.allclose(got["macd"], line, atol=1e-9) and np.allclose(got["macd_signal"], line.ewm(span=spans[2]).mean(), atol=1e-9)


def test_a_season_leaves_no_trace_in_the_trend(spark):
    closes = [10.0 + (k % 4) for k in range(40)]
    got = X.seasonal_decompose(bars(spark, closes, [60 * k for k in range(40)]), 4).where("trend is not null").collect()
    assert len(got) == 36 and all(r.trend == pytest.approx(11.5) and r.residual == pytest.approx(0) for r in got)


def test_empty_interval_of_a_fold(spark):
    d = dt.date
    folds = spark.createDataFrame([(0, d(2024, 1, 1), d(2024, 1, 3), d(2024, 1, 3), d(2024, 1, 3))], "fold INT, train_start DATE, train_end DATE, val_start DATE, val_end DATE")
    days = spark.createDataFrame([(d(2024, 1, k),) for k in (1, 2, 3, 4)], "trade_date DATE")
    assert sorted((r.trade_date.day, r.part) for r in J.assign_folds(days, folds, "trade_date").collect()) == [(1, "train"), (2, "train")]


def test_words_are_bound_by_letters_of_any_script(spark):
    df = spark.createDataFrame([("unête",), ("fun",), ("un.",), ("UN",), ("un_x",)], "message STRING")
    assert sorted(r.message for r in G.search_messages(df, ["un"]).collect()) == ["UN", "un.", "un_x"]


@pytest.mark.parametrize("head", ["<!-- <old> rows --><!-- <a> > <b> -->", "<?xml version='1.0'?><!DOCTYPE x>", "<!-- c " + "> " * 500 + "-->", ""])
def test_row_tag_outside_comments(spark, tmp_path, head):
    (tmp_path / "a.xml").write_text(f"{head}<root at='1'><!-- <no> --><![CDATA[<neither>]]><tick a='1'><p>1</p></tick></root>")
    assert detect_row_tag(spark, str(tmp_path / "a.xml")) == "tick"


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    for k in ("a", "b"):
        (tmp_path / "src" / k).mkdir(parents=True)
        (tmp_path / "src" / k / "x.v1.png").write_bytes(k.encode())
    src, raw = str(tmp_path / "src"), str(tmp_path / "raw")
    assert FS.copy_binaries_to_raw(spark, src, raw, "2024-02-01").count() == 2
    assert [(tmp_path / f"raw/images/2024-02-01/{k}/x.v1.png").read_bytes() for k in ("a", "b")] == [b"a", b"b"]
    assert {r.image_id for r in FS.catalogue_binaries(spark, src, "s", "t").collect()} == {"a/x.v1", "b/x.v1"}


def test_rows_without_a_time_stay(spark):
    df = spark.createDataFrame([(k, None if k % 5 == 0 else dt.datetime(2024, 1, 1, 0, k)) for k in range(20)], "k INT, ts TIMESTAMP")
    out = over_time(df, [], "ts", lambda d, w: d.withColumn("n", F.count("ts").over(w.rangeBetween(-120_000_000, 0))), before_s=120, width_s=240)
    got = {r.k: r.n for r in out.collect()}
    assert len(got) == 20 and [got[0], got[5], got[1], got[4]] == [0, 0, 1, 3]


def test_months_without_a_code_row_stay(spark):
    df = spark.createDataFrame([("202401", dt.date(2024, 1, 2), 0.1), ("202402", dt.date(2024, 1, 2), 0.2)], "ymcode STRING, trade_date DATE, f_vol_20 DOUBLE")
    codes = spark.createDataFrame([("202401", 20240131)], "ymcode STRING, lastday INT")
    assert {r.ymcode: r.expiry_bucket for r in L.regime_labels(df, codes).collect()} == {"202401": "mid", "202402": None}


def test_bursts_of_counted_slides(spark):
    at = [dt.datetime(2024, 1, 1, 10, 0, s) for s in range(30)] + [dt.datetime(2024, 1, 1, 10, 8, s) for s in range(30)]
    df = spark.createDataFrame([(t, "ERROR") for t in at], "event_time TIMESTAMP, level STRING")
    got = {r.window_start.minute: r.errors for r in G.error_bursts(df).collect()}
    assert got == {59: 60, 0: 60}


def test_damaged_log_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"event_time":"2024-01-01T00:00:00","level":"INFO","message":"m"}\n{"event_time":\n{"event_time":"soon","level":"INFO"}\n')
    raw = FS.read_raw_json(spark, str(tmp_path), keep_corrupt=True)
    assert FS.load_logs_bronze(raw).count() == 2
    bad = {r.reason: r.text for r in FS.damaged_logs(raw).collect()}
    assert set(bad) == {"broken JSON", "no event time"} and bad["broken JSON"] == '{"event_time":' and "soon" in bad["no event time"]
    assert FS.damaged_logs(FS.read_raw_json(spark, str(tmp_path))).count() == 2


def test_state_of_many_batches_keeps_two_folders(spark, tmp_path):
    from tickloom.streaming.run import Versions

    kept = Versions(spark, str(tmp_path / "s"), 2)
    for k in range(10):
        before = kept.read_before(k, "id BIGINT")
        assert (before is None) == (k == 0) and (before is None or before.count() == k - 1)
        kept.write(spark.range(k), k)
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["batch=8", "batch=9"]


def test_search_ranks_its_trials(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6))
    start = dt.datetime(2024, 1, 1)
    rows = [("202401", "CALL", "X", 10, start + dt.timedelta(minutes=k), *map(float, v), float(v[0] * 0.01)) for k, v in enumerate(x)]
    names = [f"x{k}" for k in range(6)]
    df = spark.createDataFrame(rows, "ymcode STRING, side STRING, code STRING, strike INT, asof_ts TIMESTAMP, " + ", ".join(f"{n} DOUBLE" for n in names) + ", y DOUBLE")
    trials, model = L.random_search(df, 3, "y", names, max_iter=30)
    found = trials.orderBy("rmse").collect()
    assert len(found) == 3 and all(1 <= r.rounds <= 30 for r in found)
    assert model.stages[-1].getNumTrees == found[0].rounds and found[0].rmse < float(np.std(x[:, 0] * 0.01))
