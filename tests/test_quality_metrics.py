"""Quality rules, metric functions, evaluation, risk and options on small inputs."""
import datetime as dt
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.functions import blackscholes as bs
from tickloom.operators import evaluation as V
from tickloom.operators import learning as L
from tickloom.operators import metrics as M
from tickloom.operators import options as O
from tickloom.operators import quality as D
from tickloom.operators import risk as R
from tickloom.schemas import ENTITY, FEATURE_COLS

T0 = dt.datetime(2024, 1, 2, 9, 0)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def samples(spark, points, labels=None):
    rows = [("m", "i", labels or {}, T0 + dt.timedelta(seconds=s), float(v)) for s, v in points]
    return spark.createDataFrame(rows, "metric STRING, instance STRING, labels MAP<STRING,STRING>, ts TIMESTAMP, value DOUBLE")


def rates(df, window=300):
    return [r.rate for r in M.counter_rate(df, window).orderBy("ts").collect()]


def test_counter_reset_counts_the_value_after_it(spark):
    got = rates(samples(spark, [(0, 100), (60, 130), (120, 10), (180, 40)]))
    assert got == [None, 30 / 300, 40 / 300, 70 / 300]


def test_rate_sees_only_its_window(spark):
    got = rates(samples(spark, [(0, 0), (300, 10), (301, 30), (1000, 99)]))
    assert got == [None, 10 / 300, 20 / 300, None]


def test_rate_against_every_window_summed_up(spark):
    rng = random.Random(5)
    points = [(s, rng.choice([None, 0, 5, rng.randrange(1000)])) for s in sorted(rng.sample(range(-40_000, 40_000), 300))]
    rows = [("m", "i", {}, T0 + dt.timedelta(seconds=s), None if v is None else float(v)) for s, v in points]
    timeless = [("m", "i", {}, None, 7.0)] * 3  # peers of each other: no time, so one window
    schema = "metric STRING, instance STRING, labels MAP<STRING,STRING>, ts TIMESTAMP, value DOUBLE"
    values = [r[4] for r in rows]
    steps = [None] + [None if b is None else b if a is not None and b < a else b - a if a is not None else None for a, b in zip(values, values[1:])]
    for window in (7, 300, 5000):
        want = []
        for s, _ in points:
            inside = [d for (u, _), d in zip(points, steps) if s - window <= u <= s]
            known = [d for d in inside if d is not None]
            want.append((sum(known) - (inside[0] or 0)) / window if len(inside) > 1 and known else None)
        out = M.counter_rate(spark.createDataFrame(rows + timeless, schema), window).orderBy("ts").collect()
        assert [r.rate for r in out if r.ts is None] == [0.0] * 3
        assert [r.rate for r in out if r.ts is not None] == pytest.approx(want)


def test_rate_passes_once_over_its_rows(spark):
    """A frame that starts a time before each row is summed up anew for every row; all frames here start at a first row."""
    plan = M.counter_rate(samples(spark, [(0, 100), (60, 130)]), 21600)._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+),", plan)
    assert {start for _, start in frames} <= {"unboundedpreceding$()", "-1"}, frames
    assert not [f for f in frames if f[0] == "RangeFrame" and not f[1].startswith("unbounded")]
    assert plan.count("Exchange hashpartitioning") == 1


def test_series_are_told_apart_by_labels(spark):
    df = samples(spark, [(0, 0), (60, 30)], {"cpu": "0"}).unionByName(samples(spark, [(0, 500), (60, 560)], {"cpu": "1"}))
    assert sorted(r.rate for r in M.counter_rate(df).where("rate is not null").collect()) == [0.1, 0.2]
    assert M.latest_sample(df).count() == 2
    assert M.cpu_utilisation(df).orderBy("ts").collect()[1].utilisation == pytest.approx(85.0)


def test_alert_needs_the_whole_duration(spark):
    def alerts(points, for_s):
        return M.sustained_alert(samples(spark, points), "value", 80, for_s).orderBy("start_ts").collect()

    broken = [(0, 90), (60, 90), (120, 70), (180, 90), (240, 95), (480, 99), (540, 10)]
    got = alerts(broken, 300)
    assert [(r.samples, r.peak) for r in got] == [(3, 99.0)]
    assert got[0].fires_at == T0 + dt.timedelta(seconds=480)
    assert len(alerts(broken, 0)) == 2
    assert alerts([(0, 80), (600, 80)], 0) == []


def test_duplicates_are_flagged_and_removed(spark):
    cols = "ymcode STRING, side STRING, code STRING, strike INT, tdate TIMESTAMP, tcnt BIGINT, c DOUBLE, ingest_ts TIMESTAMP"
    later = T0 + dt.timedelta(hours=1)
    df = spark.createDataFrame(
        [("m", "CALL", "x", None, T0, 1, 1.0, T0), ("m", "CALL", "x", None, T0, 1, 2.0, later), ("m", "CALL", "x", 5, T0, 2, 3.0, T0)], cols
    )
    assert [r.copies for r in D.duplicate_ticks(df).collect()] == [2]
    once = D.dedupe_ticks(df)
    assert once.columns == df.columns
    assert sorted(r.c for r in once.collect()) == [2.0, 3.0]
    assert sorted(r.c for r in D.dedupe_ticks(once).collect()) == [2.0, 3.0]


def test_out_of_order_ticks(spark):
    cols = "ymcode STRING, side STRING, code STRING, strike INT, ts TIMESTAMP, tcnt BIGINT"
    rows = [("m", "C", "x", 1, T0 + dt.timedelta(seconds=s), t) for s, t in ((0, 1), (9, 2), (5, 3), (10, 200_001), (7, 400_000))]
    got = D.time_reversals(spark.createDataFrame(rows, cols)).orderBy("tcnt").collect()
    assert [r.tcnt for r in got] == [3, 400_000]


def test_price_rules(spark):
    cols = "ymcode STRING, side STRING, code STRING, strike INT, ts TIMESTAMP, tcnt BIGINT, price DOUBLE"
    rows = [("m", "C", "x", 1, T0 + dt.timedelta(hours=i), i, p) for i, p in enumerate([10.0, 14.0, 30.0, 0.0, 5.0, -1.0])]
    got = D.price_outliers(spark.createDataFrame(rows, cols)).orderBy("ts").collect()
    assert [(r.tcnt, r.zero_price, r.negative_price, r.price_jump) for r in got] == [
        (2, False, False, True), (3, True, False, True), (5, False, True, True),
    ]


def test_quarantine_and_gate(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, None)], "n STRING, s STRING")
    rules = {"n": ("int", True), "s": ("string", True)}
    assert [tuple(r) for r in D.enforce_schema(df, rules).collect()] == [(1, "a")]
    assert sorted(r.reason for r in D.quarantine(df, rules).collect()) == ["n: missing; s: missing", "n: not int"]
    assert {r["column"] for r in D.null_threshold_gate(df, 0.3).collect()} == {"n", "s"}
    assert D.null_threshold_gate(df, 0.4).count() == 0
    rep = D.drop_report(df).first()
    assert (rep.rows_before, rep.rows_after) == (3, 2) and rep.null_percentage == pytest.approx(100 / 3)
    assert D.drop_report(df.where("false")).first().null_percentage is None


def feature_rows(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ts = T0 + dt.timedelta(minutes=i // 3)
        f = rng.normal(size=7).tolist()
        rows.append(("m", "CALL", f"c{i % 3}", 10, ts, *f, f[0] * 2 + f[1], ts.date()))
    cols = ", ".join(f"{c} DOUBLE" for c in FEATURE_COLS)
    return spark.createDataFrame(
        rows, f"ymcode STRING, side STRING, code STRING, strike INT, asof_ts TIMESTAMP, {cols}, y_fwd_ret_5 DOUBLE, trade_date DATE"
    )


def test_ordered_split_is_exact_and_in_time_order(spark):
    df = feature_rows(spark, 300)
    parts = {r.part: r for r in L.ordered_split(df).groupBy("part").agg(F.count("*").alias("n"), F.min("asof_ts").alias("lo"), F.max("asof_ts").alias("hi")).collect()}
    assert (parts["train"].n, parts["valid"].n) == (240, 60)
    assert parts["train"].hi <= parts["valid"].lo


def test_random_split_repeats(spark):
    df = spark.range(2000)
    a = L.random_split(df, ["id"]).where("part = 'train'")
    assert a.exceptAll(L.random_split(df.repartition(7), ["id"]).where("part = 'train'")).count() == 0
    assert 1500 < a.count() < 1700


def test_fold_edges(spark):
    days = spark.range(20).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    folds = L.walk_forward_folds(days, "d", 14, 3, 3).orderBy("fold").collect()
    assert [(f.train_start.day, f.train_end.day, f.val_start.day, f.val_end.day) for f in folds] == [(1, 15, 15, 18), (4, 18, 18, 21)]
    assert L.walk_forward_folds(days.limit(10), "d", 14, 3, 3).count() == 0
    from tickloom.operators.joins import assign_folds

    parts = assign_folds(days, L.walk_forward_folds(days, "d", 14, 3, 3), "d").groupBy("fold", "part").count().collect()
    assert sorted((r.fold, r.part, r["count"]) for r in parts) == [(0, "train", 14), (0, "valid", 3), (1, "train", 14), (1, "valid", 3)]


def test_models_learn_and_search(spark):
    df = feature_rows(spark, 600)
    model = L.train_regressor(df, max_iter=10)
    valid = model.transform(L.ordered_split(df).where("part = 'valid'"))
    row = V.regression_metrics(valid, "prediction", "y_fwd_ret_5").first()
    assert row.r2 > 0.4
    trials, best = L.random_search(df, n_trials=2, max_iter=3)
    got = trials.collect()
    assert len(got) == 2 and all(0.001 <= r.step_size <= 0.2 and r.rmse > 0 for r in got)
    assert best.transform(df).count() == 600
    labelled = df.withColumn("label", (F.col("y_fwd_ret_5") > 0).cast("int"))
    forest = L.train_classifier(labelled, "label", FEATURE_COLS, trees=10, depth=4)
    scored = forest.transform(labelled).withColumn("prediction", F.col("prediction").cast("int"))
    assert V.classification_metrics(scored).first().accuracy > 0.8
    requests = spark.createDataFrame([("k1",), ("gone",)], "feature_key STRING")
    keyed = df.limit(1).withColumn("feature_key", F.lit("k1"))
    out = {r.feature_key: r for r in L.batch_score(requests, keyed, L.score_with(model)).collect()}
    assert out["k1"].ok and out["k1"].decision in ("BUY", "SELL", "HOLD")
    assert not out["gone"].ok and out["gone"].reason == "no_features_in_cache" and out["gone"].decision is None


def test_class_metrics_without_predictions_are_null(spark):
    row = V.classification_metrics(spark.createDataFrame([(1, 0), (0, 0)], "label INT, prediction INT")).first()
    assert row.precision is None and row.recall == 0.0 and row.accuracy == 0.5


def test_auc_equals_pairwise_count(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 300), rng.integers(0, 20, 300) / 20
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label INT, score DOUBLE")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert V.auc(df).first().auc == pytest.approx(want)
    top = V.roc_curve(df).orderBy("threshold").first()
    assert (top.tpr, top.fpr) == (1.0, 1.0)


@FEW
@given(st.lists(st.floats(-100, 100), min_size=12, max_size=40), st.lists(st.floats(-100, 100), min_size=3, max_size=40))
def test_psi_is_never_negative(spark, base, cur):
    def frame(v):
        return spark.createDataFrame([(x,) for x in v], "f DOUBLE")

    assert V.feature_drift_psi(frame(base), frame(cur), ["f"]).first().psi >= 0
    assert V.feature_drift_psi(frame(base), frame(base), ["f"]).first().psi == pytest.approx(0)


def test_fingerprint_ignores_order_but_sees_duplicates(spark):
    a = spark.range(100).withColumn("v", F.col("id") * 2)
    fp = lambda df: V.dataset_fingerprint(df, ["v"]).first()
    assert fp(a) == fp(a.repartition(5).select("v", "id"))
    assert fp(a).data_snapshot_id != fp(a.unionByName(a.limit(1)).unionByName(a.limit(1))).data_snapshot_id
    assert fp(a).feature_hash != V.dataset_fingerprint(a, ["w"]).first().feature_hash


def test_fingerprint_of_plain_text(spark):
    """The value follows from MD5 over the documented text of each row."""
    import hashlib

    rows = [("x", 1.25, None, 3), (None, -0.0000004, dt.datetime(2024, 1, 2, 3, 4, 5, 6), 4), ("x", 1.25, None, 3), ("y", float("nan"), None, None), ("z", 2e15, None, -1)]
    df = spark.createDataFrame(rows, "b STRING, a DOUBLE, t TIMESTAMP, n BIGINT")
    texts = ["1250000\x1fx\x1f3\x1f~", "0\x1f~\x1f4\x1f1704164645000006", "1250000\x1fx\x1f3\x1f~", "nan\x1fy\x1f~\x1f~", "2.000000000e+15\x1fz\x1f-1\x1f~"]
    digests = [hashlib.md5(t.encode()).hexdigest() for t in texts]
    lanes = [sum(int(d[8 * i : 8 * i + 8], 16) for d in digests) % 2**32 for i in range(4)]
    got = V.dataset_fingerprint(df, ["a"]).first()
    assert got.data_snapshot_id == "-".join(f"{x:08x}" for x in lanes) + "-5" and got.rows == 5
    assert V.dataset_fingerprint(df.limit(0), []).first().data_snapshot_id == "00000000-00000000-00000000-00000000-0"



def test_runs(spark):
    log = lambda *a, **k: V.log_metrics(spark, *a, **k)
    m = log("r1", "exp", "gold", {"sharpe": 2.0, "dd": 0.1}, logged_at=T0)
    m = m.unionByName(log("r2", "exp", "gold", {"sharpe": 3.0, "dd": 0.3}, logged_at=T0 + dt.timedelta(days=1)))
    m = m.unionByName(log("r3", "exp", "gold", {"sharpe": 1.8, "dd": 0.1}, logged_at=T0))
    best = V.promote(m, {"sharpe": (">", 1.5), "dd": ("<", 0.2)}, "sharpe").orderBy("rank").collect()
    assert [(r.run_id, r.stage) for r in best] == [("r1", "Production"), ("r3", "Staging")]
    assert V.latest_run(m, "exp").first().run_id == "r2" and V.latest_run(m, "other").count() == 0
    diff = {r.key: r.difference for r in V.compare_runs(m, "r1", "r2").collect()}
    assert diff["sharpe"] == 1.0


def port(spark, returns, minutes=60 * 7):
    rows = [(T0 + dt.timedelta(minutes=minutes * i), float(r), 1.0, 0.0) for i, r in enumerate(returns)]
    return spark.createDataFrame(rows, "ts TIMESTAMP, r DOUBLE, exposure DOUBLE, slippage DOUBLE")


@FEW
@given(st.lists(st.floats(-0.9, 2.0), min_size=1, max_size=30))
def test_drawdown_lies_between_zero_and_one(spark, returns):
    got = R.max_drawdown(port(spark, returns)).first()[0]
    eq = np.cumprod(1 + np.array(returns))
    assert got == pytest.approx(np.max(1 - eq / np.maximum.accumulate(eq)), abs=1e-9)
    assert -1e-9 <= got <= 1


def test_loss_streak_and_gate(spark):
    got = R.risk_gate(port(spark, [0.01, -0.01, -0.01, 0.0, -0.01]), streak_limit=2, exposure_limit=2).orderBy("ts").collect()
    assert [r.loss_streak for r in got] == [0, 1, 2, 0, 1]
    assert [r.halt for r in got] == [False, False, True, False, False]


def test_cvar_and_worst_period(spark):
    rets = np.round(np.random.default_rng(5).normal(0, 0.01, 60), 4)
    row = R.cvar(port(spark, rets), 0.1).first()
    assert row.var == pytest.approx(np.quantile(rets, 0.1))
    assert row.cvar == pytest.approx(rets[rets <= np.quantile(rets, 0.1)].mean())
    daily = port(spark, [0.1, -0.2, 0.05], minutes=1440)
    assert R.worst_period(daily, 2).first().worst_return == pytest.approx(0.8 * 1.05 - 1)


def test_costs_reduce_returns(spark):
    rows = [("m", "C", "x", 1, T0 + dt.timedelta(minutes=i), p, 0.01) for i, p in enumerate([1, 1, -1, 0])]
    pnl = spark.createDataFrame(rows, "ymcode STRING, side STRING, code STRING, strike INT, ts TIMESTAMP, position INT, ret DOUBLE")
    got = [r.strat_ret for r in R.strategy_returns(pnl, 0.001).orderBy("ts").collect()]
    assert got == pytest.approx([0.009, 0.01, -0.012, -0.001])
    assert R.turnover(pnl).first().turnover == 4


def test_normal_distribution():
    x = np.linspace(-8, 8, 401)
    want = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])
    assert np.allclose(bs.norm_cdf(x), want, atol=1e-14)


def test_implied_vol_round_trip(spark):
    rng = np.random.default_rng(0)
    n = 200
    call = rng.random(n) < 0.5
    s, k = rng.uniform(80, 120, n), rng.uniform(80, 120, n)
    t, vol = rng.uniform(0.1, 2, n), rng.uniform(0.1, 0.8, n)
    p = bs.price(call, s, k, t, 0.03, vol)
    df = spark.createDataFrame(
        pd.DataFrame({"id": range(n), "side": np.where(call, "CALL", "PUT"), "price": p, "underlying": s, "strike": k, "t_years": t})
    )
    got = O.implied_vol_greeks(df, 0.03).orderBy("id").toPandas()
    again = bs.price(call, s, k, t, 0.03, got["iv"].to_numpy())
    assert np.allclose(again, p, atol=1e-8)
    bump = (bs.price(call, s + 1e-4, k, t, 0.03, vol) - bs.price(call, s - 1e-4, k, t, 0.03, vol)) / 2e-4
    vega_ok = got["vega"].to_numpy() > 1
    assert np.allclose(got["delta"].to_numpy()[vega_ok], bump[vega_ok], atol=1e-4)


def test_missing_option_inputs_give_null(spark):
    rows = [("CALL", None, 100.0, 100.0, 1.0), ("CALL", 1.0, 100.0, None, 1.0), ("PUT", 500.0, 100.0, 100.0, 1.0), (None, 10.0, 100.0, 100.0, 1.0)]
    df = spark.createDataFrame(rows, "side STRING, price DOUBLE, underlying DOUBLE, strike DOUBLE, t_years DOUBLE")
    assert O.implied_vol_greeks(df).where("iv is null and delta is null").count() == 4


def test_surface_is_linear_between_known_strikes(spark):
    rows = [("m", T0, k, v) for k, v in ((80, None), (90, 0.2), (95, None), (110, 0.4), (120, None), (2500, 0.9), (1500, None))]
    df = spark.createDataFrame(rows, "ymcode STRING, ts TIMESTAMP, strike INT, iv DOUBLE")
    got = {r.strike: r.iv for r in O.iv_surface(df).collect()}
    assert got[80] is None and got[95] == pytest.approx(0.25) and got[120] == pytest.approx(0.4 + 0.5 * 10 / 2390)
    assert got[1500] == pytest.approx(0.4 + 0.5 * 1390 / 2390)


def test_best_round_waits():
    errors = [5.0, 4.0, 4.5, 4.4, 3.0, 3.1, 3.2, 3.3, 2.0]
    assert L.best_round(errors, 3) == (4, True)  # a poor round before better ones does not end it, three in a row do
    assert L.best_round(errors, 1) == (1, True) and L.best_round(errors, 4) == (8, False) and L.best_round([1.0], 1) == (0, False)


def test_fit_with_patience(spark, monkeypatch):
    """Rounds double until patience runs out, and the ensemble is cut at its best round."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import GBTRegressionModel

    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(Vectors.dense(*map(float, v)), float(v[0] + 0.1 * v[1])) for v in rng.normal(size=(300, 3))], ["features_vec", "y"]).coalesce(1).cache()
    real, asked = GBTRegressionModel.evaluateEachIteration, []
    curve = [9.0, 8.0, 8.5, 8.4] + [7.0 - 0.1 * k for k in range(30)] + [6.0] * 60

    def errors(model, valid, loss):
        asked.append(model.getNumTrees)
        assert len(real(model, valid, loss)) == model.getNumTrees
        return curve[: model.getNumTrees]

    monkeypatch.setattr(GBTRegressionModel, "evaluateEachIteration", errors)
    gbt = L._boosted("y", 100, 7, maxDepth=2)
    model, found = L.fit_with_patience(gbt, rows, rows, patience=3, max_iter=100)
    assert asked == [26, 52] and model.getNumTrees == 34 and len(found) == 52
    whole = gbt.copy({gbt.maxIter: 34}).fit(rows)
    got, want = ([r.prediction for r in m.transform(rows).collect()] for m in (model, whole))
    assert got == pytest.approx(want)
    few, _ = L.fit_with_patience(gbt, rows, rows, patience=3, max_iter=4)
    assert few.getNumTrees == 2


def test_boosted_classifier(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(*map(float, v), int(v[0] > 0.3)) for v in rng.normal(size=(300, 2))], "a DOUBLE, b DOUBLE, label INT")
    rate = lambda cut: L.train_boosted_classifier(df, "label", ["a", "b"], rounds=5, cut=cut).transform(df).agg({"prediction": "avg"}).first()[0]
    assert rate(0.5) == pytest.approx(df.agg({"label": "avg"}).first()[0], abs=0.03) and rate(0.05) >= rate(0.5) >= rate(0.97)
