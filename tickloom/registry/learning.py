"""Training data, models, evaluation, drift and run tracking."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import evaluation as V
from ..operators import joins as J
from ..operators import learning as L
from ..functions import scalars as S
from ..schemas import ENTITY, FEATURE_COLS
from ..sources.tables import append_or_create
from .base import E_, new_database, query

query(
    "ordered_split",
    f"select {E_}, asof_ts, case when row_number() over (order by asof_ts, {E_}) <= "
    "floor((select count(*) from {training_v}) * 0.8) then 'train' else 'valid' end part from {training_v}",
)(lambda s: L.ordered_split(s.training).select(*ENTITY, "asof_ts", "part"))

query(
    "random_split",
    "select l_orderkey, l_linenumber, case when cast('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|42'), 1, 8) "
    "as bigint) / 4294967296.0 < 0.8 then 'train' else 'valid' end part from lineitem",
)(
    lambda s: L.random_split(s.table("lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
)

_FOLDS = (
    "(select f::integer fold, lo + (f * 3)::integer train_start, lo + (f * 3 + 14)::integer train_end, "
    "lo + (f * 3 + 14)::integer val_start, least(lo + (f * 3 + 17)::integer, hi + 1) val_end "
    "from (select min(trade_date) lo, max(trade_date) hi from {training_v}) d, "
    "lateral (select unnest(range((hi - lo - 14) // 3 + 1)) f))"
)
query("walk_forward_folds", f"select * from {_FOLDS}")(
    lambda s: L.walk_forward_folds(s.training, "trade_date", 14, 3, 3)
)
query(
    "assign_folds",
    f"select {E_}, asof_ts, trade_date, fold, case when trade_date < train_end then 'train' else 'valid' end part "
    f"from {{training_v}} join {_FOLDS} on trade_date >= train_start and trade_date < val_end",
)(
    lambda s: J.assign_folds(
        s.training.select(*ENTITY, "asof_ts", "trade_date"),
        L.walk_forward_folds(s.training, "trade_date", 14, 3, 3),
        "trade_date",
    )
)
query(
    "regime_labels",
    "select *, case when days_to_expiry <= 7 then 'near' when days_to_expiry <= 30 then 'mid' else 'far' end expiry_bucket "
    "from (select ymcode, trade_date, volatility, cast(ntile(3) over (partition by ymcode order by volatility, trade_date) "
    "as integer) vol_tercile, cast(date '2024-01-31' - trade_date as integer) days_to_expiry from (select ymcode, "
    "trade_date, avg(f_vol_20) volatility from {features_v} group by 1, 2))",
    "volatility",
)(lambda s: L.regime_labels(s.features, s.codes))

query(
    "make_sequences",
    f"select {E_}, bar_ts, cast(len(q) as integer) seq_len, q[1] seq_first, q[60] seq_last, list_sum(q) seq_sum, c target "
    f"from (select *, list(c) over (partition by {E_} order by bar_ts rows between 60 preceding and 1 preceding) q "
    "from {bars_v}) where len(q) = 60",
    "seq_first seq_last seq_sum target",
)(
    lambda s: L.make_sequences(s.bars, 60, bar_s=3600).select(
        *ENTITY,
        "bar_ts",
        F.size("sequence").alias("seq_len"),
        F.element_at("sequence", 1).alias("seq_first"),
        F.element_at("sequence", 60).alias("seq_last"),
        F.aggregate("sequence", F.lit(0.0), lambda a, x: a + x).alias("seq_sum"),
        "target",
    )
)

query(
    "rmse", "select sqrt(avg(pow(pred - y_fwd_ret_5, 2))) rmse from {scored_v}", "rmse"
)(lambda s: V.rmse(s.scored, "pred", "y_fwd_ret_5"))
query(
    "regression_metrics",
    "select *, 1 - mse / v r2 from (select count(*) n, avg(pow(e, 2)) mse, sqrt(avg(pow(e, 2))) rmse, avg(abs(e)) mae, "
    "var_pop(y_fwd_ret_5) v from (select pred - y_fwd_ret_5 e, y_fwd_ret_5 from {scored_v}))".replace("select *,", "select n, mse, rmse, mae,"),
    "mse rmse mae r2",
)(lambda s: V.regression_metrics(s.scored, "pred", "y_fwd_ret_5"))
query(
    "classification_metrics",
    "select *, (tp + tn) / (tp + fp + fn + tn) accuracy, tp / nullif(tp + fp, 0) \"precision\", tp / nullif(tp + fn, 0) "
    "recall, 2 * tp / nullif(2 * tp + fp + fn, 0) f1 from (select count(*) filter (label = 1 and prediction = 1) tp, "
    "count(*) filter (label = 0 and prediction = 1) fp, count(*) filter (label = 1 and prediction = 0) fn, "
    "count(*) filter (label = 0 and prediction = 0) tn from {binary_v})",
    "accuracy precision recall f1",
)(lambda s: V.classification_metrics(s.binary))
query(
    "confusion_matrix",
    "select cast(a as integer) label, cast(b as integer) prediction, count(c.label) n from (select unnest(range(10)) a) x "
    "cross join (select unnest(range(10)) b) y left join {classes_v} c on c.label = a and c.prediction = b group by 1, 2",
)(lambda s: V.confusion_matrix(s.classes))
query("log_loss", "select -avg(ln(greatest(p_true, 1e-15))) log_loss from {classes_v}", "log_loss")(
    lambda s: V.log_loss(s.classes)
)
query(
    "weighted_class_metrics",
    "with c as (select cls, sum(sup) sup, sum(prd) prd, sum(tp) tp from (select label cls, 1 sup, 0 prd, case when label = "
    "prediction then 1 else 0 end tp from {classes_v} union all select prediction, 0, 1, 0 from {classes_v}) group by 1) "
    "select sum(tp) / sum(sup) accuracy, sum(sup * coalesce(tp / nullif(prd, 0), 0)) / sum(sup) \"precision\", "
    "sum(sup * coalesce(tp / nullif(sup, 0), 0)) / sum(sup) recall, sum(sup * coalesce(2 * tp / nullif(sup + prd, 0), 0)) "
    "/ sum(sup) f1 from c",
    "accuracy precision recall f1",
)(lambda s: V.weighted_class_metrics(s.classes))

_ROC = (
    "(select score, pos, neg, sum(pos) over (order by score desc) tp, sum(neg) over (order by score desc) fp, "
    "sum(pos) over () ap, sum(neg) over () an from (select score, sum(label) pos, count(*) - sum(label) neg "
    "from {binary_v} group by 1))"
)
query("roc_curve", f"select score threshold, tp / ap tpr, fp / an fpr from {_ROC}", "threshold tpr fpr")(
    lambda s: V.roc_curve(s.binary)
)
query("auc", f"select sum(neg * (tp - pos / 2)) / (max(ap) * max(an)) auc from {_ROC}", "auc")(lambda s: V.auc(s.binary))

CUT = "2024-01-20"
_PSI = " union all ".join(
    f"select '{c}' feature, {c} \"value\", trade_date >= date '{CUT}' cur from {{features_v}} where {c} is not null"
    for c in FEATURE_COLS
)
query(
    "feature_drift_psi",
    f"with lg as materialized ({_PSI}), ed as (select feature, quantile_cont(\"value\", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, "
    "0.8, 0.9]) e from lg where not cur group by 1), ct as (select feature, bin, count(*) filter (not cur) b, count(*) "
    "filter (cur) c from (select lg.feature, cur, len(list_filter(e, lambda x: \"value\" > x)) bin from lg join ed using "
    "(feature)) group by 1, 2), tt as (select feature, sum(b) tb, sum(c) tc from ct group by 1), sh as (select g.feature, "
    "greatest(coalesce(b, 0) / tb, 1e-6) p, greatest(coalesce(c, 0) / tc, 1e-6) q from (select feature, unnest(range(10)) "
    "bin from ed) g left join ct on g.feature = ct.feature and g.bin = ct.bin join tt on tt.feature = g.feature) "
    "select feature, sum((p - q) * ln(p / q)) psi from sh group by 1",
    "psi",
)(
    lambda s: V.feature_drift_psi(
        s.features.where(f"trade_date < date '{CUT}'"), s.features.where(f"trade_date >= date '{CUT}'"), FEATURE_COLS
    )
)

_REQ = (
    "'options:' || ymcode || ':' || side || ':' || code || ':' || strike || ':' || "
    "strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"
)
query(
    "batch_score",
    "select r.k feature_key, f.k is not null ok, pred, case when f.k is null then null when pred > 0.001 then 'BUY' "
    "when pred < -0.001 then 'SELL' else 'HOLD' end decision, case when f.k is null then 'no_features_in_cache' end reason "
    "from (select "
    + _REQ.format(ts="case when hour(asof_ts) % 2 = 1 then asof_ts + interval 30 minute else asof_ts end")
    + " k from {features_v}) r left join (select "
    + _REQ.format(ts="asof_ts")
    + " k, (f_ret_5 - f_ret_1) / 1000.0 pred from {features_v}) f on r.k = f.k",
    "pred",
)(lambda s: L.batch_score(_requests(s), _keyed(s), L.linear_score((F.col("f_ret_5") - F.col("f_ret_1")) / 1000.0)))


def _keyed(s):
    return s.features.withColumn("feature_key", S.feature_key("asof_ts"))


def _requests(s):
    """Every feature key, those of odd hours shifted to a time without features."""
    late = F.when(F.hour("asof_ts") % 2 == 1, F.expr("asof_ts + interval 30 minutes")).otherwise(F.col("asof_ts"))
    return s.features.withColumn("asof_ts", late).select(S.feature_key("asof_ts").alias("feature_key"))


@query("train_regressor")
def _regressor(s):
    """Predictions of the fitted trees for the validation rows."""
    model = L.train_regressor(s.training)
    valid = L.ordered_split(s.training).where("part = 'valid'")
    return model.transform(valid).select(*ENTITY, "asof_ts", "y_fwd_ret_5", "prediction")


@query("random_search")
def _search(s):
    trials, _ = L.random_search(s.training)
    return trials


@query("train_classifier")
def _classifier(s):
    """Hold-out metrics of the forest on the seeded random split."""
    rows = L.random_split(s.training.withColumn("label", (F.col("y_fwd_ret_5") > 0).cast("int")), [*ENTITY, "asof_ts"])
    model = L.train_classifier(rows.where("part = 'train'"), "label", FEATURE_COLS)
    held_out = model.transform(rows.where("part = 'valid'"))
    return V.classification_metrics(held_out.withColumn("prediction", F.col("prediction").cast("int")))


@query("train_classifier_boosted")
def _boosted_classifier(s):
    """Hold-out metrics of the boosted trees, cut at 0.5, on the same split as the forest's."""
    rows = L.random_split(s.training.withColumn("label", (F.col("y_fwd_ret_5") > 0).cast("int")), [*ENTITY, "asof_ts"])
    model = L.train_boosted_classifier(rows.where("part = 'train'"), "label", FEATURE_COLS, rounds=20)
    held_out = model.transform(rows.where("part = 'valid'"))
    return V.classification_metrics(held_out.withColumn("prediction", F.col("prediction").cast("int")))


@query("batch_score_model")
def _score(s):
    model = L.train_regressor(s.training)
    return L.batch_score(_requests(s), _keyed(s).dropna(subset=FEATURE_COLS), L.score_with(model))


_RUNS = (
    "(select code run_name, sqrt(avg(pow(pred - y_fwd_ret_5, 2))) rmse, avg(((pred > 0) = (y_fwd_ret_5 > 0))::integer) "
    "accuracy, avg(sign(pred) * ret) / nullif(stddev_samp(sign(pred) * ret), 0) * sqrt(252.0) sharpe, -min(sign(pred) * ret) "
    "drawdown, max(asof_ts) logged_at from {scored_v} group by 1)"
)
_KEYS = ["rmse", "accuracy", "sharpe", "drawdown"]
@query(
    "log_metrics",
    "select 'run-7' run_id, 'fixed' run_name, 'gold' layer, unnest(['n', 'rmse']) \"key\", unnest([count(*), "
    "sqrt(avg(pow(pred - y_fwd_ret_5, 2)))]) \"value\", 3 step, timestamp '2024-02-01 09:30:00' logged_at from {scored_v}",
    "value",
)
def _logged(s):
    """Figures of the fixed score, appended to the metrics table and read back."""
    row = V.regression_metrics(s.scored, "pred", "y_fwd_ret_5").first()
    at = dt.datetime(2024, 2, 1, 9, 30, tzinfo=dt.timezone.utc)
    rows = V.log_metrics(s.spark, "run-7", "fixed", "gold", {"n": row.n, "rmse": row.rmse}, 3, at)
    table = f"{new_database(s)}.metrics"
    append_or_create(rows, table)
    return s.spark.table(table)


query(
    "run_summary",
    " union all ".join(
        f"select 'run-' || run_name run_id, run_name, 'gold' layer, '{k}' \"key\", {k} \"value\", 0 step, logged_at from {_RUNS}"
        for k in _KEYS
    ),
    "value",
)(lambda s: s.runs)
query(
    "latest_run",
    f"select 'run-' || run_name run_id, run_name, logged_at from {_RUNS} where run_name = 'click'",
)(lambda s: V.latest_run(s.runs, "click"))
query(
    "compare_runs",
    " union all ".join(
        f"select '{k}' \"key\", a.{k} a, b.{k} b, b.{k} - a.{k} difference from {_RUNS} a, {_RUNS} b where a.run_name = "
        "'click' and b.run_name = 'view'"
        for k in _KEYS
    ),
    "a b difference",
)(lambda s: V.compare_runs(s.runs, "run-click", "run-view"))
query(
    "promote",
    "select 'run-' || run_name run_id, sharpe metric, cast(row_number() over (order by sharpe desc, run_name) as integer) "
    "\"rank\", case when row_number() over (order by sharpe desc, run_name) = 1 then 'Production' else 'Staging' end stage "
    f"from {_RUNS} where sharpe > -10 and drawdown < 0.2 and accuracy > 0.1 order by sharpe desc, run_name limit 3",
    "metric",
)(
    lambda s: V.promote(
        s.runs, {"sharpe": (">", -10.0), "drawdown": ("<", 0.2), "accuracy": (">", 0.1)}, "sharpe", 3
    )
)
query(
    "epoch_curves",
    "select cast(trade_date - date '2024-01-01' as integer) step, sqrt(avg(pow(pred - y_fwd_ret_5, 2))) rmse, avg(ret) "
    "mean_ret from {scored_v} where code = 'click' group by 1",
    "rmse mean_ret",
)(lambda s: V.epoch_curves(_daily_runs(s), "run-click", ["rmse", "mean_ret"]))


def _daily_runs(s):
    """Metrics logged once per day and code: the day number is the step."""
    daily = s.scored.groupBy(
        F.concat(F.lit("run-"), "code").alias("run_id"),
        F.datediff("trade_date", F.lit("2024-01-01").cast("date")).alias("step"),
    ).agg(F.sqrt(F.avg(F.pow(F.col("pred") - F.col("y_fwd_ret_5"), 2))).alias("rmse"), F.avg("ret").alias("mean_ret"))
    return daily.unpivot(["run_id", "step"], ["rmse", "mean_ret"], "key", "value")


_TEXT = {
    "VARCHAR": "{c}", "BIGINT": "{c}::varchar", "DATE": "strftime({c}, '%Y-%m-%d')", "TIMESTAMP": "epoch_us({c})::varchar",
    "DOUBLE": "(floor({c} * 1e6 + 0.5))::bigint::varchar",
}
_KINDS = {**dict.fromkeys(FEATURE_COLS, "DOUBLE"), "y_fwd_ret_5": "DOUBLE", "asof_ts": "TIMESTAMP", "trade_date": "DATE",
          "ymcode": "VARCHAR", "side": "VARCHAR", "code": "VARCHAR", "strike": "BIGINT"}
_ROW = " || chr(31) || ".join(f"coalesce({_TEXT[k].format(c=c)}, '~')" for c, k in sorted(_KINDS.items()))
_LANES = " || '-' || ".join(f"format('{{:08x}}', (sum(('0x' || substr(h, {8 * i + 1}, 8))::bigint) % 4294967296)::bigint)" for i in range(4))
query(
    "dataset_fingerprint",
    f"select count(*) as rows, {_LANES} || '-' || count(*) data_snapshot_id, sha256('{','.join(FEATURE_COLS)}') feature_hash from "
    f"(select md5({_ROW}) h from {{training_v}})",
)(lambda s: V.dataset_fingerprint(s.training, FEATURE_COLS))
