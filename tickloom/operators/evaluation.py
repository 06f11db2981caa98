"""Model evaluation, drift, run metrics and promotion."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.quantiles import column_quantiles, value_segment
from ..plans.segments import running
from ..schemas import ENTITY


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b)


def rmse(df: DataFrame, pred: str = "pred", y: str = "y") -> DataFrame:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(pred) - F.col(y), 2))).alias("rmse"))


def regression_metrics(df: DataFrame, pred: str = "pred", y: str = "y") -> DataFrame:
    """Mean squared, root mean squared and mean absolute error, and r squared; one aggregate."""
    err = F.col(pred) - F.col(y)
    one = df.agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(y).alias("_v"), F.count(y).alias("n")
    )
    return one.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae", (1.0 - F.try_divide("mse", "_v")).alias("r2"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of a two-class prediction; NULL where a denominator is zero."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    hit = lambda c: F.count(F.when(c, 1))
    one = df.agg(
        hit(y & p).alias("tp"), hit(~y & p).alias("fp"), hit(y & ~p).alias("fn"), hit(~y & ~p).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return one.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, n_classes: int = 10, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Count for every pair of true and predicted class, zeros included."""
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    classes = F.sequence(F.lit(0), F.lit(n_classes - 1))
    pairs = F.flatten(F.transform(classes, lambda a: F.transform(classes, lambda b: F.struct(a.alias(label), b.alias(pred)))))
    grid = df.sparkSession.range(1).select(F.inline(pairs))  # n_classes squared rows
    return grid.join(counts, [label, pred], "left").select(label, pred, F.coalesce("n", F.lit(0)).alias("n"))


def log_loss(df: DataFrame, p_true: str = "p_true", eps: float = 1e-15) -> DataFrame:
    """Mean cross-entropy of the probability given to the true class."""
    return df.agg((-F.avg(F.ln(F.greatest(F.col(p_true), F.lit(eps))))).alias("log_loss"))


def weighted_class_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 averaged over classes by the number of true rows."""
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))  # one row per pair of classes
    zero = F.lit(0).cast("long")
    hit = F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(zero)
    as_true = F.struct(F.col(label).alias("cls"), F.col("n").alias("sup"), zero.alias("prd"), hit.alias("tp"))
    as_pred = F.struct(F.col(pred).alias("cls"), zero.alias("sup"), F.col("n").alias("prd"), zero.alias("tp"))
    per = (
        counts.select(F.inline(F.array(as_true, as_pred)))
        .groupBy("cls")
        .agg(F.sum("sup").alias("sup"), F.sum("prd").alias("prd"), F.sum("tp").alias("tp"))
    )
    prec = F.coalesce(_ratio(F.col("tp"), F.col("prd")), F.lit(0.0))
    rec = F.coalesce(_ratio(F.col("tp"), F.col("sup")), F.lit(0.0))
    f1 = F.coalesce(_ratio(2 * F.col("tp"), F.col("sup") + F.col("prd")), F.lit(0.0))
    mean = lambda v: F.try_divide(F.sum(v * F.col("sup")), F.sum("sup"))
    return per.agg(
        _ratio(F.sum("tp"), F.sum("sup")).alias("accuracy"),
        mean(prec).alias("precision"),
        mean(rec).alias("recall"),
        mean(f1).alias("f1"),
    )


def _roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows and positives per score, and their sums from the highest score down."""
    counts = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("_n"))
        .withColumn("neg", F.col("_n") - F.col("pos"))
    )
    summed = running(
        counts,
        [],
        [-F.col("score")],
        -value_segment(F.col("score")),
        {
            "tp": ("sum", F.col("pos")),
            "fp": ("sum", F.col("neg")),
            "all_pos": ("total", F.col("pos")),
            "all_neg": ("total", F.col("neg")),
        },
    )
    return summed


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """True and false positive rate when everything at or above a score counts as positive."""
    return _roc_points(df, label, score).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
        _ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
    )


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid area under the curve; each score adds its own strip, so no row needs its neighbour."""
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return _roc_points(df, label, score).agg(
        F.try_divide(F.sum(strip), F.max("all_pos") * F.max("all_neg").cast("double")).alias("auc")
    )


def feature_drift_psi(
    baseline: DataFrame, current: DataFrame, cols: Sequence[str], bins: int = 10, floor: float = 1e-6
) -> DataFrame:
    """Population stability index per feature over baseline quantile bins, shares floored.

    The edges are a few numbers per feature and stand in the plan; one aggregate then counts, for all features at once, the
    values above each edge. Features without baseline values have no row.
    """
    found = column_quantiles(baseline, cols, [i / bins for i in range(1, bins)])
    edges = {c: e for c, e in found.items() if e[0] is not None}
    schema = "feature STRING, psi DOUBLE"
    if not edges:
        return baseline.sparkSession.createDataFrame([], schema)

    value = lambda c: F.col(f"`{c}`").cast("double")
    above = [F.array(F.count(value(c)), *[F.count(F.when(value(c) > e, 1)) for e in edges[c]], F.lit(0)) for c in edges]
    both = baseline.select(*edges, F.lit(0).alias("_cur")).unionByName(current.select(*edges, F.lit(1).alias("_cur")))
    counts = both.groupBy("_cur").agg(*[n.alias(f"_n{i}") for i, n in enumerate(above)])  # two rows
    each = counts.select("_cur", F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_n{i}").alias("n")) for i, c in enumerate(edges)])))
    sides = each.groupBy("feature").agg(*[F.max(F.when(F.col("_cur") == cur, F.col("n"))).alias(f"_n{cur}") for cur in (0, 1)])

    def share(n: Column, k: Column) -> Column:
        return F.greatest(F.coalesce(_ratio(F.get(n, k) - F.get(n, k + 1), F.get(n, F.lit(0))), F.lit(0.0)), F.lit(floor))

    shares = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda k: F.struct(share(F.col("_n0"), k).alias("p"), share(F.col("_n1"), k).alias("q")))
    psi = F.aggregate(shares, F.lit(0.0), lambda total, x: total + (x.p - x.q) * F.ln(x.p / x.q))
    return sides.select("feature", psi.alias("psi"))


def row_text(df: DataFrame, places: int = 6) -> Column:
    """A row as text that any engine can repeat: columns by name, parted by the character 31, `~` for NULL.

    Floating numbers are counts of 10^-places, rounded half up (from 10^12 on in scientific form with nine places); instants
    are microseconds since 1970; nested values are JSON; everything else is its plain text.
    """
    texts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("double", "float"):
            x = c.cast("double")
            scaled = F.floor(x * float(10**places) + 0.5).cast("string")
            text = F.when(F.isnan(x), "nan").when(F.abs(x) < 1e12, scaled).otherwise(F.lower(F.format_string("%.9e", x)))
        elif kind in ("timestamp", "timestamp_ntz"):
            text = F.unix_micros(c.cast("timestamp")).cast("string")
        elif kind in ("array", "map", "struct"):
            text = F.to_json(F.struct(c))
        else:
            text = c.cast("string")
        texts.append(F.coalesce(text, F.lit("~")))
    return F.concat_ws("\x1f", *texts)


def dataset_fingerprint(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """Row count, an order-independent hash of the rows, and a hash of the feature list.

    Each row's MD5 is cut into four numbers of 32 bits, which are added up over the rows modulo 2^32. Sums see repeated rows,
    need no order, and are reduced in every task.
    """
    digest = F.md5(row_text(df).cast("binary"))
    lanes = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)").alias(f"_{i}") for i in range(4)]
    one = df.select(*lanes).agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(4)])
    parts = [F.format_string("%08x", F.pmod(F.col(f"_{i}"), F.lit(2**32)).cast("long")) for i in range(4)]
    return one.select(
        "rows", F.concat_ws("-", *parts, "rows").alias("data_snapshot_id"), F.sha2(F.lit(",".join(feature_cols)), 256).alias("feature_hash")
    )


def run_summary(scored: DataFrame) -> DataFrame:
    """Run metrics of the fixed score, one run per instrument code, in the long form of the metrics table."""
    err = F.pow(F.col("pred") - F.col("y_fwd_ret_5"), 2)
    ret = F.signum("pred") * F.col("ret")
    per = scored.groupBy(F.col("code").alias("run_name")).agg(
        F.sqrt(F.avg(err)).alias("rmse"),
        F.avg(((F.col("pred") > 0) == (F.col("y_fwd_ret_5") > 0)).cast("double")).alias("accuracy"),
        (F.try_divide(F.avg(ret), F.stddev_samp(ret)) * F.sqrt(F.lit(252.0))).alias("sharpe"),
        (-F.min(ret)).alias("drawdown"),
        F.max("asof_ts").alias("logged_at"),
    )
    keys = ["rmse", "accuracy", "sharpe", "drawdown"]
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys])
    return per.select(
        F.concat(F.lit("run-"), "run_name").alias("run_id"),
        "run_name",
        F.lit("gold").alias("layer"),
        F.inline(pairs),
        F.lit(0).alias("step"),
        "logged_at",
    ).select("run_id", "run_name", "layer", "key", "value", "step", "logged_at")


def log_metrics(
    spark: SparkSession,
    run_id: str,
    run_name: str,
    layer: str,
    values: dict[str, float],
    step: int = 0,
    logged_at: dt.datetime | None = None,
) -> DataFrame:
    """Rows of the metrics table for one run; append them with `sources.tables.append`."""
    stamp = logged_at or dt.datetime.now(dt.timezone.utc)
    rows = [(run_id, run_name, layer, k, float(v), step, stamp) for k, v in values.items()]
    return spark.createDataFrame(
        rows, "run_id STRING, run_name STRING, layer STRING, key STRING, value DOUBLE, step INT, logged_at TIMESTAMP"
    )


def epoch_curves(metrics: DataFrame, run_id: str, keys: Sequence[str]) -> DataFrame:
    """One row per step with a column per metric."""
    return metrics.where(F.col("run_id") == run_id).groupBy("step").pivot("key", list(keys)).agg(F.max("value"))


def latest_run(metrics: DataFrame, experiment: str) -> DataFrame:
    """Newest run of an experiment (run name); empty when there is none."""
    return (
        metrics.where(F.col("run_name") == experiment)
        .groupBy("run_id", "run_name")
        .agg(F.max("logged_at").alias("logged_at"))
        .orderBy(F.desc("logged_at"), F.desc("run_id"))
        .limit(1)
    )


def compare_runs(metrics: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """Metrics of two runs side by side with their difference; the latest step counts."""
    pick = lambda r: F.max_by(F.when(F.col("run_id") == r, F.col("value")), F.when(F.col("run_id") == r, F.col("step")))
    return (
        metrics.where(F.col("run_id").isin(run_a, run_b))
        .groupBy("key")
        .agg(pick(run_a).alias("a"), pick(run_b).alias("b"))
        .withColumn("difference", F.col("b") - F.col("a"))
    )


def promote(
    metrics: DataFrame, gates: dict[str, tuple[str, float]], rank_by: str, top_n: int = 3, descending: bool = True
) -> DataFrame:
    """The best runs that pass every gate (metric -> ('>' or '<', limit)); the first goes to Production."""
    names = sorted({*gates, rank_by})
    wide = metrics.where(F.col("key").isin(names)).groupBy("run_id").pivot("key", names).agg(F.max_by("value", "step"))
    for name, (op, limit) in gates.items():
        wide = wide.where(F.col(name) > limit if op == ">" else F.col(name) < limit)
    order = [F.col(rank_by).desc() if descending else F.col(rank_by).asc(), F.col("run_id")]
    best = wide.orderBy(*order).limit(top_n)  # top_n rows remain for the ranking below
    rank = F.row_number().over(Window.orderBy(*order))
    return best.select("run_id", F.col(rank_by).alias("metric"), rank.alias("rank")).withColumn(
        "stage", F.when(F.col("rank") == 1, "Production").otherwise("Staging")
    )
