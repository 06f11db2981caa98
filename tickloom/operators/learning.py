"""Splits, folds, sequences and MLlib model jobs."""
from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import decide
from ..session import materialise
from ..plans.segments import MINUTE_US, Slices, epoch_us, over_rows, positions
from .features import bar_segment
from ..schemas import ENTITY, FEATURE_COLS


def ordered_split(df: DataFrame, fraction: float = 0.8, ts: str = "asof_ts") -> DataFrame:
    """Adds `part`: `train` for the first rows in time order (ties by entity), `valid` for the rest.

    Rows are numbered per time slice and offset by the slices before, so there is no global sort in one task.
    """
    numbered = positions(df, [], [ts, *ENTITY], Slices(epoch_us(ts), slot=MINUTE_US))
    train = F.col("_pos") < F.floor(F.col("_total") * F.lit(fraction))
    return numbered.withColumn("part", F.when(train, "train").otherwise("valid")).drop("_key", "_pos", "_total")


def random_split(df: DataFrame, keys: Sequence[str], fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds `part` from a hash of the row key: the same on every run and cluster, unlike a sampled split."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / float(2**32)
    return df.withColumn("part", F.when(draw < fraction, "train").otherwise("valid"))


def walk_forward_folds(dates: DataFrame, date_col: str, train_days: int, val_days: int, step_days: int) -> DataFrame:
    """Rolling folds over the date range: [train_start, train_end) then [val_start, val_end), the last one cut short."""
    span = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))  # one row
    last = F.floor((F.datediff("hi", "lo") - train_days) / step_days).cast("int")
    fold = F.explode(F.sequence(F.lit(0), last)).alias("fold")
    folds = span.where(F.datediff("hi", "lo") >= train_days).select("lo", "hi", fold)
    start = F.date_add("lo", F.col("fold") * step_days)
    mid = F.date_add("lo", F.col("fold") * step_days + train_days)
    end = F.date_add("lo", F.col("fold") * step_days + train_days + val_days)
    return folds.select(
        "fold",
        start.alias("train_start"),
        mid.alias("train_end"),
        mid.alias("val_start"),
        F.least(end, F.date_add("hi", 1)).alias("val_end"),
    )


def regime_labels(features: DataFrame, codes: DataFrame) -> DataFrame:
    """Per contract month and day: tercile of the mean volatility, and days to expiry in three buckets.

    The ranking runs over one row per day of a contract month. A month without a code row has no expiry.
    """
    daily = features.groupBy("ymcode", "trade_date").agg(F.avg("f_vol_20").alias("volatility"))
    expiry = codes.groupBy("ymcode").agg(F.to_date(F.max("lastday").cast("string"), "yyyyMMdd").alias("lastday"))
    tercile = F.ntile(3).over(Window.partitionBy("ymcode").orderBy("volatility", "trade_date"))
    dte = F.datediff("lastday", "trade_date")
    return (
        daily.where("volatility is not null")
        .withColumn("vol_tercile", tercile)
        .join(expiry, "ymcode", "left")
        .select(
            "ymcode",
            "trade_date",
            "volatility",
            "vol_tercile",
            dte.alias("days_to_expiry"),
            F.when(dte <= 7, "near").when(dte <= 30, "mid").when(dte.isNotNull(), "far").alias("expiry_bucket"),
        )
    )


def make_sequences(bars: DataFrame, n: int = 60, col: str = "c", bar_s: int = 60) -> DataFrame:
    """Samples of n consecutive values and the value that follows them, per entity in time order."""

    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn("sequence", F.collect_list(col).over(w.rowsBetween(-n, -1)))

    rows = bars.select(*ENTITY, "bar_ts", col)
    out = over_rows(rows, ENTITY, ["bar_ts"], compute, segment=bar_segment(bar_s, n), before=n)
    return out.where(F.size("sequence") == n).select(*ENTITY, "bar_ts", "sequence", F.col(col).alias("target"))


def _assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features_vec", handleInvalid="skip")


# Rounds at most, and rounds without a better validation error that end a fit.
MAX_ROUNDS = 2000
PATIENCE = 50


def _boosted(y: str, max_iter: int, seed: int, **params) -> GBTRegressor:
    """Boosted trees. Returns are small numbers, so a round must lower the validation error by a small share only."""
    return GBTRegressor(
        featuresCol="features_vec", labelCol=y, predictionCol="prediction", maxIter=max_iter, seed=seed, validationTol=1e-3, **params
    )


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round with the least error before `patience` rounds in a row brought none, and whether they did."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of a model's first `rounds` trees."""
    jvm, gateway = SparkSession.active()._jvm, SparkContext._active_spark_context._gateway
    whole, kinds = model._java_obj, jvm.org.apache.spark.ml.regression
    trees, weights = gateway.new_array(kinds.DecisionTreeRegressionModel, rounds), gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = whole.trees()[i], whole.treeWeights()[i]
    cut = GBTRegressionModel(kinds.GBTRegressionModel(model.uid, trees, weights, whole.numFeatures()))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_with_patience(
    gbt: GBTRegressor, rows: DataFrame, valid: DataFrame, patience: int = PATIENCE, max_iter: int = MAX_ROUNDS
) -> tuple[GBTRegressionModel, list[float]]:
    """The ensemble up to its best round on `valid`, and the error after each round that was fitted.

    MLlib ends a fit at the first poor round, so rounds are fitted without that rule, the error of the ensemble after each of
    them is taken, and while patience has not run out the fit is repeated with twice the rounds; the same seed gives the same
    first trees. Without validation rows all errors are missing and one round stays.
    """
    rounds = min(max_iter, 2 * patience + 20)
    while True:
        model = gbt.copy({gbt.maxIter: rounds}).fit(rows)
        errors = list(model.evaluateEachIteration(valid, "squared"))
        best, ended = best_round(errors, patience)
        if ended or rounds >= max_iter:
            return first_rounds(model, best + 1), errors
        rounds = min(max_iter, 2 * rounds)


def train_regressor(
    training: DataFrame,
    y: str = "y_fwd_ret_5",
    cols: Sequence[str] = FEATURE_COLS,
    max_iter: int = MAX_ROUNDS,
    seed: int = 42,
    patience: int = PATIENCE,
    **params,
) -> PipelineModel:
    """Boosted regression trees on the ordered split, cut at the round after which `patience` rounds bring nothing better.

    The split is stored as vectors once, since every round reads it.
    """
    assembler = _assembler(cols)
    split = assembler.transform(ordered_split(training)).select("features_vec", y, (F.col("part") == "valid").alias("is_valid"))
    rows = materialise(split, "regressor-rows", ["is_valid"])
    model, _ = fit_with_patience(_boosted(y, max_iter, seed, **params), rows.where("not is_valid"), rows.where("is_valid"), patience, max_iter)
    return PipelineModel(stages=[assembler, model])


def random_search(
    training: DataFrame,
    n_trials: int = 20,
    y: str = "y_fwd_ret_5",
    cols: Sequence[str] = FEATURE_COLS,
    max_iter: int = MAX_ROUNDS,
    seed: int = 42,
    parallelism: int = 4,
    patience: int | None = None,
) -> tuple[DataFrame, PipelineModel]:
    """Trials with sampled parameters scored by RMSE on the validation part, and the best one refitted on all rows.

    Learning rate is drawn log-uniformly from 0.001 to 0.2. Each trial is a distributed fit that stops when the validation
    rows stop improving: by MLlib's rule, at the first round that improves too little, or with `patience` as in
    `train_regressor`, which takes many more rounds, hundreds at small learning rates. The refit takes the rounds of the best
    trial. `parallelism` trials share the cluster.
    """
    spark = training.sparkSession
    rng = random.Random(seed)
    draws = [
        {
            "stepSize": 10 ** rng.uniform(-3, math.log10(0.2)),
            "maxDepth": rng.randint(4, 8),
            "minInstancesPerNode": rng.randint(10, 200),
            "featureSubsetStrategy": str(round(rng.uniform(0.5, 1.0), 2)),
            "subsamplingRate": rng.uniform(0.5, 1.0),
        }
        for _ in range(n_trials)
    ]
    split = ordered_split(training).withColumn("is_valid", F.col("part") == "valid")
    rows = materialise(_assembler(cols).transform(split).select("features_vec", y, "is_valid"), "search-rows")
    valid = rows.where("is_valid")
    gbt = _boosted(y, max_iter, seed).setValidationIndicatorCol("is_valid")
    score = RegressionEvaluator(labelCol=y, metricName="rmse")

    def trial(i: int) -> tuple:
        drawn = gbt.copy({gbt.getParam(k): v for k, v in draws[i].items()})
        if patience is None:
            fitted = drawn.fit(rows)
        else:
            drawn.clear(drawn.validationIndicatorCol)
            fitted, _ = fit_with_patience(drawn, rows.where("not is_valid"), valid, patience, max_iter)
        return (i, float(score.evaluate(fitted.transform(valid))), *draws[i].values(), fitted.getNumTrees)

    with ThreadPool(min(parallelism, n_trials)) as pool:
        results = pool.map(trial, range(n_trials))
    best = min(results, key=lambda r: r[1])
    final = _boosted(y, best[-1], seed, **draws[best[0]])
    model = Pipeline(stages=[_assembler(cols), final]).fit(training)
    schema = (
        "trial INT, rmse DOUBLE, step_size DOUBLE, max_depth INT, min_instances INT, feature_subset STRING, "
        "row_fraction DOUBLE, rounds INT"
    )
    return spark.createDataFrame(results, schema), model


def train_classifier(
    df: DataFrame, label: str, cols: Sequence[str], trees: int = 100, depth: int = 10, seed: int = 42
) -> PipelineModel:
    """Random forest."""
    forest = RandomForestClassifier(
        featuresCol="features_vec", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[_assembler(cols), forest]).fit(df)


def train_boosted_classifier(
    df: DataFrame, label: str, cols: Sequence[str], rounds: int = 50, depth: int = 5, cut: float = 0.5, seed: int = 42
) -> PipelineModel:
    """Boosted trees for two classes; 1 is predicted where its probability is above `cut`."""
    boosted = GBTClassifier(
        featuresCol="features_vec", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=seed
    )
    return Pipeline(stages=[_assembler(cols), boosted.setThresholds([1 - cut, cut])]).fit(df)


def score_with(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """A scorer for `batch_score` from a fitted pipeline."""
    return lambda df: model.transform(df).withColumn("pred", F.col("prediction")).drop("features_vec", "prediction")


def linear_score(pred: Column) -> Callable[[DataFrame], DataFrame]:
    """A scorer for `batch_score` from a column expression."""
    return lambda df: df.withColumn("pred", pred)


def batch_score(requests: DataFrame, features: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Prediction and decision for each requested `feature_key`; keys without features are reported, not dropped."""
    scored = scorer(features).select("feature_key", "pred", F.lit(True).alias("_hit"))
    joined = requests.select("feature_key").join(scored, "feature_key", "left")
    ok = F.coalesce(F.col("_hit"), F.lit(False))
    return joined.select(
        "feature_key",
        ok.alias("ok"),
        "pred",
        F.when(ok, decide("pred")).alias("decision"),
        F.when(~ok, "no_features_in_cache").alias("reason"),
    )
