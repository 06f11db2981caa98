"""Strategy returns and risk figures.

Input rows hold (entity, ts, position, ret). A portfolio has one row per ts, the mean over entities, so everything
cumulative runs on a series as long as the number of bars and is still cut into days, by `scanned`.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..plans.quantiles import column_quantiles
from ..plans.segments import DAY, Scan, over_rows, scanned, time_segment
from ..schemas import ENTITY


def positions_from(scored: DataFrame, pred: str = "pred", limit: float = 0.001) -> DataFrame:
    """Long, short or flat from a prediction, with the realised return."""
    pos = F.when(F.col(pred) > limit, 1).when(F.col(pred) < -limit, -1).otherwise(0)
    return scored.select(*ENTITY, F.col("asof_ts").alias("ts"), pos.alias("position"), "ret")


def _with_change(pnl: DataFrame) -> DataFrame:
    def compute(rows: DataFrame, w: WindowSpec) -> DataFrame:
        prev = F.coalesce(F.lag("position").over(w), F.lit(0))
        return rows.withColumn("change", F.abs(F.col("position") - prev))

    return over_rows(pnl, ENTITY, ["ts"], compute, segment=time_segment("ts", 30 * DAY), before=1)


def strategy_returns(pnl: DataFrame, cost: float = 0.0005) -> DataFrame:
    """position * ret - cost * |change of position|; the first position counts as a change from flat."""
    net = F.col("position") * F.col("ret") - F.lit(cost) * F.col("change")
    return _with_change(pnl).select(*ENTITY, "ts", "position", net.alias("strat_ret"))


def portfolio(returns: DataFrame) -> DataFrame:
    """Mean strategy return and mean absolute position per time."""
    return returns.groupBy("ts").agg(
        F.avg("strat_ret").alias("r"), F.avg(F.abs("position")).cast("double").alias("exposure")
    )


def sharpe(port: DataFrame, periods: int = 252) -> DataFrame:
    ratio = F.try_divide(F.avg("r"), F.stddev_samp("r")) * F.sqrt(F.lit(float(periods)))
    return port.agg(ratio.alias("sharpe"))


def _plus(own: Column, carried: Column) -> Column:
    """The sum of what is known; NULL while nothing is."""
    return F.when(own.isNotNull() | carried.isNotNull(), F.coalesce(own, F.lit(0.0)) + F.coalesce(carried, F.lit(0.0)))


def _equity(port: DataFrame) -> Scan:
    """Log return and its peak within each day, and both as they stand at the day's start."""

    def local(rows: DataFrame, upto: WindowSpec) -> DataFrame:
        logs = rows.withColumn("_log", F.log1p("r"))
        return logs.withColumn("_sum", F.sum("_log").over(upto)).withColumn("_peak", F.max("_sum").over(upto))

    state = {
        "_all": F.sum("_log"), "_top": F.max("_sum"), "_low": F.min("_sum"), "_fall": F.max(F.col("_peak") - F.col("_sum")),
    }
    carry = [
        lambda earlier, upto: {"_before": F.sum("_all").over(earlier)},
        lambda earlier, upto: {"_peak_before": F.max(_plus(F.col("_top"), F.col("_before"))).over(earlier)},
    ]
    return scanned(port, [], ["ts"], time_segment("ts"), local, state, carry)


def equity_curve(port: DataFrame) -> DataFrame:
    """Running log return, its running maximum, and the drawdown below that maximum."""
    log = _plus(F.col("_sum"), F.col("_before"))
    peak = F.greatest(F.when(F.col("_peak").isNotNull(), _plus(F.col("_peak"), F.col("_before"))), F.col("_peak_before"))
    rows = _equity(port).joined({"cum_log": log, "peak_log": peak})
    return rows.select(
        "ts", F.exp("cum_log").alias("equity"), (1.0 - F.exp(F.col("cum_log") - F.col("peak_log"))).alias("drawdown")
    )


def max_drawdown(port: DataFrame) -> DataFrame:
    """The largest fall below an earlier peak, from one row per day: the fall within it, or from a peak before it to its low."""
    fall = F.greatest(F.col("_fall"), F.col("_peak_before") - _plus(F.col("_low"), F.col("_before")))
    return _equity(port).states.agg((1.0 - F.exp(-F.max(fall))).alias("max_drawdown"))


def cvar(port: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Mean of the returns at or below the alpha quantile, which is selected by rank first."""
    cut = F.lit(column_quantiles(port, ["r"], [alpha])["r"][0]).cast("double")
    tail = port.where(F.col("r") <= cut)
    return tail.agg(F.avg("r").alias("cvar"), F.count(F.lit(1)).alias("n")).select(cut.alias("var"), "cvar", "n")


def turnover(pnl: DataFrame) -> DataFrame:
    """Sum of absolute position changes per day."""
    return (
        _with_change(pnl).groupBy(F.to_date("ts").alias("day")).agg(F.sum("change").cast("long").alias("turnover"))
    )


def cost_sensitivity(
    pnl: DataFrame, costs: Sequence[float] = (0.0, 0.0005, 0.001, 0.002), periods: int = 252
) -> DataFrame:
    """Sharpe ratio for each cost; the cost enters the portfolio mean linearly, so rows are aggregated once."""
    per_ts = (
        _with_change(pnl)
        .groupBy("ts")
        .agg(F.avg(F.col("position") * F.col("ret")).alias("gross"), F.avg("change").alias("change"))
    )
    grid = F.explode(F.array(*[F.lit(float(c)) for c in costs])).alias("cost")
    net = per_ts.select("ts", "gross", "change", grid).withColumn("r", F.col("gross") - F.col("cost") * F.col("change"))
    ratio = F.try_divide(F.avg("r"), F.stddev_samp("r")) * F.sqrt(F.lit(float(periods)))
    return net.groupBy("cost").agg(ratio.alias("sharpe"))


def worst_period(port: DataFrame, days: int = 5) -> DataFrame:
    """Least compounded return over any `days` calendar days, with the last day of that span.

    The frame runs over one row per calendar day.
    """
    daily = port.groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.log1p("r")).alias("_log"))
    frame = Window.orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-(days - 1), 0)
    rolled = daily.withColumn("period_ret", F.expm1(F.sum("_log").over(frame)))
    return rolled.agg(F.min("period_ret").alias("worst_return"), F.min_by("day", F.struct("period_ret", "day")).alias("day"))


def risk_gate(
    port: DataFrame,
    loss_limit: float = -0.05,
    streak_limit: int = 5,
    exposure_limit: float = 0.9,
    slippage_limit: float = 0.02,
) -> DataFrame:
    """Per time: cumulative return, consecutive losses, exposure and slippage, each against its limit.

    Consecutive losses are the losses so far minus the losses counted at the last time without one; a day without such a time
    continues the streak of the days before.
    """
    lost = F.col("r") < 0

    def local(rows: DataFrame, upto: WindowSpec) -> DataFrame:
        sums = {"_sum": F.sum("r").over(upto), "_losses": F.sum(lost.cast("long")).over(upto)}
        return rows.withColumns(sums).withColumn("_base", F.last(F.when(~lost, F.col("_losses")), ignorenulls=True).over(upto))

    state = {
        "_all": F.sum("r"), "_lost": F.sum(lost.cast("long")), "_ends": F.max((~lost).cast("int")),
        "_tail": F.coalesce(F.max("_losses"), F.lit(0)) - F.coalesce(F.max("_base"), F.lit(0)),
    }
    carry = [
        lambda earlier, upto: {
            "_before": F.sum("_all").over(earlier), "_known": F.max("_lost").over(earlier).isNotNull(),
            "_run": F.coalesce(F.sum("_ends").over(upto), F.lit(0)),
        },
        lambda earlier, upto: {"_streak": F.sum("_tail").over(Window.partitionBy("_key", "_run").orderBy("_seg"))},
        lambda earlier, upto: {"_streak_before": F.coalesce(F.last("_streak").over(earlier), F.lit(0))},
    ]
    here = F.when(F.col("_base").isNotNull(), F.col("_losses") - F.col("_base")).otherwise(F.coalesce("_losses", F.lit(0)) + F.col("_streak_before"))
    streak = F.when(F.col("_losses").isNotNull() | F.col("_known"), here)
    scan = scanned(port, [], ["ts"], time_segment("ts"), local, state, carry)
    step = scan.joined({"cum_ret": _plus(F.col("_sum"), F.col("_before")), "loss_streak": streak})
    out = step.select("ts", "r", "cum_ret", "loss_streak", "exposure", "slippage")
    flags = {
        "loss_hit": F.col("cum_ret") < loss_limit,
        "streak_hit": F.col("loss_streak") >= streak_limit,
        "exposure_hit": F.col("exposure") > exposure_limit,
        "slippage_hit": F.coalesce(F.col("slippage") > slippage_limit, F.lit(False)),
    }
    return out.withColumns(flags).withColumn("halt", F.expr("loss_hit or streak_hit or exposure_hit or slippage_hit"))


def execution_quality(log: DataFrame) -> DataFrame:
    """PnL, hit rate, fill rate and mean signed slippage per day of an execution log."""
    filled = F.col("fill_price").isNotNull()
    slip = F.col("side") * (F.col("fill_price") - F.col("decision_price"))
    return log.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum("pnl").alias("pnl"),
        F.avg(F.when(filled, (F.col("pnl") > 0).cast("double"))).alias("hit_rate"),
        F.avg(filled.cast("double")).alias("fill_rate"),
        F.avg(slip).alias("slippage"),
    )
