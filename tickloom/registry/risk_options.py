"""Strategy evaluation, risk and option-specific features."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import blackscholes as bs
from ..operators import options as O
from ..operators import risk as R
from ..schemas import ENTITY
from .base import E_, query

_PNL = (
    f"(select *, abs(position - coalesce(lag(position) over (partition by {E_} order by ts), 0)) change from (select {E_}, "
    "asof_ts ts, case when pred > 0.001 then 1 when pred < -0.001 then -1 else 0 end position, ret from {scored_v}))"
)
_SR = f"(select *, position * ret - 0.0005 * change strat_ret from {_PNL})"
_PORT = f"(select ts, avg(strat_ret) r, avg(abs(position))::double exposure from {_SR} group by 1)"


def _pnl(s):
    return R.positions_from(s.scored)


def _port(s):
    """Stored: the risk queries read it several times."""
    return s.stored("portfolio", lambda: R.portfolio(R.strategy_returns(_pnl(s))))


query("strategy_returns", f"select {E_}, ts, position, strat_ret from {_SR}", "strat_ret")(
    lambda s: R.strategy_returns(_pnl(s))
)
query("sharpe", f"select avg(r) / nullif(stddev_samp(r), 0) * sqrt(252.0) sharpe from {_PORT}", "sharpe")(
    lambda s: R.sharpe(_port(s))
)
_CUM = f"(select ts, sum(ln(1 + r)) over (order by ts) cum from {_PORT})"
_EQ = f"(select ts, exp(cum) equity, 1 - exp(cum - max(cum) over (order by ts)) drawdown from {_CUM})"
query("equity_curve", f"select * from {_EQ}", "equity drawdown")(lambda s: R.equity_curve(_port(s)))
query("max_drawdown", f"select max(drawdown) max_drawdown from {_EQ}", "max_drawdown")(
    lambda s: R.max_drawdown(_port(s))
)
query(
    "cvar",
    f"with p as materialized (select * from {_PORT}), q as (select quantile_cont(r, 0.05) v from p) "
    "select max(v) \"var\", avg(r) cvar, count(*) n from p, q where r <= v",
    "var cvar",
)(lambda s: R.cvar(_port(s)))
query(
    "turnover",
    f"select cast(ts as date) \"day\", cast(sum(change) as bigint) turnover from {_PNL} group by 1",
)(lambda s: R.turnover(_pnl(s)))
query(
    "cost_sensitivity",
    f"select cost, avg(r) / nullif(stddev_samp(r), 0) * sqrt(252.0) sharpe from (select cost, ts, avg(position * ret - cost "
    f"* change) r from {_PNL}, (select unnest([0.0, 0.0005, 0.001, 0.002])::double cost) group by 1, 2) group by 1",
    "cost sharpe",
)(lambda s: R.cost_sensitivity(_pnl(s)))
query(
    "worst_period",
    "select min(pr) worst_return, arg_min(\"day\", pr) \"day\" from (select \"day\", exp(sum(lg) over (order by \"day\" range "
    "between interval 4 day preceding and current row)) - 1 pr from (select cast(ts as date) \"day\", sum(ln(1 + r)) lg "
    f"from {_PORT} group by 1))",
    "worst_return",
)(lambda s: R.worst_period(_port(s), 5))

_SLIP = (
    "(select date_trunc('hour', ts) ts, avg(side * (fill_price - decision_price)) slippage from {executions_v} group by 1)"
)
query(
    "risk_gate",
    "select *, loss_hit or streak_hit or exposure_hit or slippage_hit halt from (select ts, r, cum_ret, loss_streak, exposure, "
    "slippage, cum_ret < -0.05 loss_hit, loss_streak >= 5 streak_hit, exposure > 0.9 exposure_hit, "
    "coalesce(slippage > 0.02, false) slippage_hit from (select *, cast(sum(case when r < 0 then 1 else 0 end) over "
    "(partition by g order by ts) as bigint) loss_streak from (select p.*, slippage, sum(r) over (order by p.ts) cum_ret, "
    f"sum(case when r < 0 then 0 else 1 end) over (order by p.ts) g from {_PORT} p left join {_SLIP} x on p.ts = x.ts)))",
    "r cum_ret exposure slippage",
)(lambda s: R.risk_gate(_port(s).join(_slippage(s), "ts", "left")))


def _slippage(s):
    slip = F.col("side") * (F.col("fill_price") - F.col("decision_price"))
    return s.executions.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.avg(slip).alias("slippage"))


query(
    "execution_quality",
    "select cast(ts as date) \"day\", sum(pnl) pnl, avg(case when fill_price is not null then (pnl > 0)::integer end) "
    "hit_rate, avg((fill_price is not null)::integer) fill_rate, avg(side * (fill_price - decision_price)) slippage "
    "from {executions_v} group by 1",
    "pnl hit_rate fill_rate slippage",
)(lambda s: R.execution_quality(s.executions))

for _key, _unit, _trunc in (("orderbook_features", "1 minute", "minute"), ("orderbook_features_1s", "1 second", "second")):
    query(
        _key,
        f"select symbol, date_trunc('{_trunc}', \"timestamp\") bucket, avg(ask_price - bid_price) spread, "
        "avg((bid_size - ask_size) / nullif(bid_size + ask_size, 0)) imbalance, cast(sum(bid_size) as bigint) bid_depth, "
        "cast(sum(ask_size) as bigint) ask_depth, count(*) n from {quotes_v} group by 1, 2",
        "spread imbalance",
    )(lambda s, u=_unit: O.orderbook_features(s.quotes, u))

_KNOWN = (
    "(select ymcode, ts, strike, avg(case when strike % 3 = 0 then price end) iv from (select strftime(ts, '%Y%m') ymcode, "
    "date_trunc('hour', ts) ts, cast(k + 1 as integer) strike, \"value\" price from {ev_v}) group by 1, 2, 3)"
)
query(
    "iv_surface",
    "select ymcode, ts, strike, coalesce(iv, li + (hi - li) * (strike - ls) / (hs - ls)) iv, iv is null filled from (select *, "
    "last_value(iv ignore nulls) over a li, last_value(case when iv is not null then strike end ignore nulls) over a ls, "
    "first_value(iv ignore nulls) over b hi, first_value(case when iv is not null then strike end ignore nulls) over b hs "
    f"from {_KNOWN} window a as (partition by ymcode, ts order by strike rows between unbounded preceding and current row), "
    "b as (partition by ymcode, ts order by strike rows between current row and unbounded following))",
    "iv",
)(lambda s: O.iv_surface(_known(s)))


def _known(s):
    rows = s.events.select(
        F.date_format("ts", "yyyyMM").alias("ymcode"),
        F.date_trunc("hour", "ts").alias("ts"),
        (F.col("k") + 1).cast("int").alias("strike"),
        "value",
    )
    return rows.groupBy("ymcode", "ts", "strike").agg(
        F.avg(F.when(F.col("strike") % 3 == 0, F.col("value"))).alias("iv")
    )


def _polynomial(factors, x):
    value = f"{factors[0]!r}::double"
    for c in factors[1:]:
        value = f"({value} * abs({x}) + {c!r}::double)"
    return value


def _cdf(x):
    """SQL of the normal distribution at `x`."""
    near = f"{_polynomial(bs.P, x)} / {_polynomial(bs.Q, x)}"
    tail = f"(abs({x}) + 0.65::double)"
    for k in (4, 3, 2, 1):
        tail = f"(abs({x}) + {k} / {tail})"
    density = f"exp(-0.5::double * ({x}) * ({x}))"
    upper = f"(case when abs({x}) < 7.07106781186547 then {density} * ({near}) else {density} / {tail} / 2.506628274631::double end)"
    return f"(case when {x} > 0 then 1 - {upper} else {upper} end)"


def _price(vol):
    d1 = f"((lsk + (0.03::double + 0.5::double * {vol} * {vol}) * t) / ({vol} * root))"
    d2 = f"({d1} - {vol} * root)"
    return f"(su * {_cdf(d1)} - disc * {_cdf(d2)} + case when side = 'CALL' then 0 else disc - su end)"


# Bisection in SQL, all rows at once; a row without a volatility between the bounds carries NULL through it.
_OPTIONS = (
    f"select {E_}, bar_ts, c price, strike + c * case when side = 'CALL' then 0.8::double else -0.8::double end underlying, "
    "date_diff('day', trade_date, date '2024-06-30') / 365::double t_years from {bars_v}"
)
_BOUND = (
    f"select *, {_price('1e-4::double')} <= price and {_price('5::double')} >= price known from (select *, ln(su / strike) lsk, "
    "sqrt(t) root, strike * exp(-0.03::double * t) disc from (select *, case when good then underlying end su, "
    "case when good then t_years end t from (select *, price > 0 and underlying > 0 and strike > 0 and t_years > 0 "
    f"and side in ('CALL', 'PUT') good from ({_OPTIONS}))))"
)
_STEP = f"select *, {_price('mid')} < price low from (select *, 0.5::double * (lo + hi) mid from bisected where n < 60)"
_VOLS = (
    f"with recursive bisected as (select *, 0 n, 1e-4::double lo, 5::double hi from ({_BOUND}) union all select * exclude "
    "(n, lo, hi, mid, low), n + 1, case when low then mid else lo end, case when low then hi else mid end "
    f"from ({_STEP})) select *, (lsk + (0.03::double + 0.5::double * iv * iv) * t) / (iv * root) d1 from (select *, "
    "case when known then 0.5::double * (lo + hi) end iv from bisected where n = 60)"
)
_VEGA = "su * exp(-0.5::double * d1 * d1) / sqrt(2 * pi())"
_D2 = "(d1 - iv * root)"


@query(
    "implied_vol_greeks",
    f"select {E_}, bar_ts, price, underlying, t_years, iv, {_cdf('d1')} - case when side = 'CALL' then 0 else 1 end delta, "
    f"{_VEGA} / (su * su * iv * root) gamma, {_VEGA} * root vega, -{_VEGA} * iv / (2 * root) + 0.03::double * disc * case when "
    f"side = 'CALL' then -{_cdf(_D2)} else {_cdf('(-' + _D2 + ')')} end theta from ({_VOLS})",
    "price underlying t_years iv delta gamma vega theta",
)
def _greeks(s):
    """Bars priced against an underlying 80 % of the premium in the money, expiring at the end of June."""
    away = F.col("c") * F.when(F.col("side") == "CALL", 0.8).otherwise(-0.8)
    rows = s.bars.select(
        *ENTITY,
        "bar_ts",
        F.col("c").alias("price"),
        (F.col("strike") + away).alias("underlying"),
        (F.datediff(F.lit("2024-06-30").cast("date"), "trade_date") / 365.0).alias("t_years"),
    )
    return O.implied_vol_greeks(rows)
