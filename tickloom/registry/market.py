"""Ticks, bars, features, labels, indicators and the joins around them."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import bars as B
from ..operators import features as X
from ..operators import joins as J
from ..schemas import ENTITY
from .base import E_, W_, query

BAR_COLS = f"{E_}, bar_ts, o, h, l, c, v, tick_count, oi_last, trade_date"
FEATS = "f_ret_1, f_ret_5, f_vol_20, f_range_5, f_oi_chg_5, f_spread_proxy, f_iv_proxy"
H = 3600  # seconds per bar of the hourly bars
FEATS_D = FEATS.replace(",", "")


query("bronze_to_silver_ticks", "select * from {silver_v}", "price open high low oi")(lambda s: s.silver)

query(
    "strike_first_seen",
    "select ymcode, side, code, first(strike order by ts, tcnt) strike from {silver_v} group by 1, 2, 3",
)(lambda s: B.strike_first_seen(s.silver))

query(
    "dim_contract",
    "select c.ymcode, c.side, c.code, coalesce(m.strike, -1) strike, c.lastday, date '1900-01-01' effective_from, "
    "date '2999-12-31' effective_to from {codes_v} c left join (select ymcode, side, code, "
    "first(strike order by ts, tcnt) strike from {silver_v} group by 1, 2, 3) m "
    "on c.ymcode = m.ymcode and c.side = m.side and c.code = m.code",
)(lambda s: B.dim_contract(s.codes, s.silver))

query("ohlc_bars", f"select {BAR_COLS} from {{bars_v}}", "o h l c oi_last")(
    lambda s: B.ohlc_bars(s.silver, "1 hour")
)
query("ohlc_bars_1m", f"select {BAR_COLS} from {{bars_1m_v}}", "o h l c oi_last")(
    lambda s: B.ohlc_bars(s.silver, "1 minute")
)

_ROLL = (
    f"select {E_}, {{unit}} bar_ts, first(o order by bar_ts) o, max(h) h, min(l) l, last(c order by bar_ts) c, "
    "cast(sum(v) as bigint) v, cast(sum(tick_count) as bigint) tick_count, last(oi_last order by bar_ts) oi_last, "
    f"trade_date from {{{{bars_1m_v}}}} group by {E_}, {{unit}}, trade_date"
)
query("rollup_bars", _ROLL.format(unit="date_trunc('hour', bar_ts)"), "o h l c oi_last")(
    lambda s: B.rollup_bars(s.bars_1m, "1 hour")
)
query("rollup_bars_1d", _ROLL.format(unit="cast(date_trunc('day', bar_ts) as timestamp)"), "o h l c oi_last")(
    lambda s: B.rollup_bars(s.bars_1m, "1 day")
)

query(
    "tick_rank",
    f"select {E_}, minute_ts, ts, tcnt, row_number() over (partition by {E_}, minute_ts order by ts, tcnt) rn_asc, "
    f"row_number() over (partition by {E_}, minute_ts order by ts desc, tcnt desc) rn_desc from {{silver_v}}",
)(lambda s: B.tick_rank(s.silver))

query(
    "volume_profile",
    "select hour(bar_ts) \"hour\", cast(floor(c / 10) as bigint) price_bucket, cast(sum(v) as bigint) volume, "
    "sum(v) / (select sum(v) from {bars_v}) \"share\" from {bars_v} group by 1, 2",
    "share",
)(lambda s: B.volume_profile(s.bars).withColumn("hour", F.col("hour").cast("long")))

query(
    "hourly_volatility",
    "select hour(asof_ts) \"hour\", stddev_samp(f_ret_1) volatility, count(f_ret_1) n from {features_v} group by 1",
    "volatility",
)(lambda s: B.hourly_volatility(s.features).withColumn("hour", F.col("hour").cast("long")))

for _f in ["f_ret_1", "f_ret_5", "f_oi_chg_5", "f_vol_20", "f_range_5", "f_spread_proxy", "f_iv_proxy"]:
    query(_f, f"select {E_}, asof_ts, {_f} from {{features_v}}", _f)(lambda s, f=_f: X.feature(s.bars, f, H))
query("range_1", f"select {E_}, bar_ts asof_ts, range_1 from {{rets_v}}", "range_1")(lambda s: X.range_1(s.bars))

query("features", f"select {E_}, asof_ts, {FEATS}, trade_date from {{features_v}}", FEATS_D)(
    lambda s: X.features(s.bars, bar_s=H)
)
_D = f"(partition by {E_}, trade_date order by bar_ts"
query(
    "features_by_day",
    f"select {E_}, bar_ts asof_ts, f_ret_1, c / nullif(lag(c, 5) over {_D}), 0) - 1 f_ret_5, "
    f"stddev_samp(f_ret_1) over {_D} rows 19 preceding) f_vol_20, avg(rg) over {_D} rows 4 preceding) f_range_5 "
    f"from (select *, c / nullif(lag(c) over {_D}), 0) - 1 f_ret_1, (h - l) / nullif(c, 0) rg from {{bars_v}})",
    "f_ret_1 f_ret_5 f_vol_20 f_range_5",
)(lambda s: X.features(s.bars, by_day=True, bar_s=H).select(*ENTITY, "asof_ts", "f_ret_1", "f_ret_5", "f_vol_20", "f_range_5"))


def _back(n: int, col: str = "c") -> str:
    return (
        f"max({col}) over (partition by {E_} order by bar_ts range between interval {n} hour preceding "
        f"and interval {n} hour preceding)"
    )


query(
    "features_time",
    f"select {E_}, bar_ts asof_ts, ft_ret_1, ft_ret_5, stddev_samp(ft_ret_1) over (partition by {E_} order by bar_ts "
    "range between interval 19 hour preceding and current row) ft_vol_20, avg(rg) over (partition by "
    f"{E_} order by bar_ts range between interval 4 hour preceding and current row) ft_range_5, ft_oi_chg_5, trade_date "
    f"from (select *, c / nullif({_back(1)}, 0) - 1 ft_ret_1, c / nullif({_back(5)}, 0) - 1 ft_ret_5, "
    f"oi_last - {_back(5, 'oi_last')} ft_oi_chg_5, (h - l) / nullif(c, 0) rg from {{bars_v}})",
    "ft_ret_1 ft_ret_5 ft_vol_20 ft_range_5 ft_oi_chg_5",
)(lambda s: X.features_time(s.bars, unit_s=3600))

query("y_fwd_ret_5", f"select {E_}, asof_ts, y_fwd_ret_5 from {{labels_v}}", "y_fwd_ret_5")(
    lambda s: X.labels(s.bars, bar_s=H).select(*ENTITY, "asof_ts", "y_fwd_ret_5")
)
query("y_fwd_ret_15", f"select {E_}, asof_ts, y_fwd_ret_15 from {{labels_v}}", "y_fwd_ret_15")(
    lambda s: X.labels(s.bars, bar_s=H).select(*ENTITY, "asof_ts", "y_fwd_ret_15")
)
query(
    "labels",
    f"select {E_}, asof_ts, y_fwd_ret_5, y_fwd_ret_15, trade_date from {{labels_v}}",
    "y_fwd_ret_5 y_fwd_ret_15",
)(lambda s: X.labels(s.bars, bar_s=H))


def _ahead(n: int) -> str:
    return (
        f"max(c) over (partition by {E_} order by bar_ts range between interval {n} hour following "
        f"and interval {n} hour following) / nullif(c, 0) - 1"
    )


query(
    "labels_time",
    f"select {E_}, bar_ts asof_ts, {_ahead(5)} yt_fwd_ret_5, {_ahead(15)} yt_fwd_ret_15, trade_date from {{bars_v}}",
    "yt_fwd_ret_5 yt_fwd_ret_15",
)(lambda s: X.labels_time(s.bars, unit_s=3600))

query(
    "max_favourable_return",
    f"select {E_}, bar_ts asof_ts, max(h) over (partition by {E_} order by bar_ts range between interval 1 microsecond "
    "following and interval 20 minute following) / nullif(c, 0) - 1 max_fav_ret from {bars_1m_v}",
    "max_fav_ret",
)(lambda s: X.max_favourable_return(s.bars_1m))

for _n in (20, 50):
    query(
        f"moving_average_{_n}" if _n != 20 else "moving_average",
        f"select {E_}, bar_ts, case when count(*) over (partition by {E_} order by bar_ts rows {_n - 1} preceding) = {_n} "
        f"then avg(c) over (partition by {E_} order by bar_ts rows {_n - 1} preceding) end ma_{_n} from {{bars_v}}",
        f"ma_{_n}",
    )(lambda s, n=_n: X.moving_average(s.bars, n, bar_s=H))

query(
    "bollinger",
    f"select {E_}, bar_ts, case when n = 20 then m end bb_mid, case when n = 20 then m + 2 * sd end bb_upper, "
    f"case when n = 20 then m - 2 * sd end bb_lower from (select *, count(*) over w n, avg(c) over w m, "
    f"stddev_samp(c) over w sd from {{bars_v}} window w as (partition by {E_} order by bar_ts rows 19 preceding))",
    "bb_mid bb_upper bb_lower",
)(lambda s: X.bollinger(s.bars, bar_s=H))

query(
    "rsi",
    f"select {E_}, bar_ts, case when n < 14 then null when ls = 0 then 100.0 else 100.0 - 100.0 / (1.0 + g / ls) end rsi "
    "from (select *, count(d) over w n, avg(case when d > 0 then d when d is not null then 0 end) over w g, "
    "avg(case when d < 0 then -d when d is not null then 0 end) over w ls "
    f"from (select *, c - lag(c) over {W_} d from {{bars_v}}) "
    f"window w as (partition by {E_} order by bar_ts rows 13 preceding))",
    "rsi",
)(lambda s: X.rsi(s.bars, bar_s=H))

_EWM = (
    "(select sum(x * pow({b}, j)) / sum(pow({b}, j)) from (select unnest(list_reverse({l})) x, "
    "unnest(range(len({l}))) j))"
)


def _ewm(span: int, lst: str) -> str:
    b = 1 - 2 / (span + 1)
    n = f"len({lst})"
    num = f"list_sum(list_transform(list_reverse({lst}), lambda x, i: x * pow({b!r}, i - 1)))"
    return f"{num} / list_sum(list_transform(range({n}), lambda i: pow({b!r}, i)))"


query(
    "macd",
    f"select {E_}, bar_ts, macd, {_ewm(9, 'ml')} macd_signal, macd - {_ewm(9, 'ml')} macd_hist from ("
    f"select *, list(macd) over (partition by {E_} order by bar_ts rows 599 preceding) ml from ("
    f"select *, {_ewm(12, 'cl')} - {_ewm(26, 'cl')} macd from (select {E_}, bar_ts, "
    f"list(c) over (partition by {E_} order by bar_ts rows 599 preceding) cl from {{bars_v}})))",
    "macd macd_signal macd_hist",
)(lambda s: X.macd(s.bars, bar_s=H))

query(
    "momentum",
    f"select {E_}, bar_ts, c / nullif(lag(c, 10) over {W_}, 0) - 1 mom_rel_10, c - lag(c, 10) over {W_} mom_abs_10 "
    "from {bars_v}",
    "mom_rel_10 mom_abs_10",
)(lambda s: X.momentum(s.bars, 10, bar_s=H))

_GRID = (
    f"select {E_}, g.t grid_ts, {{value}} c, g.t <> bar_ts filled from (select *, lead(bar_ts) over {W_} nx, "
    f"lead(c) over {W_} nc from {{{{bars_v}}}}) b, lateral (select unnest(generate_series(bar_ts, "
    "greatest(coalesce(nx - interval 1 hour, bar_ts), bar_ts), interval 1 hour)) t) g"
)
query("fill_gaps", _GRID.format(value="c"), "c")(lambda s: B.fill_gaps(s.bars, 3600))
query(
    "fill_gaps_linear",
    _GRID.format(value="c + coalesce((nc - c) * (epoch(g.t) - epoch(bar_ts)) / (epoch(nx) - epoch(bar_ts)), 0.0)"),
    "c",
)(lambda s: B.fill_gaps(s.bars, 3600, "linear"))

query(
    "smooth",
    f"select {E_}, bar_ts, quantile_cont(c, 0.5) over (partition by {E_} order by bar_ts rows 4 preceding) c_smooth "
    "from {bars_v}",
    "c_smooth",
)(lambda s: X.smooth(s.bars, bar_s=H))

query(
    "lag_features",
    f"select {E_}, bar_ts, "
    + ", ".join(f"lag({c}, {n}) over {W_} {c}_lag_{n}" for c in ("c", "v") for n in (1, 2, 3))
    + " from {bars_v}",
    "c_lag_1 c_lag_2 c_lag_3",
)(lambda s: X.lag_features(s.bars, ["c", "v"], [1, 2, 3], bar_s=H))

query(
    "seasonal_decompose",
    "with p as materialized (select *, cast((epoch(bar_ts)::bigint // 3600) % 24 as integer) phase, "
    f"case when count(*) over w = 25 then (sum(c) over w - (lag(c, 12) over {W_} + lead(c, 12) over {W_}) / 2) / 24 end trend from {{bars_v}} "
    f"window w as (partition by {E_} order by bar_ts rows between 12 preceding and 12 following)) "
    f"select {E_}, bar_ts, phase, trend, seasonal, c - trend - seasonal residual from p join "
    f"(select {E_}, phase, avg(c - trend) seasonal from p group by {E_}, phase) using ({E_}, phase)",
    "trend seasonal residual",
)(lambda s: X.seasonal_decompose(s.bars))

query(
    "latest_per_key",
    f"select {E_}, asof_ts, {FEATS} from {{features_v}} "
    f"qualify row_number() over (partition by {E_} order by asof_ts desc) = 1",
    FEATS_D,
)(lambda s: X.latest_per_key(s.features))

query(
    "features_with_close",
    f"select f.*, b.c as \"close\" from {{features_v}} f left join {{bars_v}} b on f.ymcode = b.ymcode "
    "and f.side = b.side and f.code = b.code and f.strike = b.strike and f.asof_ts = b.bar_ts",
    FEATS_D + " close",
)(lambda s: X.features_with_close(s.features, s.bars))

query("training_set", "select * from {training_v}", FEATS_D + " y_fwd_ret_5")(
    lambda s: X.training_set(s.features, s.labels)
)

query(
    "union_sides",
    "select * from {ticks_v} where side = 'CALL' union all select * from {ticks_v} where side = 'PUT'",
    "c o h l oi",
)(lambda s: J.union_sides(s.ticks.where("side = 'CALL'"), s.ticks.where("side = 'PUT'")))

# point-in-time: each purchase quote sees the latest error quote before it
_ASOF = (
    "select l.event_id, l.user_id, l.ts, r.ts right_ts, r.value right_value from "
    "(select * from {{ev_v}} where event_type = 'purchase') l asof left join "
    "(select * from {{ev_v}} where event_type = 'view') r on l.user_id = r.user_id and l.ts >= r.ts"
)
query("pit_join", _ASOF.replace("{{", "{").replace("}}", "}"), "right_value")(lambda s: _pit(s, None))
query(
    "pit_join_tolerance",
    "select event_id, user_id, ts, case when epoch_us(ts) - epoch_us(right_ts) <= 86400000000 then right_ts end right_ts, "
    "case when epoch_us(ts) - epoch_us(right_ts) <= 86400000000 then right_value end right_value from ("
    + _ASOF.replace("{{", "{").replace("}}", "}")
    + ")",
    "right_value",
)(lambda s: _pit(s, 86400))


def _pit(s, tolerance_s):
    left = s.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = s.events.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("right_value"))
    return J.pit_join(left, right, ["user_id"], "ts", tolerance_s=tolerance_s)


query(
    "nearest_strike",
    "with sf as (select ymcode, bar_ts ts, strike, avg(c) iv from {bars_v} group by 1, 2, 3), "
    "qt as (select distinct ymcode, date_trunc('hour', ts) ts, cast(k + 1 as integer) strike from "
    "(select strftime(ts, '%Y%m') ymcode, ts, k from {ev_v})) "
    "select q.ymcode, q.ts, q.strike, s.strike near_strike, s.iv near_iv from qt q join sf s on q.ymcode = s.ymcode "
    "and q.ts = s.ts qualify row_number() over (partition by q.ymcode, q.ts, q.strike "
    "order by abs(q.strike - s.strike), s.strike) = 1",
    "near_iv",
)(lambda s: J.nearest_strike(_surface(s), _strikes(s)))


def _surface(s):
    return s.bars.groupBy("ymcode", F.col("bar_ts").alias("ts"), "strike").agg(F.avg("c").alias("iv"))


def _strikes(s):
    return s.events.select(
        F.date_format("ts", "yyyyMM").alias("ymcode"),
        F.date_trunc("hour", "ts").alias("ts"),
        (F.col("k") + 1).cast("int").alias("strike"),
    ).distinct()


query(
    "parity_diff",
    "with b as (select * from {bars_v}), st as (select "
    + f"{E_}, bar_ts, case when hour(bar_ts) = 7 then c + 1 else c end c from {{bars_v}} where hour(bar_ts) <> 3) "
    f"select {E_}, bar_ts, b.c batch_value, st.c stream_value, case when st.bar_ts is null then 'missing_in_stream' "
    "when b.bar_ts is null then 'missing_in_batch' else 'differs' end reason from b full join st "
    f"using ({E_}, bar_ts) where st.bar_ts is null or b.bar_ts is null or abs(b.c - st.c) > 1e-9",
    "batch_value stream_value",
)(
    lambda s: J.parity_diff(
        s.bars.select(*ENTITY, "bar_ts", "c"),
        s.bars.where("hour(bar_ts) <> 3").select(
            *ENTITY, "bar_ts", F.when(F.hour("bar_ts") == 7, F.col("c") + 1).otherwise(F.col("c")).alias("c")
        ),
        [*ENTITY, "bar_ts"],
        "c",
    )
)

query(
    "decide",
    f"select {E_}, asof_ts, pred, case when pred > 0.001 then 'BUY' when pred < -0.001 then 'SELL' else 'HOLD' end "
    "decision from {scored_v}",
    "pred",
)(lambda s: s.scored.select(*ENTITY, "asof_ts", "pred", S.decide("pred").alias("decision")))

query(
    "feature_key",
    f"select {E_}, asof_ts, 'options:' || ymcode || ':' || side || ':' || code || ':' || strike || ':' || "
    "strftime(asof_ts, '%Y-%m-%dT%H:%M:%SZ') feature_key from {features_v}",
)(lambda s: s.features.select(*ENTITY, "asof_ts", S.feature_key("asof_ts").alias("feature_key")))

query(
    "time_features",
    "select event_id, cast(hour(ts) as integer) \"hour\", cast(isodow(ts) - 1 as integer) day_of_week, "
    "cast(month(ts) as integer) \"month\", cast(quarter(ts) as integer) as \"quarter\", isodow(ts) - 1 >= 5 is_weekend, "
    "case when hour(ts) = 0 then null when hour(ts) <= 6 then 'night' when hour(ts) <= 12 then 'morning' "
    "when hour(ts) <= 18 then 'afternoon' else 'evening' end time_of_day from events",
)(lambda s: s.events.select("event_id", *S.time_features("ts")))

query(
    "season",
    "select l_orderkey, l_linenumber, case when month(l_shipdate) in (3, 4, 5) then 'spring' when month(l_shipdate) in "
    "(6, 7, 8) then 'summer' when month(l_shipdate) in (9, 10, 11) then 'autumn' else 'winter' end season from lineitem",
)(lambda s: s.table("lineitem").select("l_orderkey", "l_linenumber", S.season("l_shipdate").alias("season")))

query(
    "kst_to_utc",
    "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') kst_text, date_trunc('second', ts) - interval 9 hour utc_ts, "
    "date_trunc('second', ts) shown_kst from events",
)(
    lambda s: S.kst_to_utc(
        s.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("kst_text")), "kst_text", "utc_ts"
    ).withColumn("shown_kst", F.from_utc_timestamp("utc_ts", "Asia/Seoul"))
)

query(
    "daily_slice",
    "select event_id, ts, value from events where cast(ts as date) = date '2024-01-10'",
    "value",
)(lambda s: S.daily_slice(s.events, "ts", "2024-01-10").select("event_id", "ts", "value"))
