"""Registration of queries and the shared SQL views of their oracles."""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.adapters import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NUDGE = 1e-9


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places, instants to zone-free timestamps, so that both engines show the same values.

    A nudge of 1e-9 before rounding keeps exact halves, which the engines round differently, off the limit.
    """
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind in ("double", "float"):
            c = (F.round(c.cast("double") + NUDGE, 6) + F.lit(0.0)).alias(f.name)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def query(key: str, sql: str | None = None, doubles: str = ""):
    """Register `fn(inputs)` under `key`; `doubles` names the oracle columns to round."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(fn(Inputs(spark, sf_dir)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle(sql, doubles)
        return fn

    return register


def oracle(body: str, doubles: str = "") -> str:
    """Prefix the views that `body` names and round the listed columns."""
    if doubles:
        rounded = ", ".join(f"round({c} + 1e-9, 6) + 0.0 as {c}" for c in doubles.split())
        body = f"select * replace ({rounded}) from ({body})"
    needed: list[str] = []

    def add(text: str) -> None:
        for name in VIEWS:
            if name not in needed and f"{{{name}}}" in text:
                add(VIEWS[name])
                needed.append(name)

    add(body)
    views = ", ".join(f"{n} as materialized ({VIEWS[n]})" for n in needed)
    text = f"with {views} {body}" if needed else body
    for n in VIEWS:
        text = text.replace(f"{{{n}}}", n)
    return text


def new_database(inputs: Inputs) -> str:
    """A database of its own below the shared folder."""
    name = f"tickloom_{uuid.uuid4().hex[:12]}"
    inputs.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(inputs.spark, name)}'")
    return name


E_ = "ymcode, side, code, strike"
W_ = f"(partition by {E_} order by bar_ts)"


def _bars(unit: str) -> str:
    return (
        f"select {E_}, date_trunc('{unit}', ts) bar_ts, first(open order by ts, tcnt) o, max(high) h, min(low) l, "
        "last(price order by ts, tcnt) c, cast(sum(ccnt) as bigint) v, count(*) tick_count, "
        "last(oi order by ts, tcnt) oi_last, trade_date "
        f"from {{silver_v}} group by {E_}, date_trunc('{unit}', ts), trade_date"
    )


VIEWS: dict[str, str] = {
    "ev_v": (
        "select event_id, ts, user_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) k from events"
    ),
    "ticks_v": (
        "select case when user_id % 2 = 0 then 'CALL' else 'PUT' end side, strftime(ts, '%Y%m') ymcode, event_type code, "
        "cast(length(event_type) * 10 as integer) strike, ts tdate, event_id tcnt, value c, value o, "
        "value + k / 100.0 h, greatest(value - k / 100.0, 0.0) l, cast(user_id as double) oi, k ccnt from {ev_v}"
    ),
    "codes_v": (
        "select distinct side, ymcode, code, 20240131 lastday from {ticks_v} union all "
        "select 'CALL', '202401', 'NOTICK1', 20240131 union all select 'PUT', '202401', 'NOTICK2', 20240131"
    ),
    "silver_v": (
        f"select {E_}, tdate ts, tcnt, c price, o open, h high, l low, oi, ccnt, cast(tdate as date) trade_date, "
        "date_trunc('minute', tdate) minute_ts from {ticks_v}"
    ),
    "bars_v": _bars("hour"),
    "bars_1m_v": _bars("minute"),
    "rets_v": (
        f"select *, c / nullif(lag(c) over {W_}, 0) - 1 f_ret_1, c / nullif(lag(c, 5) over {W_}, 0) - 1 f_ret_5, "
        f"oi_last - lag(oi_last, 5) over {W_} f_oi_chg_5, (h - l) / nullif(c, 0) range_1 from {{bars_v}}"
    ),
    "features_v": (
        f"select {E_}, bar_ts asof_ts, f_ret_1, f_ret_5, "
        f"stddev_samp(f_ret_1) over (partition by {E_} order by bar_ts rows 19 preceding) f_vol_20, "
        f"avg(range_1) over (partition by {E_} order by bar_ts rows 4 preceding) f_range_5, f_oi_chg_5, "
        f"avg(range_1) over (partition by {E_} order by bar_ts rows 4 preceding) f_spread_proxy, "
        f"stddev_samp(f_ret_1) over (partition by {E_} order by bar_ts rows 19 preceding) f_iv_proxy, trade_date "
        "from {rets_v}"
    ),
    "labels_v": (
        f"select {E_}, bar_ts asof_ts, lead(c, 5) over {W_} / nullif(c, 0) - 1 y_fwd_ret_5, "
        f"lead(c, 15) over {W_} / nullif(c, 0) - 1 y_fwd_ret_15, trade_date from {{bars_v}}"
    ),
    "training_v": (
        f"select {E_}, asof_ts, trade_date, f_ret_1, f_ret_5, f_vol_20, f_range_5, f_oi_chg_5, f_spread_proxy, "
        f"f_iv_proxy, y_fwd_ret_5 from {{features_v}} join {{labels_v}} using ({E_}, asof_ts, trade_date) "
        "where y_fwd_ret_5 is not null and f_ret_1 is not null and f_ret_5 is not null and f_vol_20 is not null "
        "and f_range_5 is not null and f_oi_chg_5 is not null"
    ),
    "scored_v": (
        f"select {E_}, asof_ts, trade_date, y_fwd_ret_5, (f_ret_5 - f_ret_1) / 1000.0 pred, "
        "ln(1.0 + y_fwd_ret_5) / 100.0 ret from {training_v}"
    ),
    "quotes_v": (
        "select ts \"timestamp\", event_type symbol, greatest(value - k / 1000.0, 0.0) bid_price, "
        "cast(k as integer) bid_size, value + k / 1000.0 ask_price, cast(100 - k as integer) ask_size, "
        "value last_price, k * 10 volume, event_id from {ev_v}"
    ),
    "logs_v": (
        "select ts event_time, case event_type when 'error' then 'ERROR' when 'signup' then 'WARN' else 'INFO' end "
        "\"level\", event_type message, '{\"user\":\"user' || user_id || '\",\"order_id\":\"ord-' || event_id || '\"}' meta "
        "from {ev_v}"
    ),
    "images_v": (
        "select 'img-' || doc_id image_id, 's3a://bucket/raw/images/' || source || '/' || doc_id || "
        "case when doc_id % 3 <> 0 then '.png' else '.txt' end s3_path, n_chars file_size, "
        "case when doc_id % 3 <> 0 then 'image/png' else 'text/plain' end mime_type, "
        "timestamp '2024-01-01 00:00:00' + to_days(cast(doc_id % 30 as integer)) upload_time, source source_system, "
        "lang tag, md5(text) checksum, cast(100 + doc_id % 1000 as integer) width, "
        "cast(100 + doc_id % 700 as integer) height from documents"
    ),
    "counters_v": (
        "select 'work_total' metric, event_type instance, ts, cast(sum(k) over (partition by event_type order by ts, "
        "event_id rows unbounded preceding) as double) \"value\" from {ev_v}"
    ),
    "gauges_v": (
        "select event_type instance, ts, 'size' metric, 100.0::double \"value\" from {ev_v} union all "
        "select event_type, ts, 'avail', cast(100 - k as double) from {ev_v}"
    ),
    "power_v": (
        "select ts datetime, value / 10 Global_active_power, k / 100 Global_reactive_power, 220 + k / 10 Voltage, "
        "value / 50 Global_intensity, k from {ev_v}"
    ),
    "classes_v": (
        "select event_id, cast(k % 10 as integer) label, cast(case when event_id % 3 = 0 then (k % 10 + 1) % 10 "
        "else k % 10 end as integer) prediction, (k + 1) / 101.0 p_true from {ev_v}"
    ),
    "binary_v": (
        f"select *, cast(score > 0.5 as integer) prediction from (select {E_}, asof_ts, "
        "cast(y_fwd_ret_5 > 0 as integer) label, round(1.0 / (1.0 + exp(-1000.0 * pred)), 3) score from {scored_v})"
    ),
    "executions_v": (
        "select ts, event_type symbol, case when user_id % 2 = 0 then 1 else -1 end side, value decision_price, "
        "case when k >= 10 then value + (k - 50) / 1000.0 end fill_price, "
        "case when k >= 10 then case when user_id % 2 = 0 then 1 else -1 end * (k - 50) / 100.0 end pnl from {ev_v}"
    ),
}
