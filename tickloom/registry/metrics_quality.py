"""Metric functions, data quality and layer metrics."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import quality as Q
from ..schemas import ENTITY, FEATURE_COLS
from .base import E_, query


def _rate(sec: int) -> str:
    return (
        "select metric, instance, ts, case when n >= 2 then (s - coalesce(f, 0)) / "
        f"{sec}.0 end rate from (select *, sum(step) over w s, first_value(step) over w f, count(*) over w n from (select *, "
        "case when lag(\"value\") over (partition by instance order by ts) is null then null when \"value\" >= "
        "lag(\"value\") over (partition by instance order by ts) then \"value\" - lag(\"value\") over (partition by instance "
        "order by ts) else \"value\" end step from {samples}) window w as (partition by instance order by ts range between "
        f"interval {sec} second preceding and current row))"
    )


# a counter that falls back to a small value whenever it passes a multiple of 5000
RESET = "(select metric, instance, ts, \"value\" % 5000 \"value\" from {counters_v})"


def _resetting(s):
    return s.counters.withColumn("value", F.col("value") % 5000)


for _key, _sec in (("counter_rate", 300), ("counter_rate_6h", 21600)):
    query(_key, _rate(_sec).replace("{samples}", RESET), "rate")(
        lambda s, w=_sec: M.counter_rate(_resetting(s), w).drop("labels")
    )
query(
    "cpu_utilisation",
    "select instance, ts, 100.0 - 100.0 * avg(rate) utilisation from ("
    + _rate(21600).replace("{samples}", "{counters_v}")
    + ") group by 1, 2",
    "utilisation",
)(lambda s: M.cpu_utilisation(s.counters, 21600))

_PAIR = (
    "(select instance, ts, max(\"value\") filter (metric = 'size') sz, max(\"value\") filter (metric = 'avail') av "
    "from {gauges_v} group by 1, 2)"
)
query("disk_used_pct", f"select instance, ts, 100.0 - av / nullif(sz, 0) * 100.0 used_pct from {_PAIR}", "used_pct")(
    lambda s: M.disk_used_pct(s.gauges)
)
query("mem_used_pct", f"select instance, ts, (sz - av) / nullif(sz, 0) * 100.0 used_pct from {_PAIR}", "used_pct")(
    lambda s: M.mem_used_pct(s.gauges)
)


def _alert(thr: int, sec: int) -> str:
    return (
        "select instance, start_ts, end_ts, samples, peak, start_ts + "
        f"interval {sec} second fires_at from (select instance, min(ts) start_ts, max(ts) end_ts, count(*) samples, "
        "max(used_pct) peak from (select *, row_number() over (partition by instance order by ts) - row_number() over "
        f"(partition by instance, used_pct > {thr} order by ts) g from (select instance, ts, 100.0 - av / nullif(sz, 0) * "
        f"100.0 used_pct from {_PAIR})) where used_pct > {thr} group by instance, g) "
        f"where epoch_us(end_ts) - epoch_us(start_ts) >= {sec}000000"
    )


query("sustained_alert", _alert(30, 3600), "peak")(
    lambda s: M.sustained_alert(M.disk_used_pct(s.gauges), "used_pct", 30, 3600)
)
query("sustained_alert_now", _alert(90, 0), "peak")(
    lambda s: M.sustained_alert(M.disk_used_pct(s.gauges), "used_pct", 90, 0)
)
query(
    "latest_sample",
    "select metric, instance, last(\"value\" order by ts) \"value\", max(ts) ts from {counters_v} group by 1, 2",
    "value",
)(lambda s: M.latest_sample(s.counters))

_rate_of = lambda c, t: f"select '{c}' \"column\", count(*) filter ({c} is null) / count(*) null_rate from {t}"
query("null_rates", " union all ".join(_rate_of(c, "{features_v}") for c in FEATURE_COLS), "null_rate")(
    lambda s: Q.null_rates(s.features, FEATURE_COLS)
)
query(
    "null_threshold_gate",
    "select * from (" + " union all ".join(_rate_of(c, "{features_v}") for c in FEATURE_COLS) + ") where null_rate > 0.005",
    "null_rate",
)(lambda s: Q.null_threshold_gate(s.features, 0.005, FEATURE_COLS))
_FULL = " and ".join(f"{c} is not null" for c in FEATURE_COLS)
query(
    "drop_incomplete",
    "select *, (1 - rows_after / rows_before) * 100 null_percentage from (select count(*) rows_before, "
    f"count(*) filter ({_FULL}) rows_after from {{features_v}})",
    "null_percentage",
)(lambda s: Q.drop_report(s.features, FEATURE_COLS))
query(
    "drop_incomplete_rows",
    f"select {E_}, asof_ts, f_ret_5 from {{features_v}} where {_FULL}",
    "f_ret_5",
)(lambda s: Q.drop_incomplete(s.features, FEATURE_COLS).select(*ENTITY, "asof_ts", "f_ret_5"))

_ZERO = "(select * replace (case when tcnt % 97 = 0 then 0 when tcnt % 89 = 0 then -price else price end as price) from {silver_v})"
query(
    "price_outliers",
    f"select * from (select {E_}, ts, tcnt, price, price = 0 zero_price, price < 0 negative_price, coalesce(abs(price - p) / "
    f"nullif(abs(p), 0) > 0.5, false) price_jump from (select *, lag(price) over (partition by {E_} order by ts, tcnt) p "
    f"from {_ZERO})) where zero_price or negative_price or price_jump",
    "price",
)(
    lambda s: Q.price_outliers(
        s.silver.withColumn(
            "price",
            F.when(F.col("tcnt") % 97 == 0, 0.0).when(F.col("tcnt") % 89 == 0, -F.col("price")).otherwise(F.col("price")),
        )
    )
)


def _twice(s):
    """Every tick ingested once, even sequence numbers a second time with a later ingest time and another price."""
    first = s.ticks.withColumn("ingest_ts", F.lit("2024-02-01T00:00:00").cast("timestamp"))
    again = (
        s.ticks.where("tcnt % 2 = 0")
        .withColumn("ingest_ts", F.lit("2024-02-02T00:00:00").cast("timestamp"))
        .withColumn("c", F.col("c") + 1)
    )
    return first.unionByName(again)


query(
    "duplicate_ticks",
    f"select {E_}, tdate, tcnt, cast(2 as bigint) copies from {{ticks_v}} where tcnt % 2 = 0",
)(lambda s: Q.duplicate_ticks(_twice(s)))
query(
    "dedupe_ticks",
    "select * replace (case when tcnt % 2 = 0 then c + 1 else c end as c), case when tcnt % 2 = 0 then timestamp "
    "'2024-02-02 00:00:00' else timestamp '2024-02-01 00:00:00' end ingest_ts from {ticks_v}",
    "c o h l oi",
)(lambda s: Q.dedupe_ticks(_twice(s)))
query(
    "time_reversals",
    f"select * from (select {E_}, ts, tcnt, lag(ts) over (partition by {E_} order by tcnt, ts) prev_ts from "
    "(select * replace (tcnt - tcnt % 8 + (7 - tcnt % 8) as tcnt) from {silver_v})) where ts < prev_ts",
)(
    lambda s: Q.time_reversals(
        s.silver.withColumn("tcnt", F.col("tcnt") - F.col("tcnt") % 8 + (7 - F.col("tcnt") % 8))
    )
)

_RULES = {"user_id": ("bigint", True), "value": ("double", True), "event_type": ("string", True)}


def _texts(s):
    return s.events.select(
        "event_id",
        F.when(F.col("k") != 5, F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("k") % 10 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        "event_type",
    )


query(
    "enforce_schema",
    "select event_id, user_id, \"value\", event_type from {ev_v} where k <> 5 and k % 10 <> 0",
    "value",
)(lambda s: Q.enforce_schema(_texts(s), _RULES))
query(
    "quarantine",
    "select event_id, case when k <> 5 then cast(user_id as varchar) end user_id, event_type, case when k = 5 then "
    "'user_id: missing' else 'value: not double' end reason from {ev_v} where k = 5 or k % 10 = 0",
)(lambda s: Q.quarantine(_texts(s), _RULES).drop("value"))

query(
    "feature_stats",
    " union all ".join(
        f"select '{c}' \"column\", avg({c}) mean, stddev_samp({c}) std, min({c}) \"min\", max({c}) \"max\", 7 feature_count "
        "from {features_v}"
        for c in FEATURE_COLS
    ),
    "mean std min max",
)(lambda s: Q.feature_stats(s.features, FEATURE_COLS))
query(
    "layer_metrics",
    "with m as (select count(*)::double i, count(distinct code)::double u, count(*) filter (price > 1)::double c, "
    "(select count(*) from {bars_v})::double g from {silver_v}) select 'bronze' layer, 'rows_ingested' \"key\", i "
    "\"value\" from m union all select 'bronze', 'unique_symbols', u from m union all select 'silver', 'rows_cleaned', c "
    "from m union all select 'silver', 'rows_filtered', i - c from m union all select 'silver', 'quality_score', c / i "
    "from m union all select 'gold', 'rows_aggregated', g from m",
    "value",
)(lambda s: Q.layer_metrics(s.ticks, s.silver.where("price > 1"), s.bars))
