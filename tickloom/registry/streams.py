"""Streaming queries: the given tables are read as file streams and run to their end.

Windows still open at the end of the input are not emitted, so the oracles keep closed windows only.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learning as L
from ..session import scratch_path
from ..sources.adapters import Inputs
from ..streaming import events as E
from ..streaming import market as M
from ..streaming.run import collect_stream
from .base import E_, query
from .market import FEATS, FEATS_D

EVENTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


class StreamInputs(Inputs):
    """The same derived views over a stream of the events file."""

    def table(self, name: str):
        reader = self.spark.readStream.schema(EVENTS).option("pathGlobFilter", f"{name}.parquet")
        return reader.parquet(self.sf_dir)


def _streamed(s) -> StreamInputs:
    return StreamInputs(s.spark, s.sf_dir)


_CLOSED = "bar_ts + interval 1 hour <= (select max(ts) from events) - interval 10 minute"
query(
    "stream_bars",
    f"select {E_}, bar_ts, o, h, l, c, v, tick_count, oi_last, trade_date from {{bars_v}} where {_CLOSED}",
    "o h l c oi_last",
)(lambda s: collect_stream(M.stream_bars(_streamed(s).silver, "1 hour"), "stream-bars"))


@query(
    "stream_features",
    f"select {E_}, asof_ts, {FEATS}, trade_date from {{features_v}} where "
    + _CLOSED.replace("bar_ts", "asof_ts"),
    FEATS_D,
)
def _features(s):
    out, state, check = (scratch_path(s.spark, n) for n in ("stream-features", "stream-tails", "stream-features-cp"))
    M.stream_features(M.stream_bars(_streamed(s).silver, "1 hour"), out, state, check, bar_s=3600)
    return s.spark.read.parquet(out).drop("batch")


@query(
    "recent_window",
    "select event_id, ts, \"value\" from {ev_v} where ts > (select max(ts) from events) - interval 180 minute",
    "value",
)
def _recent(s):
    rows = _streamed(s).events.select("event_id", "ts", "value")
    state = scratch_path(s.spark, "recent")
    M.recent_window(rows, "ts", 180, state, scratch_path(s.spark, "recent-cp"))
    return M.latest_state(s.spark, state, rows.schema)


query(
    "stream_error_bursts",
    "select ws window_start, ws + interval 600 minute window_end, count(*) errors from (select unnest(generate_series("
    "to_timestamp(floor(epoch(event_time) / 3600) * 3600)::timestamp - interval 540 minute, "
    "to_timestamp(floor(epoch(event_time) / 3600) * 3600)::timestamp, interval 60 minute)) ws "
    "from {logs_v} where \"level\" = 'ERROR') group by ws having count(*) > 25 and ws + interval 600 minute <= "
    "(select max(event_time) from {logs_v} where \"level\" = 'ERROR') - interval 10 minute",
)(
    lambda s: collect_stream(
        E.stream_error_bursts(_streamed(s).logs, limit=25, window="600 minutes", slide="60 minutes"), "stream-bursts"
    )
)


@query(
    "late_data",
    "select b batch_id, count(*) row_count, count(*) filter (ts < prior - interval 10 minute) late_rows, max(ts) max_ts, "
    "coalesce(max(epoch(date_trunc('second', prior))::bigint) - min(epoch(date_trunc('second', ts))::bigint) > 3600, false) conservative from "
    "(select ts, event_id % 4 b, prior from events join (select b, max(m) over (order by b rows between unbounded "
    "preceding and 1 preceding) prior from (select event_id % 4 b, max(ts) m from events group by 1)) p "
    "on p.b = event_id % 4) group by 1",
)
def _late(s):
    """Events delivered out of order in four parts, one micro-batch each: the stream goes on when the next has come."""
    feed, out, state, check = (scratch_path(s.spark, n) for n in ("late-feed", "late-out", "late-state", "late-cp"))
    rows = s.events.select("event_id", "ts")
    for part in range(4):
        rows.where(F.col("event_id") % 4 == part).write.parquet(f"{feed}/part={part}")
        stream = s.spark.readStream.schema("event_id BIGINT, ts TIMESTAMP").option("recursiveFileLookup", "true").parquet(feed)
        E.late_data(stream, "ts", 600, 3600, out, state, check)
    return s.spark.read.parquet(out).drop("batch")


@query("stream_ingest", "select event_id, ts, event_type, \"value\" from events", "value")
def _stream_ingest(s):
    """JSON files that hold every event twice."""
    feed = scratch_path(s.spark, "ingest-feed")
    rows = s.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "event_type", "value")
    rows.unionByName(rows).write.json(feed)
    raw = s.spark.readStream.schema("event_id BIGINT, ts TIMESTAMP, event_type STRING, value DOUBLE").json(feed)
    return collect_stream(E.stream_ingest(raw, ["event_id"], "ts"), "stream-ingest")


@query(
    "stream_score",
    "select 'options:' || ymcode || ':' || side || ':' || code || ':' || strike || ':' || "
    "strftime(asof_ts, '%Y-%m-%dT%H:%M:%SZ') feature_key, asof_ts, (f_ret_5 - f_ret_1) / 1000.0 pred, case when (f_ret_5 - "
    "f_ret_1) / 1000.0 > 0.001 then 'BUY' when (f_ret_5 - f_ret_1) / 1000.0 < -0.001 then 'SELL' else 'HOLD' end decision "
    "from {features_v}",
    "pred",
)
def _score(s):
    feed = scratch_path(s.spark, "feature-feed")
    s.features.write.parquet(feed)
    stream = s.spark.readStream.schema(s.features.schema).parquet(feed)
    scorer = L.linear_score((F.col("f_ret_5") - F.col("f_ret_1")) / 1000.0)
    return collect_stream(M.stream_score(stream, scorer), "stream-score")
