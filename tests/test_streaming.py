"""Streams against their batch twins: ordered, shuffled and late input, several micro-batches, restarts."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import features as X
from tickloom.operators import learning as L
from tickloom.operators.joins import parity_diff
from tickloom.schemas import ENTITY
from tickloom.session import scratch_path
from tickloom.sources.adapters import Inputs
from tickloom.streaming import events as E
from tickloom.streaming import market as M
from tickloom.streaming.run import collect_stream, run_to_parquet

BATCHES = 4


def ordered_feed(spark, silver, name):
    """Ticks in files by time, and a last file with one tick far after the end that closes every window."""
    feed = scratch_path(spark, name)
    lo, hi = silver.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / BATCHES
    for i in range(BATCHES):
        start, end = lo + i * step, lo + (i + 1) * step
        upper = F.col("ts") <= F.lit(hi) if i == BATCHES - 1 else F.col("ts") < F.lit(end)
        silver.where((F.col("ts") >= F.lit(start)) & upper).coalesce(1).write.parquet(f"{feed}/p={i}")
    last = silver.where(F.col("ts") == F.lit(hi)).limit(1)
    flush = last.withColumns({"ts": F.expr("ts + interval 10 days"), "code": F.lit("flush")})
    flush.withColumn("trade_date", F.to_date("ts")).coalesce(1).write.parquet(f"{feed}/p={BATCHES}")
    return feed


def one_file_at_a_time(spark, feed, schema):
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(feed)
    )


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return Inputs(spark, sf_dir)


@pytest.fixture(scope="module")
def feed(spark, inputs):
    return ordered_feed(spark, inputs.silver, "ordered")


def test_ordered_bars_equal_batch(spark, inputs, feed):
    silver = inputs.silver
    stream = M.stream_bars(one_file_at_a_time(spark, feed, silver.schema), "1 hour")
    got = collect_stream(stream, "bars").where("code <> 'flush'")
    want = B.ohlc_bars(silver, "1 hour")
    assert got.count() == want.count()
    for col in ("o", "h", "l", "c", "oi_last"):
        assert parity_diff(want, got, [*ENTITY, "bar_ts"], col).count() == 0


def test_features_over_several_batches_equal_batch(spark, inputs, feed):
    silver = inputs.silver
    stream = M.stream_bars(one_file_at_a_time(spark, feed, silver.schema), "1 hour")
    out, state, check = (scratch_path(spark, n) for n in ("f-out", "f-state", "f-check"))
    M.stream_features(stream, out, state, check, bar_s=3600)
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() > 2
    got = got.drop("batch").where("code <> 'flush'")
    want = X.features(B.ohlc_bars(silver, "1 hour"), bar_s=3600)
    assert got.count() == want.count()
    for col in ("f_ret_1", "f_ret_5", "f_vol_20", "f_range_5", "f_oi_chg_5"):
        assert parity_diff(want, got, [*ENTITY, "asof_ts"], col).count() == 0


def test_shuffled_input_drops_late_rows_and_counts_them(spark, inputs):
    silver = inputs.silver
    feed = scratch_path(spark, "shuffled")
    for i in range(BATCHES):
        silver.where(F.col("tcnt") % BATCHES == i).coalesce(1).write.parquet(f"{feed}/p={i}")
    source = one_file_at_a_time(spark, feed, silver.schema)
    bars = collect_stream(M.stream_bars(source, "1 hour"), "shuffled-bars")
    assert bars.agg(F.sum("tick_count")).first()[0] < silver.count()
    out, state, check = (scratch_path(spark, n) for n in ("l-out", "l-state", "l-check"))
    E.late_data(one_file_at_a_time(spark, feed, silver.schema), "ts", 600, 3600, out, state, check)
    rows = spark.read.parquet(out).orderBy("batch_id").collect()
    assert sum(r.row_count for r in rows) == silver.count()
    assert rows[0].late_rows == 0 and all(r.late_rows > 0.9 * r.row_count for r in rows[1:])
    assert [r.conservative for r in rows] == [False, True, True, True]


def tick_rows(spark, silver, offsets):
    base = dt.datetime(2024, 1, 10, 12)
    one = silver.limit(1)
    out = None
    for i, s in enumerate(offsets):
        ts = F.lit(base + dt.timedelta(seconds=s))
        row = one.withColumns({"ts": ts, "tcnt": F.lit(i).cast("long"), "trade_date": F.to_date(ts)})
        out = row if out is None else out.unionByName(row)
    return out


def test_slightly_late_is_kept_and_too_late_is_dropped(spark, inputs):
    silver = inputs.silver.withColumn("code", F.lit("x")).withColumn("strike", F.lit(1))
    feed = scratch_path(spark, "late")
    # the third file is 5 minutes late; the sixth comes after its hour was emitted. The watermark that decides on late
    # rows is the one of the batch before, hence the file in between
    for i, offsets in enumerate(([0, 60], [3500], [3200], [9000], [9100], [10], [200_000])):
        tick_rows(spark, silver, offsets).coalesce(1).write.parquet(f"{feed}/p={i}")
    bars = collect_stream(M.stream_bars(one_file_at_a_time(spark, feed, silver.schema), "1 hour"), "late-bars")
    counts = [r.tick_count for r in bars.orderBy("bar_ts").collect()]
    assert counts == [4, 2]


def test_recent_window_rolls(spark, inputs, feed):
    silver = inputs.silver
    source = one_file_at_a_time(spark, feed, silver.schema).where("code <> 'flush'").select("tcnt", "ts")
    state = scratch_path(spark, "recent-state")
    M.recent_window(source, "ts", 600, state, scratch_path(spark, "recent-check"))
    got = {r.tcnt for r in M.latest_state(spark, state, source.schema).collect()}
    newest = silver.agg(F.max("ts")).first()[0]
    want = silver.where(F.col("ts") > F.lit(newest - dt.timedelta(minutes=600)))
    assert got == {r.tcnt for r in want.collect()} and got


def test_recent_window_rewrites_no_older_row(spark, inputs, feed):
    """Files of the log stay as they are until their minute is dropped whole; a repeated batch changes nothing."""
    import glob
    import os

    source = one_file_at_a_time(spark, feed, inputs.silver.schema).where("code <> 'flush'").select("tcnt", "ts")
    state, seen = scratch_path(spark, "recent-log"), []
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{state.removeprefix('file:')}/log/*/*/*.parquet")}
    real = M.run_batches

    def watched(rows, step, checkpoint):
        def noted(batch, batch_id):
            step(batch, batch_id)
            seen.append(files())
            if batch_id == 1:
                step(batch, batch_id)
                seen[-1] = files()

        real(rows, noted, checkpoint)

    M.run_batches = watched
    try:
        M.recent_window(source, "ts", 600, state, scratch_path(spark, "recent-log-check"))
    finally:
        M.run_batches = real
    assert len(seen) >= BATCHES
    for before, after in zip(seen[1:], seen[2:]):
        kept = set(before) & set(after)
        assert all(before[f] == after[f] for f in kept)
    newest = inputs.silver.agg(F.max("ts")).first()[0]
    minutes = {int(f.split("tl_minute=")[1].split("/")[0]) for f in seen[-1]}
    assert min(minutes) >= int((newest - dt.timedelta(minutes=600)).replace(tzinfo=dt.timezone.utc).timestamp() // 60)
    want = inputs.silver.where(F.col("ts") > F.lit(newest - dt.timedelta(minutes=600))).count()
    assert M.latest_state(spark, state, source.schema).count() == want


def test_ingest_keeps_each_key_once_in_state(spark, inputs):
    rows = inputs.events.select("event_id", "ts").limit(100)
    feed = scratch_path(spark, "s-feed")
    rows.unionByName(rows).unionByName(rows).repartition(3).write.parquet(feed)
    stream = E.stream_ingest(spark.readStream.schema("event_id BIGINT, ts TIMESTAMP").parquet(feed), ["event_id"], "ts", "900 days")
    run = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "s-check")).trigger(availableNow=True).start()
    run.awaitTermination()
    states = [s for p in run.recentProgress for s in p["stateOperators"]]
    assert len(run.lastProgress["stateOperators"]) == 1 and max(s["numRowsTotal"] for s in states) == 100


def test_copies_within_a_batch(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (None, 2.5, "c"), (None, 2.5, "d"), (1, 2.5, "e")], "k INT, v DOUBLE, w STRING").coalesce(1)
    assert [r.w for r in E.without_copies(rows, ["k", "v"]).collect()] == ["a", "c", "e"]


def test_ingest_drops_copies_and_survives_a_restart(spark, inputs):
    rows = inputs.events.select("event_id", "ts").orderBy("ts").limit(100)
    feed, out, check = (scratch_path(spark, n) for n in ("i-feed", "i-out", "i-check"))
    schema = "event_id BIGINT, ts TIMESTAMP"

    def run():
        stream = E.stream_ingest(spark.readStream.schema(schema).parquet(feed), ["event_id"], "ts", "60 days")
        run_to_parquet(stream, out, check)

    rows.unionByName(rows).write.parquet(feed)
    run()
    assert spark.read.parquet(out).count() == 100
    rows.withColumn("event_id", F.col("event_id") + 1_000_000).unionByName(rows).write.mode("append").parquet(feed)
    run()  # same checkpoint: only the new file is read, and its old keys are known
    assert spark.read.parquet(out).count() == 200


def test_stream_scoring_with_a_model(spark, inputs):
    model = L.train_regressor(inputs.training, max_iter=2)
    feed = scratch_path(spark, "score-feed")
    inputs.training.write.parquet(feed)
    stream = spark.readStream.schema(inputs.training.schema).parquet(feed)
    log = collect_stream(M.stream_score(stream, L.score_with(model)), "score-log")
    assert log.count() == inputs.training.count()
    assert log.where("decision not in ('BUY', 'SELL', 'HOLD') or pred is null").count() == 0


def test_error_bursts_stream_equals_batch(spark, inputs):
    from tickloom.operators.logs import error_bursts

    logs = inputs.logs
    feed = scratch_path(spark, "logs-feed")
    logs.coalesce(1).write.parquet(feed)
    flush = logs.where("level = 'ERROR'").limit(1).withColumn("event_time", F.expr("timestamp'2025-01-01 00:00:00'"))
    flush.coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(logs.schema).parquet(feed)
    got = collect_stream(E.stream_error_bursts(stream, 5, "10 hours", "1 hour"), "bursts")
    want = error_bursts(logs, 5, "10 hours", "1 hour")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert want.count() > 0
