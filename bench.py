"""Times headline queries and prints one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores. Every query runs to a sink that reads all its rows and
columns; the time is the best of two runs. `gold_tables` is the time to build the stored bars, features, labels and
training set once, which the other queries then read, as the jobs of a pipeline do.
"""
from __future__ import annotations

import json
import os
import time

from tickloom.registry import QUERIES
from tickloom.session import build_session
from tickloom.sources.adapters import Inputs, forget_stored

HEADLINE = [
    # bars, features, labels and their joins
    "ohlc_bars", "ohlc_bars_1m", "rollup_bars", "features", "features_time", "labels", "training_set", "macd", "pit_join",
    "fill_gaps", "dim_contract", "latest_per_key",
    # dashboards
    "table_row_count", "symbol_counts", "symbol_volume", "daily_symbol_stats", "symbol_24h", "symbol_window_scan",
    "price_line", "price_series",
    # logs and media
    "log_json_extract", "recent_errors", "search_messages", "error_trend", "error_rate", "log_documents", "page",
    "search_media", "media_summary", "duplicate_objects", "size_histogram",
    # metrics, quality, evaluation, risk
    "counter_rate", "sustained_alert", "dedupe_ticks", "price_outliers", "null_rates", "feature_drift_psi", "auc",
    "max_drawdown", "risk_gate", "orderbook_features", "implied_vol_greeks",
    # models
    "train_regressor", "random_search", "train_classifier",
    # streaming
    "stream_bars",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "tickloom-bench",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.showConsoleProgress": "false",
        },
        master=f"local[{cpus}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    Inputs(spark, sf_dir).table("events").count()  # start the executors

    def gold() -> None:
        forget_stored()
        inputs = Inputs(spark, sf_dir)
        for name in ("bars", "bars_1m", "features", "labels", "training", "quotes_by_day"):
            getattr(inputs, name)

    times = {"gold_tables": min(timed(gold), timed(gold))}
    for key in HEADLINE:
        run = lambda: QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = min(timed(run), timed(run))
    result = {
        "metric": "headline queries, wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
