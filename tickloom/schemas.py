"""Row schemas and table definitions."""
from __future__ import annotations

ENTITY = ["ymcode", "side", "code", "strike"]

FEATURE_COLS = ["f_ret_1", "f_ret_5", "f_vol_20", "f_range_5", "f_oi_chg_5", "f_spread_proxy", "f_iv_proxy"]

# Column names and types of the stored tables.
TICK_XML = (
    "ymcode STRING, code STRING, strike INT, idate INT, itime INT, tdate TIMESTAMP, tcnt BIGINT, "
    "c DOUBLE, o DOUBLE, h DOUBLE, l DOUBLE, oi DOUBLE, ccnt BIGINT"
)
CODE_XML = "ymcode STRING, code STRING, lastday INT"
LOG_JSON = "event_time STRING, level STRING, message STRING, meta STRING"

# name -> (columns, partition columns)
TABLES = {
    "bronze_ticks": ("src_file STRING, side STRING, " + TICK_XML + ", ingest_ts TIMESTAMP, tick_date DATE", "tick_date, side"),
    "bronze_codes": ("src_file STRING, side STRING, " + CODE_XML + ", ingest_ts TIMESTAMP", "side, ymcode"),
    "silver_ticks": (
        "ymcode STRING, side STRING, code STRING, strike INT, ts TIMESTAMP, tcnt BIGINT, price DOUBLE, open DOUBLE, "
        "high DOUBLE, low DOUBLE, oi DOUBLE, ccnt BIGINT, trade_date DATE, minute_ts TIMESTAMP, ingest_ts TIMESTAMP",
        "trade_date, side",
    ),
    "dim_contract": (
        "ymcode STRING, side STRING, code STRING, strike INT, lastday INT, effective_from DATE, effective_to DATE",
        "ymcode, side",
    ),
    "gold_bars_1m": (
        "ymcode STRING, side STRING, code STRING, strike INT, bar_ts TIMESTAMP, o DOUBLE, h DOUBLE, l DOUBLE, c DOUBLE, "
        "v BIGINT, tick_count BIGINT, oi_last DOUBLE, trade_date DATE",
        "trade_date",
    ),
    "gold_features_1m": (
        "ymcode STRING, side STRING, code STRING, strike INT, asof_ts TIMESTAMP, "
        + ", ".join(f"{c} DOUBLE" for c in FEATURE_COLS)
        + ", trade_date DATE",
        "trade_date",
    ),
    "gold_labels_1m": (
        "ymcode STRING, side STRING, code STRING, strike INT, asof_ts TIMESTAMP, y_fwd_ret_5 DOUBLE, "
        "y_fwd_ret_15 DOUBLE, trade_date DATE",
        "trade_date",
    ),
    "option_quotes": (
        "timestamp TIMESTAMP, symbol STRING, bid_price DOUBLE, bid_size INT, ask_price DOUBLE, ask_size INT, "
        "last_price DOUBLE, volume BIGINT, ingest_time TIMESTAMP, quote_date DATE",
        "quote_date",
    ),
    "raw_logs": (
        "event_time TIMESTAMP, level STRING, message STRING, meta STRING, ingest_time TIMESTAMP, log_date DATE",
        "log_date",
    ),
    "image_metadata": (
        "image_id STRING, s3_path STRING, file_size BIGINT, mime_type STRING, upload_time TIMESTAMP, "
        "source_system STRING, width INT, height INT, checksum STRING, is_indexed BOOLEAN, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, upload_date DATE, tag STRING",
        "upload_date, tag",
    ),
    "run_metrics": (
        "run_id STRING, run_name STRING, layer STRING, key STRING, value DOUBLE, step INT, logged_at TIMESTAMP",
        "layer",
    ),
}

# Derived partition column of each table: (column, timestamp it is taken from).
PARTITION_DATES = {
    "bronze_ticks": ("tick_date", "tdate"),
    "option_quotes": ("quote_date", "timestamp"),
    "raw_logs": ("log_date", "event_time"),
    "image_metadata": ("upload_date", "upload_time"),
}
