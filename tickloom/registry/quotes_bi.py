"""Dashboard queries over quotes."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import bi as Q
from ..operators import joins as J
from ..session import materialise, scratch_path
from ..sources import tables as T
from .base import query

ASOF = "(select max(ts) from events)"
SYMS = ["click", "error", "purchase", "signup", "view"]
QD = "bid_price ask_price last_price"

query("scan_table", "select * from lineitem", "l_quantity l_extendedprice l_discount l_tax")(
    lambda s: _catalog_scan(s)
)


def _catalog_scan(s):
    s.table("lineitem").createOrReplaceTempView("lineitem_scan")
    return T.scan_table(s.spark, "lineitem_scan")


query("scan_parquet", "select * from orders", "o_totalprice")(
    lambda s: T.scan_parquet(s.spark, f"{s.sf_dir}/orders.parquet")
)
query("table_row_count", "select count(*) n from lineitem")(lambda s: Q.table_row_count(s.table("lineitem")))

query(
    "price_series",
    f'select "timestamp", symbol, last_price from {{quotes_v}} where "timestamp" >= {ASOF} - interval 7 day',
    "last_price",
)(lambda s: Q.price_series(s.quotes, s.as_of))

query(
    "symbol_window_scan",
    f"select * from {{quotes_v}} where symbol = 'click' and \"timestamp\" >= {ASOF} - interval 1 day",
    QD,
)(lambda s: Q.symbol_window_scan(s.quotes_by_day, "click", s.as_of).drop("quote_date"))

query(
    "dashboard_filters",
    "select * from {quotes_v} where cast(\"timestamp\" as date) between date '2024-01-05' and date '2024-01-09' "
    "and symbol in ('click', 'view')",
    QD,
)(
    lambda s: Q.dashboard_filters(
        s.quotes, date_from=dt.date(2024, 1, 5), date_to=dt.date(2024, 1, 9), symbol=["click", "view"], exchange=None
    )
)

query("symbol_counts", "select symbol, count(*) n, avg(last_price) avg_price from {quotes_v} group by 1", "avg_price")(
    lambda s: Q.symbol_counts(s.quotes)
)
query(
    "symbol_volume",
    f"select symbol, cast(sum(volume) as bigint) total_volume from {{quotes_v}} "
    f'where "timestamp" >= {ASOF} - interval 7 day group by 1',
)(lambda s: Q.symbol_volume(s.quotes, s.as_of))
query(
    "daily_symbol_stats",
    'select cast("timestamp" as date) "day", symbol, avg(last_price) avg_price, cast(sum(volume) as bigint) total_volume '
    f'from {{quotes_v}} where "timestamp" >= {ASOF} - interval 30 day group by 1, 2',
    "avg_price",
)(lambda s: Q.daily_symbol_stats(s.quotes, s.as_of))
query(
    "daily_pivot",
    'select cast("timestamp" as date) "day", '
    + ", ".join(
        f"avg(last_price) filter (symbol = '{y}') {y}_avg_price, "
        f"cast(sum(volume) filter (symbol = '{y}') as bigint) {y}_total_volume"
        for y in SYMS
    )
    + f' from {{quotes_v}} where "timestamp" >= {ASOF} - interval 30 day group by 1',
    " ".join(f"{y}_avg_price" for y in SYMS),
)(lambda s: Q.daily_pivot(s.quotes, s.as_of, SYMS))
query(
    "symbol_24h",
    "select symbol, count(*) n, avg(last_price) avg_price, max(last_price) max_price, min(last_price) min_price "
    f'from {{quotes_v}} where "timestamp" >= {ASOF} - interval 1 day group by 1 order by n desc, symbol limit 20',
    "avg_price max_price min_price",
)(lambda s: Q.symbol_24h(s.quotes, s.as_of))


@query(
    "refresh_daily_stats",
    'select symbol, avg(last_price) avg_price, cast(sum(volume) as bigint) total_volume, count(*) n, '
    'cast("timestamp" as date) "day" from {quotes_v} group by symbol, cast("timestamp" as date)',
    "avg_price",
)
def _refresh(s):
    path = scratch_path(s.spark, "daily_stats")
    changed = [dt.date(2024, 1, 10), dt.date(2024, 1, 11)]
    stale = Q.daily_stats(s.quotes).withColumn(
        "n", F.when(F.col("day").isin(changed), F.lit(0).cast("long")).otherwise(F.col("n"))
    )
    T.overwrite_partitions(stale, path, ["day"])
    Q.refresh_daily_stats(s.quotes, path, changed)
    return s.spark.read.parquet(path)


query(
    "avg_price_prev_day",
    "select symbol, avg(last_price) avg_price from {quotes_v} "
    f'where cast("timestamp" as date) = cast({ASOF} as date) - 1 group by 1',
    "avg_price",
)(lambda s: Q.avg_price_prev_day(s.quotes, s.as_of))
query(
    "price_line",
    "select date_trunc('hour', \"timestamp\") bucket, symbol, avg(last_price) avg_price from {quotes_v} group by 1, 2",
    "avg_price",
)(lambda s: Q.price_line(s.quotes))
query("distinct_symbols", "select count(distinct symbol) n_distinct from {quotes_v}")(
    lambda s: Q.distinct_count(s.quotes, "symbol")
)
query(
    "volume_change_vs_prev_day",
    'select "day", total_volume, 100.0 * (total_volume::double / nullif(lag(total_volume) over (order by "day"), 0) - 1) '
    'pct_change from (select cast("timestamp" as date) "day", cast(sum(volume) as bigint) total_volume from {quotes_v} '
    "group by 1)",
    "pct_change",
)(lambda s: Q.volume_change_vs_prev_day(s.quotes))
query(
    "latest_rows",
    'select * from {quotes_v} order by "timestamp" desc, event_id desc limit 5',
    QD,
)(lambda s: Q.latest_rows(s.quotes, [F.desc("timestamp"), F.desc("event_id")], 5))


@query("preview", "select least(count(*), 10) n_rows, least(count(*), 10) n_found from {quotes_v}")
def _preview(s):
    """Any rows will do, so the answer is how many there are and how many of them the table holds."""
    shown = materialise(Q.preview(s.quotes, 10), "preview")
    found = shown.join(s.quotes.select("event_id", F.col("timestamp").alias("_at")), "event_id", "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", found.agg(F.count(F.lit(1))).scalar().alias("n_found"))


query(
    "sample_rows",
    "select o_orderkey, o_totalprice from orders order by md5(o_orderkey || ':42') limit 100",
    "o_totalprice",
)(lambda s: Q.sample_rows(s.table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100))
query(
    "row_filter",
    "select q.* from {quotes_v} q where symbol in ('click', 'purchase')",
    QD,
)(lambda s: Q.row_filter(s.quotes, _grants(s), "analyst"))


def _grants(s):
    """Grants derived from the data: the analyst sees clicks and purchases, the auditor everything."""
    symbols = s.quotes.select(F.col("symbol").alias("value")).distinct()
    users = F.array(F.lit("auditor"), F.when(F.col("value").isin("click", "purchase"), F.lit("analyst")))
    return symbols.select("value", F.explode(F.array_compact(users)).alias("user"))


query(
    "mask_columns",
    "select c_custkey, sha256(c_name) c_name, regexp_replace(c_mktsegment || c_nationkey, '[0-9]', '#', 'g') seg, "
    "'****' || right(cast(c_custkey as varchar), 4) key_tail, cast(null as varchar) c_acctbal from customer",
)(
    lambda s: Q.mask_columns(
        s.table("customer").select(
            "c_custkey",
            "c_name",
            F.concat("c_mktsegment", "c_nationkey").alias("seg"),
            F.col("c_custkey").alias("key_tail"),
            F.col("c_acctbal").cast("string").alias("c_acctbal"),
        ),
        {"c_name": "hash", "seg": "digits", "key_tail": "keep_last4", "c_acctbal": "null"},
    )
)


@query(
    "federated_join",
    "select o_orderkey, o_totalprice, c_name, c_mktsegment from orders left join customer on o_custkey = c_custkey",
    "o_totalprice",
)
def _federated(s):
    """The external side is a second source (CSV files) with its own schema."""
    path = scratch_path(s.spark, "external_customer")
    T.export_csv(s.table("customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    external = s.spark.read.csv(path, header=True, schema="c_custkey BIGINT, c_name STRING, c_mktsegment STRING")
    lake = s.table("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.federated_join(lake, external, ["c_custkey"]).drop("c_custkey")


query(
    "apply_retention",
    f"select event_time, \"level\", message from {{logs_v}} where cast(event_time as date) >= cast({ASOF} as date) - 7",
)(
    lambda s: T.apply_retention(
        s.logs.withColumn("log_date", F.to_date("event_time")), "log_date", s.as_of.date(), 7
    ).select("event_time", "level", "message")
)
