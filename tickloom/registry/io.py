"""Sources and sinks: files that Spark derives from the given tables are written, read back and compared."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import logs as G
from ..schemas import ENTITY, LOG_JSON, TICK_XML
from ..session import scratch_path
from ..sources import files as FS
from ..sources import ingest as N
from ..sources import tables as T
from ..sources import xml as X
from .base import E_, new_database, query

TAGS = {"CALL": "TICK_CALL", "PUT": "TICK_PUT"}
STAMP = dt.datetime(2024, 2, 1)


def _tick_xml(s, side: str, path: str | None = None) -> str:
    """Ticks of one side as XML with Korean local times that carry their offset."""
    path = path or scratch_path(s.spark, f"xml-{side.lower()}")
    local = F.from_utc_timestamp("tdate", "Asia/Seoul")
    rows = s.ticks.where(F.col("side") == side).withColumns(
        {
            "idate": F.date_format(local, "yyyyMMdd").cast("int"),
            "itime": F.date_format(local, "HHmmss").cast("int"),
            "tdate": F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+09:00")),
        }
    )
    rows.drop("side").write.format("xml").option("rootTag", "DocumentElement").option("rowTag", TAGS[side]).save(path)
    return path


def _code_xml(s, side: str) -> str:
    path = scratch_path(s.spark, f"xml-code-{side.lower()}")
    rows = s.codes.where(F.col("side") == side).drop("side")
    rows.write.format("xml").option("rootTag", "DocumentElement").option("rowTag", f"CODE_{side}").save(path)
    return path


_XML = "select * exclude (side), strftime(tdate + interval 9 hour, '%Y%m%d')::integer idate, " \
    "strftime(tdate + interval 9 hour, '%H%M%S')::integer itime from {ticks_v} where side = 'CALL'"
query("read_xml", _XML, "c o h l oi")(
    lambda s: X.read_xml(s.spark, _tick_xml(s, "CALL"), "TICK_CALL", TICK_XML).drop("_corrupt_record")
)


@query("detect_row_tag", "select 'TICK_CALL' row_tag, count(*) n from {ticks_v} where side = 'CALL'")
def _detect(s):
    path = _tick_xml(s, "CALL")
    tag = X.detect_row_tag(s.spark, path)
    rows = X.read_xml(s.spark, path, tag, TICK_XML)
    return rows.groupBy(F.lit(tag).alias("row_tag")).agg(F.count("tcnt").alias("n"))


_SIDES = "select * exclude (side), strftime(tdate + interval 9 hour, '%Y%m%d')::integer idate, " \
    "strftime(tdate + interval 9 hour, '%H%M%S')::integer itime, side from {ticks_v}"


@query("read_xml_sides", _SIDES, "c o h l oi")
def _read_sides(s):
    """Both sides, each by its own row tag."""
    sides = [X.read_xml(s.spark, _tick_xml(s, side), tag, TICK_XML).withColumn("side", F.lit(side)) for side, tag in TAGS.items()]
    return sides[0].unionByName(sides[1]).drop("_corrupt_record")


@query("detect_row_tags", "select 'TICK_' || side row_tag, count(*) n from {ticks_v} group by 1")
def _detect_sides(s):
    paths = [_tick_xml(s, side) for side in TAGS]
    rows = [X.read_xml(s.spark, p, tag, TICK_XML).withColumn("row_tag", F.lit(tag)) for p in paths for tag in [X.detect_row_tag(s.spark, p)]]
    return rows[0].unionByName(rows[1]).groupBy("row_tag").agg(F.count("tcnt").alias("n"))


@query(
    "add_provenance_sides",
    "select tcnt, side, timestamp '2024-02-01 00:00:00' ingest_ts, lower(side) folder from {ticks_v}",
)
def _provenance_sides(s):
    """Files of both sides below one root, told apart by their path."""
    root = scratch_path(s.spark, "xml-root")
    rows = [
        X.add_provenance(X.read_xml(s.spark, _tick_xml(s, side, f"{root}/{side.lower()}"), tag, TICK_XML), side, STAMP, root)
        for side, tag in TAGS.items()
    ]
    return rows[0].unionByName(rows[1]).select("tcnt", "side", "ingest_ts", F.split_part("src_file", F.lit("/"), F.lit(1)).alias("folder"))


query(
    "add_provenance",
    "select tcnt, 'PUT' side, timestamp '2024-02-01 00:00:00' ingest_ts, true has_file from {ticks_v} where side = 'PUT'",
)(
    lambda s: X.add_provenance(X.read_xml(s.spark, _tick_xml(s, "PUT"), "TICK_PUT", TICK_XML), "PUT", STAMP).select(
        "tcnt", "side", "ingest_ts", F.col("src_file").startswith("part-").alias("has_file")
    )
)


@query(
    "ingest_bronze",
    f"select {E_}, tdate, tcnt, c, ccnt, cast(tdate as date) tick_date, null::integer lastday from {{ticks_v}} union all "
    "select ymcode, side, code, null, null, null, null, null, null, lastday from {codes_v}",
    "c",
)
def _ingest(s):
    db = new_database(s)
    T.create_tables(s.spark, db, ["bronze_ticks", "bronze_codes"])
    X.ingest_bronze(
        s.spark, _tick_xml(s, "CALL"), _tick_xml(s, "PUT"), _code_xml(s, "CALL"), _code_xml(s, "PUT"), db, STAMP
    )
    ticks = s.spark.table(f"{db}.bronze_ticks").select(*ENTITY, "tdate", "tcnt", "c", "ccnt", "tick_date")
    codes = s.spark.table(f"{db}.bronze_codes").select("ymcode", "side", "code", "lastday")
    return ticks.unionByName(codes, allowMissingColumns=True)


def _log_texts(s):
    return s.logs.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


@query(
    "write_raw_json",
    "select strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') event_time, \"level\", message, meta, cast(event_time as date) "
    "\"date\" from {logs_v}",
)
def _write_json(s):
    path = scratch_path(s.spark, "raw-logs")
    FS.write_raw_json(_log_texts(s), path, F.substring("event_time", 1, 10))
    return FS.read_raw_json(s.spark, path, f"{LOG_JSON}, date DATE", keep_corrupt=False)


@query(
    "load_logs_bronze",
    "select event_time, \"level\", message, meta, cast(event_time as date) log_date from {logs_v}",
)
def _load_logs(s):
    path = scratch_path(s.spark, "raw-logs")
    FS.write_raw_json(_log_texts(s), path, F.substring("event_time", 1, 10))
    db = new_database(s)
    T.create_tables(s.spark, db, ["raw_logs"])
    T.append(FS.load_logs_bronze(FS.read_raw_json(s.spark, path)), f"{db}.raw_logs")
    return s.spark.table(f"{db}.raw_logs").drop("ingest_time")


@query(
    "ingest_logs",
    "select 'raw_logs' as \"table\", \"level\" what, count(*) n from {logs_v} where length(message) % 7 > 0 group by 2 union all "
    "select 'log_quarantine', 'broken JSON', count(*) from {logs_v} where length(message) % 7 = 0 having count(*) > 0",
)
def _ingest_logs(s):
    """Log lines of which some lack their end; both tables by level and by reason."""
    path, db = scratch_path(s.spark, "raw-lines"), new_database(s)
    line = F.to_json(F.struct("event_time", "level", "message", "meta"))
    cut = F.when(F.length("message") % 7 == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    _log_texts(s).select(cut.alias("value")).write.text(path)
    T.create_tables(s.spark, db, ["raw_logs"])
    FS.ingest_logs(s.spark, path, db)
    sound, kept = s.spark.table(f"{db}.raw_logs"), s.spark.table(f"{db}.log_quarantine")
    each = sound.select(F.lit("raw_logs").alias("table"), F.col("level").alias("what")).unionByName(
        kept.select(F.lit("log_quarantine").alias("table"), F.col("reason").alias("what"))
    )
    return each.groupBy("table", "what").agg(F.count(F.lit(1)).alias("n"))


def _filed(s):
    """Ticks as if loaded from one file per instrument code."""
    return s.ticks.withColumn("src_file", F.concat("code", F.lit(".xml")))


@query(
    "idempotent_ingest",
    "select code || '.xml' src_file, count(*) n, max(tcnt) max_tcnt from {ticks_v} where code not in ('click', 'view') group by 1",
)
def _idempotent(s):
    rows = _filed(s)
    manifest = s.stored("manifest", lambda: N.file_summary(rows.where("code in ('click', 'view')")))
    fresh, _ = N.idempotent_ingest(rows, manifest)
    return fresh.groupBy("src_file").agg(F.count(F.lit(1)).alias("n"), F.max("tcnt").alias("max_tcnt"))


query(
    "new_files_only",
    "select src_file, max_tcnt, row_count from (select code || '.xml' src_file, max(tcnt) max_tcnt, count(*) row_count, "
    "max(tcnt) filter (tdate < timestamp '2024-01-15') seen from {ticks_v} group by 1) where not (seen >= max_tcnt)",
)(
    lambda s: N.new_files_only(
        N.file_summary(_filed(s)), N.file_summary(_filed(s).where("tdate < timestamp'2024-01-15 00:00:00'"))
    ).drop("checksum")
)


@query(
    "create_tables",
    'select "timestamp", symbol, bid_price, bid_size, ask_price, ask_size, last_price, volume, '
    'cast("timestamp" as date) quote_date from {quotes_v}',
    "bid_price ask_price last_price",
)
def _create(s):
    db = new_database(s)
    T.create_tables(s.spark, db)
    T.append(s.quotes.drop("event_id"), f"{db}.option_quotes")
    return T.scan_table(s.spark, f"{db}.option_quotes").drop("ingest_time")


_APPENDED = "select * from {bars_v} union all select * from {bars_v}"


@query("append", _APPENDED, "o h l c oi_last")
def _append(s):
    db = new_database(s)
    T.create_tables(s.spark, db, ["gold_bars_1m"])
    T.append(s.bars, f"{db}.gold_bars_1m")
    T.append(s.bars.select(*sorted(s.bars.columns)), f"{db}.gold_bars_1m")  # another column order
    return T.scan_table(s.spark, f"{db}.gold_bars_1m")


@query("append_or_create", _APPENDED, "o h l c oi_last")
def _append_or_create(s):
    table = f"{new_database(s)}.bars"
    T.append_or_create(s.bars, table)
    T.append_or_create(s.bars, table)
    return T.scan_table(s.spark, table)


@query("recreate_table", "select event_time, \"level\" from {logs_v}")
def _recreate(s):
    table = f"{new_database(s)}.logs"
    for _ in range(2):
        T.recreate_table(s.spark, table, "event_time TIMESTAMP, level STRING")
        T.append(s.logs.select("level", "event_time"), table)
    return T.scan_table(s.spark, table)


@query(
    "overwrite_partitions",
    f"select {E_}, bar_ts, case when trade_date = date '2024-01-03' then c + 1 else c end c, trade_date from {{bars_v}}",
    "c",
)
def _overwrite(s):
    path = scratch_path(s.spark, "bars")
    rows = s.bars.select(*ENTITY, "bar_ts", "c", "trade_date")
    T.overwrite_partitions(rows, path, ["trade_date"])
    day = rows.where("trade_date = date'2024-01-03'").withColumn("c", F.col("c") + 1)
    T.overwrite_partitions(day, path, ["trade_date"])
    return s.spark.read.parquet(path)


@query(
    "backfill",
    f"select {E_}, bar_ts, c, v, trade_date from {{bars_v}}",
    "c",
)
def _backfill(s):
    """A damaged date range is recomputed from the ticks; the other dates are left alone."""
    from ..operators.bars import ohlc_bars

    def bars(ticks):
        return ohlc_bars(ticks, "1 hour").select(*ENTITY, "bar_ts", "c", "v", "trade_date")

    path = scratch_path(s.spark, "bars")
    broken = F.col("trade_date").between(dt.date(2024, 1, 5), dt.date(2024, 1, 7))
    damaged = s.bars.select(*ENTITY, "bar_ts", F.when(~broken, F.col("c")).alias("c"), "v", "trade_date")
    T.overwrite_partitions(damaged, path, ["trade_date"])
    T.backfill(s.silver, "ts", dt.date(2024, 1, 5), dt.date(2024, 1, 7), bars, path, ["trade_date"])
    return s.spark.read.parquet(path)


@query("list_tables", "select distinct 'quotes_' || symbol \"tableName\" from {quotes_v}")
def _list_tables(s):
    """One table per symbol, written and listed."""
    db = new_database(s)
    for (symbol,) in s.quotes.where("symbol is not null").select("symbol").distinct().collect():
        T.append_or_create(s.quotes.where(F.col("symbol") == symbol), f"{db}.quotes_{symbol}")
    return T.list_tables(s.spark, db).select("tableName")


@query(
    "drop_old_partitions",
    "select event_time, \"level\", cast(event_time as date) log_date from {logs_v} where cast(event_time as date) >= "
    "(select cast(max(ts) as date) from events) - 10",
)
def _drop_old(s):
    db = new_database(s)
    T.create_tables(s.spark, db, ["raw_logs"])
    T.append(s.logs, f"{db}.raw_logs")
    T.drop_old_partitions(s.spark, f"{db}.raw_logs", "log_date", s.as_of.date(), 10)
    return T.scan_table(s.spark, f"{db}.raw_logs").select("event_time", "level", "log_date")


@query(
    "export_csv",
    "select symbol, count(*) n, avg(last_price) avg_price from {quotes_v} group by 1",
    "avg_price",
)
def _csv(s):
    from ..operators.bi import symbol_counts

    path = scratch_path(s.spark, "csv")
    T.export_csv(symbol_counts(s.quotes), path)
    return s.spark.read.csv(path, header=True, schema="symbol STRING, n BIGINT, avg_price DOUBLE")


@query(
    "read_ticks_csv",
    'select bar_ts "timestamp", c "close", cast(v as double) volume from {bars_1m_v}',
    "close volume",
)
def _ticks_csv(s):
    path = scratch_path(s.spark, "ticks-csv")
    text = F.date_format("bar_ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    cols = [F.col(a).alias(b) for a, b in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("v", "volume"))]
    T.export_csv(s.bars_1m.select(text, *cols), path)
    return FS.read_ticks_csv(s.spark, path, ["timestamp", "close", "volume"])


@query(
    "read_power_csv",
    "select * exclude (k) from {power_v} where k % 50 <> 0",
    "Global_active_power Global_reactive_power Voltage Global_intensity",
)
def _power_csv(s):
    path = scratch_path(s.spark, "power-csv")
    gap = F.col("k") % 50 == 0
    rows = s.power.select(
        F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"),
        "Global_active_power",
        "Global_reactive_power",
        F.when(gap, "?").otherwise(F.col("Voltage").cast("string")).alias("Voltage"),
        "Global_intensity",
    )
    rows.write.option("header", True).option("sep", ";").csv(path)
    return FS.read_power_csv(s.spark, path)


@query(
    "read_text_logs",
    "select \"level\" service, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || ' ' || \"level\" || ' ' || message message, "
    "true has_path from {logs_v}",
)
def _text_logs(s):
    paths = {}
    for service in ("INFO", "WARN", "ERROR"):
        paths[service] = scratch_path(s.spark, f"text-{service.lower()}")
        lines = _log_texts(s).where(F.col("level") == service).select(F.concat_ws(" ", "event_time", "level", "message"))
        lines.write.text(paths[service])
    rows = FS.read_text_logs(s.spark, paths)
    return rows.select("service", "message", F.col("file_path").contains("/tickloom/text-").alias("has_path"))


FILES_OF_A_TASK = 5_000


def _objects(s) -> str:
    """Every document as one file, named like its catalogue row; written once per session."""
    name = F.concat(F.lit("docs/"), "doc_id", F.when(F.col("doc_id") % 3 != 0, ".png").otherwise(".txt"))
    base = scratch_path(s.spark, "objects")

    def build():
        docs = s.table("documents")
        rows = docs.select(name.alias("name"), F.col("text").cast("binary").alias("content"))
        tasks = max(s.spark.sparkContext.defaultParallelism, docs.count() // FILES_OF_A_TASK)
        return FS.write_objects(rows.repartition(tasks), base)

    listing = s.stored("object_listing", build)
    return listing.select(F.expr("substring_index(path, '/', size(split(path, '/')) - 1)")).first()[0]


_EXT = "case when doc_id % 3 <> 0 then '.png' else '.txt' end"
query(
    "catalogue_binaries",
    "select doc_id::varchar image_id, octet_length(encode(text)) file_size, case when doc_id % 3 <> 0 then 'image/png' else "
    "'text/plain' end mime_type, 'batch' source_system, 'analytics' tag, md5(text) checksum from documents",
)(
    lambda s: FS.catalogue_binaries(s.spark, _objects(s), "batch", "analytics").select(
        "image_id", "file_size", "mime_type", "source_system", "tag", "checksum"
    )
)


@query(
    "copy_binaries_to_raw",
    f"select 'images/2024-02-01/' || doc_id || {_EXT} object_name, octet_length(encode(text)) \"length\" from documents",
)
def _copy(s):
    raw = scratch_path(s.spark, "raw")
    copied = FS.copy_binaries_to_raw(s.spark, _objects(s), raw, "2024-02-01")
    tail = F.array_join(F.slice(F.split("path", "/"), -3, 3), "/")
    return copied.select(tail.alias("object_name"), "length")


@query(
    "fetch_objects",
    "select doc_id, case when doc_id % 7 <> 0 then md5(text) end content_md5, case when doc_id % 7 = 0 then "
    "'FileNotFoundError' end error from documents",
)
def _fetch(s):
    """Every seventh path is made wrong."""
    base = _objects(s)
    name = F.concat("doc_id", F.when(F.col("doc_id") % 3 != 0, ".png").otherwise(".txt"))
    path = F.concat(F.lit(f"{base}/"), F.when(F.col("doc_id") % 7 == 0, "missing-").otherwise(""), name)
    meta = s.table("documents").select("doc_id", path.alias("s3_path"))
    return FS.fetch_objects(meta).select("doc_id", F.md5("content").alias("content_md5"), "error")


query("list_objects", "select doc_id || '.png' object_name from documents where doc_id % 3 <> 0")(
    lambda s: FS.list_objects(s.spark, _objects(s), "*.png").select(
        F.element_at(F.split("path", "/"), -1).alias("object_name")
    )
)
query("raw_listing", "select count(*) n_entries from documents")(lambda s: FS.raw_listing(s.spark, _objects(s)))


@query(
    "write_documents",
    "select 'log-' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || case when epoch_us(event_time) % 1000000 = 0 then '' else "
    "strftime(event_time, '.%f') end || '-' || \"level\" doc_id, message, json_extract_string(meta, '$.user') \"user\" from {logs_v}",
)
def _write_docs(s):
    path = scratch_path(s.spark, "documents")
    G.write_documents(G.log_documents(s.logs), path)
    back = s.spark.read.schema("doc_id STRING, message STRING, meta STRUCT<user: STRING, order_id: STRING>").json(path)
    return back.select("doc_id", "message", F.col("meta.user").alias("user"))
