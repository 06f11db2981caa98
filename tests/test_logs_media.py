"""Edge cases of logs, search documents and media."""
import datetime as dt
import json

from tickloom.functions import scalars as S
from tickloom.operators import bi as Q
from tickloom.operators import logs as G
from tickloom.operators import media as M
from tickloom.session import scratch_path

T0 = dt.datetime(2024, 1, 2, 9, 0)
LOG = "event_time TIMESTAMP, level STRING, message STRING, meta STRING"


def logs(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_bad_meta_never_matches_and_stays_text(spark):
    df = logs(
        spark,
        [
            (T0, "INFO", "ok", '{"user":"u1","order_id":"o1"}'),
            (T0, "WARN", "bad", "{not json"),
            (T0, "ERROR", "none", None),
            (T0, "DEBUG", "empty", ""),
        ],
    )
    assert [r.message for r in G.logs_by_user(df, "u1").collect()] == ["ok"]
    parsed = {r.message: r.meta_obj for r in G.parse_meta(df).collect()}
    assert parsed["ok"].user == "u1" and parsed["bad"] is None and parsed["none"] is None and parsed["empty"] is None
    assert {r.user: r.n for r in G.user_activity(df).collect()} == {"u1": 1}
    docs = {r.doc_id: r.meta for r in G.log_documents(df).collect()}
    assert json.loads(docs["log-2024-01-02T09:00:00-INFO"]) == {"user": "u1", "order_id": "o1"}
    assert json.loads(docs["log-2024-01-02T09:00:00-WARN"]) == "{not json"
    assert docs["log-2024-01-02T09:00:00-ERROR"] is None


def test_written_documents_hold_objects(spark):
    path = scratch_path(spark, "docs")
    G.write_documents(G.log_documents(logs(spark, [(T0, "INFO", "m", '{"user":"u"}'), (T0, "WARN", "m", "raw")])), path)
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert sorted(map(repr, (d["meta"] for d in lines))) == ["'raw'", "{'user': 'u'}"]


def test_same_document_id_last_write_wins(spark):
    from pyspark.sql import functions as F

    df = logs(spark, [(T0, "INFO", "first", None), (T0, "INFO", "second", None)])
    version = F.when(F.col("message") == "second", 2).otherwise(1)
    assert [r.message for r in G.log_documents(df, version).collect()] == ["second"]


def test_debug_lines_go_and_null_messages_stay(spark):
    df = logs(spark, [(T0, "INFO", "DBG x", None), (T0, "INFO", None, None), (T0, "INFO", "x DBG", None)])
    assert {r.message for r in G.drop_debug(df).collect()} == {None, "x DBG"}


def test_word_search(spark):
    df = logs(spark, [(T0, "I", "Order FAILED: timeout", None), (T0, "I", "reordered", None), (T0, "I", None, None)])
    assert [r.message for r in G.search_messages(df, ["order", "failed"]).collect()] == ["Order FAILED: timeout"]
    assert G.search_messages(df, ["order", "nothing"], "any").count() == 1


def test_error_trend_has_empty_buckets(spark):
    hour = dt.timedelta(hours=1)
    df = logs(spark, [(T0, "ERROR", "a", None), (T0 + 3 * hour, "INFO", "b", None)])
    assert [r.errors for r in G.error_trend(df).orderBy("bucket").collect()] == [1, 0, 0, 0]
    rates = G.error_rate(df).orderBy("bucket").collect()
    assert [(r.rate, r.alert) for r in rates] == [(1.0, True), (0.0, False)]


def test_error_burst_is_strictly_above_the_limit(spark):
    rows = [(T0 + dt.timedelta(seconds=i), "ERROR", "x", None) for i in range(51)]
    assert G.error_bursts(logs(spark, rows)).agg({"errors": "max"}).first()[0] == 51
    assert G.error_bursts(logs(spark, rows[:50])).count() == 0


IMG = (
    "image_id STRING, s3_path STRING, file_size BIGINT, mime_type STRING, upload_time TIMESTAMP, source_system STRING, "
    "tag STRING, checksum STRING"
)


def images(spark, rows):
    return spark.createDataFrame(rows, IMG)


def test_bad_paths(spark):
    df = images(
        spark,
        [
            ("a", "s3a://b/k/x.PNG", 1, None, T0, "s", "t", "c"),
            ("b", "s3://b/y.txt", 1, "text/plain", T0, "s", "t", "c"),
            ("c", "b/k.gif", 1, None, T0, "s", None, "d"),
            ("d", "s3a://bucketonly", 1, "image/png", T0, "s", "t", None),
            ("e", None, 1, None, T0, "s", "t", None),
        ],
    )
    got = {r.image_id: r for r in S.parse_object_path(df).collect()}
    assert (got["a"].bucket, got["a"].object_key, got["a"].path_error) == ("b", "k/x.PNG", None)
    assert (got["b"].bucket, got["b"].object_key) == ("b", "y.txt")
    assert all(got[k].bucket is None and got[k].path_error for k in "cde")
    flags = {r.image_id: r[1] for r in df.select("image_id", S.is_image()).collect()}
    assert flags == {"a": True, "b": False, "c": True, "d": True, "e": False}
    assert M.image_count(df).first().n == 3
    assert [(r.tag, r.n) for r in M.tag_counts(df).collect()] == [("t", 4)]
    assert [(r.checksum, r.n) for r in M.duplicate_objects(df).collect()] == [("c", 2)]


def test_search_modes(spark):
    df = images(spark, [("IMG.1", "p", 1, None, T0, "s", "Cat", "c"), ("img-1", "p", 1, None, T0, "s", None, "c")])
    assert M.search_media(df, "image_id", "img.1").count() == 2
    assert M.search_media(df, "image_id", "img.1", regex=False).count() == 1
    assert M.search_media(df, "tag", "none").count() == 0


def test_empty_summary_is_zero(spark):
    row = M.media_summary(images(spark, [])).first()
    assert tuple(row) == (0, 0.0, 0.0, 0)
    assert M.size_histogram(images(spark, [])).count() == 0


def test_histogram_puts_the_maximum_into_the_last_bucket(spark):
    df = images(spark, [(str(i), "p", i, None, T0, "s", "t", "c") for i in (0, 5, 10, 100)])
    rows = M.size_histogram(df, 10).orderBy("bucket").collect()
    assert [r.n for r in rows] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    same = M.size_histogram(images(spark, [("a", "p", 7, None, T0, "s", "t", "c")]), 4).orderBy("bucket").collect()
    assert [r.n for r in same] == [1, 0, 0, 0]


def test_size_range_includes_both_ends(spark):
    df = images(spark, [(str(i), "p", i, None, T0, "s", "t", "c") for i in (1023, 1024, 2048, 2049)])
    assert M.filter_media(df, kb_range=(1, 2)).count() == 2
    assert M.filter_media(df, dates=(T0.date(), T0.date())).count() == 4


def test_pages(spark):
    df = spark.range(41)
    rows = Q.page(df, [df.id.asc()], 3, 20).collect()
    assert [(r.id, r.total_pages) for r in rows] == [(40, 3)]
    assert [r.id for r in Q.page_after(df, "id", 37, 20).collect()] == [38, 39, 40]


def test_filters_that_are_absent_restrict_nothing(spark):
    df = spark.createDataFrame([(T0, "a")], "timestamp TIMESTAMP, symbol STRING")
    assert Q.dashboard_filters(df).count() == 1
    assert Q.dashboard_filters(df, symbol=["b"]).count() == 0
    assert Q.dashboard_filters(df, date_from=T0.date(), date_to=T0.date()).count() == 1


SAID = [
    "Order FAILED: timeout", "preorder order-failed", "e-mail sent to Ärger", "ärger e mail", None, "", "the the of", "of", "THE", "x\ny the\tof",
    "order failed", "order  failed", "naïve 日本語 text", "日本語", "a_b a1 1a", "!!! ???", "order" * 3,
] + [f"the common words of row {i} and of row {i % 7}" for i in range(200)]


def test_index_finds_what_the_scan_finds(spark, tmp_path):
    df = spark.createDataFrame([(i % 150, m, "x") for i, m in enumerate(SAID)], "id INT, message STRING, word STRING").repartition(3)
    G.build_search_index(df, "message", str(tmp_path / "i"), 8)
    queries = [["order"], ["the", "of"], ["e-mail"], ["order failed"], ["Ärger", "mail"], ["日本語"], ["a_b"], ["missing"], ["the", "missing"], ["???"],
               ["!!!", "order"], ["row 5"], ["row", "common", "77"], ["failed:"], ["ORDER"], ["-failed"]]
    for terms in queries:
        for mode in ("all", "any"):
            got = sorted(map(repr, G.search_index(spark, str(tmp_path / "i"), terms, mode).collect()))
            assert got == sorted(map(repr, G.search_messages(df, terms, mode).collect())), (terms, mode)


def test_index_reads_few_buckets(spark, tmp_path, monkeypatch):
    """One bucket of each table for a rare word; a join where more rows are found than are looked up by number."""
    df = spark.createDataFrame([(i, m) for i, m in enumerate(SAID)], "id INT, message STRING")
    path = str(tmp_path / "i")
    G.build_search_index(df, "message", path, 8)
    found = G.search_index(spark, path, ["timeout", "order"])
    parts = {f.split("_part=")[1].split("/")[0] for f in found.inputFiles()}
    assert found.count() == 1 and len(parts) == 8  # listed; the filter on the part prunes them:
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1].split("]")[0] and "Join" not in plan
    held = G._intersected(spark, path, {(r.bucket, r.word) for r in spark.read.parquet(f"{path}/frequency").where("word = 'timeout'").collect()},
                          {(r.bucket, r.word): r.n for r in spark.read.parquet(f"{path}/frequency").collect()})
    assert "bucket" in held._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    monkeypatch.setattr(G, "FEW", 10)
    many = G.search_index(spark, path, ["the", "of"])
    assert many.count() == G.search_messages(df, ["the", "of"]).count() > 10
    assert "Join" in many._jdf.queryExecution().executedPlan().toString()


def test_index_of_no_rows(spark, tmp_path):
    G.build_search_index(logs(spark, []), "message", str(tmp_path / "i"))
    assert G.search_index(spark, str(tmp_path / "i"), ["the"]).count() == 0
