"""Files, tables and ingestion."""
import datetime as dt
import hashlib
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.registry import QUERIES
from tickloom.session import materialise, scratch_path, shared_dir, sql
from tickloom.sources import files as FS
from tickloom.sources import ingest as N
from tickloom.sources import tables as T
from tickloom.sources import xml as X

STAMP = dt.datetime(2024, 2, 1)


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def tick(tag, tdate="2024-01-02T09:00:00+09:00", strike="100", close="<c>1.5</c>"):
    return (
        f"<{tag}><ymcode>202401</ymcode><code>A1</code><strike>{strike}</strike><tdate>{tdate}</tdate>"
        f"<tcnt>7</tcnt>{close}<ccnt>3</ccnt></{tag}>"
    )


@pytest.fixture
def xml_files(tmp_path):
    def save(name, tag, body):
        path = tmp_path / name
        path.write_text(f"<?xml version='1.0'?>\n<DocumentElement>{body}</DocumentElement>")
        return str(path)

    call, put = "_x0032_02601_20251201_TICK_CALL", "TICK_PUT"
    code = "<{0}><ymcode>202401</ymcode><code>A1</code><lastday>20240131</lastday></{0}>"
    return (
        save("call.xml", call, tick(call) + tick(call, strike="bad") + tick(call, close="")),
        save("put.xml", put, tick(put)),
        save("ccall.xml", "CODE_C", code.format("CODE_C")),
        save("cput.xml", "CODE_P", code.format("CODE_P")),
    )


def test_row_tag_is_the_first_child(spark, xml_files):
    assert X.detect_row_tag(spark, xml_files[0]) == "_x0032_02601_20251201_TICK_CALL"
    assert X.detect_row_tag(spark, xml_files[3]) == "CODE_P"


def test_xml_keeps_bad_rows_and_reads_offsets(spark, xml_files):
    rows = X.read_xml(spark, xml_files[0], X.detect_row_tag(spark, xml_files[0]), schemas.TICK_XML).collect()
    assert len(rows) == 3
    good, bad, gap = rows
    assert good.tdate == dt.datetime(2024, 1, 2, 0, 0) and good._corrupt_record is None  # 09:00 in Seoul
    assert bad.strike is None and "bad" in bad._corrupt_record
    assert (bad.code, bad.tdate, bad.c, bad.ccnt) == ("A1", good.tdate, 1.5, 3)  # only the bad field is lost
    assert gap.c is None and gap.strike == 100 and gap._corrupt_record is None


def test_broken_element_is_kept_as_text(spark, tmp_path):
    path = tmp_path / "broken.xml"
    path.write_text(f"<DocumentElement>{tick('T')}<T><ymcode>202401</code></T>{tick('T')}</DocumentElement>")
    rows = X.read_xml(spark, str(path), "T", schemas.TICK_XML)
    assert rows.where("_corrupt_record is not null and code is null").count() >= 1


def test_ingest_bronze(spark, xml_files, db):
    T.create_tables(spark, db, ["bronze_ticks", "bronze_codes"])
    X.ingest_bronze(spark, *xml_files, db, STAMP)
    rows = spark.table(f"{db}.bronze_ticks").collect()
    assert sorted((r.src_file, r.side) for r in rows) == [("call.xml", "CALL")] * 3 + [("put.xml", "PUT")]
    assert {r.ingest_ts for r in rows} == {STAMP} and {r.tick_date for r in rows} == {dt.date(2024, 1, 2)}
    assert spark.table(f"{db}.bronze_codes").count() == 2


def test_second_ingest_of_a_file_is_empty(spark):
    rows = spark.createDataFrame([("a.xml", 1), ("a.xml", 5), ("b.xml", 2)], "src_file STRING, tcnt BIGINT")
    sums = spark.createDataFrame([("a.xml", "h1"), ("b.xml", "h2")], "src_file STRING, checksum STRING")
    empty = spark.createDataFrame([], N.MANIFEST)
    fresh, manifest = N.idempotent_ingest(rows, empty, sums)
    assert fresh.count() == 3
    loaded = materialise(manifest, "manifest")
    assert N.idempotent_ingest(rows, loaded, sums)[0].count() == 0
    more = rows.unionByName(spark.createDataFrame([("b.xml", 9)], "src_file STRING, tcnt BIGINT"))
    changed = spark.createDataFrame([("a.xml", "h1"), ("b.xml", "h3")], "src_file STRING, checksum STRING")
    assert {r.src_file for r in N.idempotent_ingest(more, loaded, changed)[0].collect()} == {"b.xml"}


def test_file_checksums(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    row = N.file_checksums(spark, str(tmp_path)).first()
    assert (row.src_file, row.checksum) == ("x.bin", hashlib.md5(b"abc").hexdigest())


def test_all_tables_exist_with_partitions(spark, db):
    T.create_tables(spark, db)
    T.create_tables(spark, db)  # a second run changes nothing
    assert {r.tableName for r in T.list_tables(spark, db).collect()} == set(schemas.TABLES)
    assert db in {r.namespace for r in T.list_databases(spark).collect()}
    parts = [c.name for c in spark.catalog.listColumns(f"{db}.image_metadata") if c.isPartition]
    assert parts == ["upload_date", "tag"]


def test_append_goes_by_name(spark, db):
    T.recreate_table(spark, f"{db}.q", "a INT, b STRING")
    T.append(spark.createDataFrame([("x", 1)], "b STRING, a INT"), f"{db}.q")
    spark.sql(f"INSERT INTO {db}.q VALUES (2, 'y')")
    assert sorted(map(tuple, spark.table(f"{db}.q").collect())) == [(1, "x"), (2, "y")]


def test_append_or_create(spark, db):
    df = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    T.append_or_create(df, f"{db}.made")
    T.append_or_create(df.select("b", "a"), f"{db}.made")
    assert spark.table(f"{db}.made").count() == 2
    with pytest.raises(AnalysisException):
        T.append_or_create(df.withColumn("c", F.lit(1)), f"{db}.made", wait_s=0)


def test_overwrite_leaves_other_partitions(spark):
    path = scratch_path(spark, "parts")
    T.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v INT, p STRING"), path, ["p"])
    T.overwrite_partitions(spark.createDataFrame([(9, "b")], "v INT, p STRING"), path, ["p"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (9, "b")]


def test_retention_keeps_the_last_days(spark):
    df = spark.range(60).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    kept = T.apply_retention(df, "d", dt.date(2024, 2, 29), 30)
    assert kept.agg(F.min("d"), F.count("d")).first()[0] == dt.date(2024, 1, 30)


def test_raw_json_round_trip(spark):
    base = scratch_path(spark, "json")
    logs = spark.createDataFrame(
        [("2025-12-24T09:00:00", "INFO", "trade executed", '{"user":"u"}'), ("not a time", "INFO", "m", None)], schemas.LOG_JSON
    )
    FS.write_raw_json(logs, base, "2025-12-24")
    FS.write_raw_json(logs, base, "2025-12-25")
    raw = FS.read_raw_json(spark, f"{base}/date=2025-12-24")
    assert raw.count() == 2
    rows = {r.message: r for r in FS.load_logs_bronze(raw).collect()}
    assert rows["trade executed"].event_time == dt.datetime(2025, 12, 24, 9)
    assert rows["m"].event_time is None and rows["m"].ingest_time is not None


def test_csv_sources(spark, tmp_path):
    ticks = tmp_path / "t.csv"
    ticks.write_text("timestamp,open,high,low,close,volume\n2024-01-02 09:00:00,1,2,0.5,1.5,10\noops,1,2,0.5,1.5,10\n")
    rows = FS.read_ticks_csv(spark, str(ticks), ["timestamp", "close"]).collect()
    assert [tuple(r) for r in rows] == [(dt.datetime(2024, 1, 2, 9), 1.5), (None, 1.5)]
    power = tmp_path / "p.csv"
    power.write_text(
        "datetime;Global_active_power;Global_reactive_power;Voltage;Global_intensity\n"
        "2024-01-02 09:00:00;1;2;230;4\n2024-01-02 09:01:00;?;2;230;4\n"
    )
    assert FS.read_power_csv(spark, str(power)).count() == 1


def test_text_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    (tmp_path / "b.log").write_text("three\n")
    got = FS.read_text_logs(spark, {"web": str(tmp_path / "a.log"), "db": str(tmp_path / "b.log")})
    rows = sorted((r.service, r.message, r.file_path.split("/")[-1]) for r in got.collect())
    assert rows == [("db", "three", "b.log"), ("web", "one", "a.log"), ("web", "two", "a.log")]


def test_binaries(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.PNG").write_bytes(b"abc")
    (src / "b.bin").write_bytes(b"defg")
    cat = {r.image_id: r for r in FS.catalogue_binaries(spark, str(src), "batch", "t").collect()}
    assert (cat["a"].mime_type, cat["a"].file_size) == ("image/png", 3)
    assert cat["b"].mime_type == "application/octet-stream"
    assert cat["a"].checksum == hashlib.md5(b"abc").hexdigest()
    raw = str(tmp_path / "raw")
    for _ in range(2):  # repeating the copy leaves the same files
        assert FS.copy_binaries_to_raw(spark, str(src), raw, "2024-02-01").count() == 2
    assert (tmp_path / "raw/images/2024-02-01/a.PNG").read_bytes() == b"abc"
    assert FS.raw_listing(spark, raw).first().n_entries == 1
    assert {r.path.split("/")[-1] for r in FS.list_objects(spark, raw, "*.bin").collect()} == {"b.bin"}
    meta = spark.createDataFrame([(1, f"{src}/a.PNG"), (2, f"{src}/none"), (3, None)], "id INT, s3_path STRING")
    got = {r.id: r for r in FS.fetch_objects(meta).collect()}
    assert bytes(got[1].content) == b"abc" and got[1].error is None
    assert got[2].content is None and got[2].error == "FileNotFoundError"
    assert got[3].content is None and got[3].error is not None


def test_small_files_share_tasks(spark, tmp_path):
    src, raw = tmp_path / "src", tmp_path / "raw"
    src.mkdir()
    for i in range(700):
        (src / f"{i}.png").write_bytes(b"%d" % i)
    few = 4 * spark.sparkContext.defaultParallelism
    assert FS.scan_binaries(spark, str(src)).rdd.getNumPartitions() <= few
    assert FS.copy_binaries_to_raw(spark, str(src), str(raw), "2024-02-01").count() == 700
    assert sorted(p.name for p in raw.iterdir()) == ["images"]  # no part of a file is left
    folder = raw / "images/2024-02-01"
    assert {p.name: p.read_bytes() for p in folder.iterdir()} == {f"{i}.png": b"%d" % i for i in range(700)}
    spread = FS.scan_binaries(spark, str(src)).rdd.glom().map(len).collect()
    assert sum(spread) == 700 and max(spread) < 350


def test_one_task_writes_a_bounded_number_of_objects(spark, tmp_path, monkeypatch):
    from tickloom.registry import io
    from tickloom.sources.adapters import Inputs

    spark.range(300).selectExpr("id doc_id", "string(id) text").write.parquet(str(tmp_path / "documents.parquet"))
    tasks = []
    write = FS.write_objects
    monkeypatch.setattr(io, "FILES_OF_A_TASK", 10)
    monkeypatch.setattr(FS, "write_objects", lambda df, base: (tasks.append(df.rdd.getNumPartitions()), write(df, base))[1])
    base = io._objects(Inputs(spark, str(tmp_path)))
    assert tasks == [30] and FS.scan_binaries(spark, base).count() == 300


def odd_files(top):
    """Files with odd names, hidden ones, links and an empty one."""
    names = ["a.png", "b.gz", "_hid", "_hid=1", ".dot", "x._COPYING_", "_metadata", "d/a", "d/e/a", "_d/a", "_d=1/a", ".e/a", "_metadata_d/a", "f._COPYING_/a", "sp ace/a b", "p%20/a%41", "q#r"]
    for name in names:
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(name.encode() * 9)
    (top / "empty").write_bytes(b"")
    (top / "link").symlink_to(top / "a.png")
    (top / "folder").symlink_to(top / "d")
    (top / "nothing").symlink_to(top / "gone")
    (top / "itself").symlink_to(top / "itself")


def test_copies_know_no_files_on_the_driver(spark, tmp_path, monkeypatch):
    src, raw = tmp_path / "src", tmp_path / "raw"
    src.mkdir()
    for i in range(300):
        (src / f"{i}.png").write_bytes(b"%d" % i)
    monkeypatch.setattr(FS, "COPY_FILES", 10)
    copied = FS.copy_binaries_to_raw(spark, str(src), str(raw), "2024-02-01")
    assert len(copied.inputFiles()) <= 2  # the listing, a stored table
    assert copied.rdd.getNumPartitions() == 30
    assert not raw.exists()  # nothing is copied before an action
    assert {(r.path, r.length) for r in copied.collect()} == {(f"{raw}/images/2024-02-01/{i}.png", len(str(i))) for i in range(300)}
    assert {p.name: p.read_bytes() for p in (raw / "images/2024-02-01").iterdir()} == {f"{i}.png": b"%d" % i for i in range(300)}
    monkeypatch.setattr(FS, "COPY_FILES", 5_000)
    monkeypatch.setattr(FS, "COPY_BYTES", 20)  # 790 bytes
    assert FS.copy_binaries_to_raw(spark, str(src), str(raw), "2024-02-01").rdd.getNumPartitions() == 39


@pytest.mark.parametrize("mounted", [True, False])
def test_listing_finds_what_the_scan_finds(spark, tmp_path, monkeypatch, mounted):
    src, raw = tmp_path / "src", tmp_path / "raw"
    odd_files(src)
    want = {r.name for r in FS.scan_binaries(spark, str(src)).select(FS.below(spark, str(src)).alias("name")).collect()}
    assert {"link", "folder/e/a", "_d=1/a", "p%20/a%41"} < want and not {"empty", "_hid", "_d/a"} & want
    if not mounted:

        def reached(address):
            def reach():
                from pyarrow import fs

                return fs.SubTreeFileSystem("/", fs.LocalFileSystem()), address.removeprefix("file:")

            return reach

        monkeypatch.setattr(FS, "reached", reached)
        for link in ("nothing", "itself"):
            (src / link).unlink()
    monkeypatch.setattr(FS, "PIECE", 7)
    monkeypatch.setattr(FS, "COPY_FILES", 2)
    assert {(r.name, r.length) for r in FS.list_names(spark, str(src)).collect()} == {(n, (src / n).stat().st_size) for n in want}
    assert FS.copy_binaries_to_raw(spark, str(src), str(raw), "d").count() == len(want)
    found = {str(p.relative_to(raw / "images/d")): p.read_bytes() for p in (raw / "images/d").rglob("*") if p.is_file()}
    assert found == {n: (src / n).read_bytes() for n in want}


def test_copies_of_patterns_files_and_empty_folders(spark, tmp_path):
    src, raw = tmp_path / "src", tmp_path / "raw"
    odd_files(src)
    (tmp_path / "none").mkdir()
    assert [r.length for r in FS.copy_binaries_to_raw(spark, f"{src}/*.png", str(raw), "p").collect()] == [45]
    assert [r.length for r in FS.copy_binaries_to_raw(spark, f"{src}/a.png", str(raw), "f").collect()] == [45]
    assert (raw / "images/p/a.png").read_bytes() == (raw / "images/f/a.png").read_bytes() == b"a.png" * 9
    assert FS.copy_binaries_to_raw(spark, str(tmp_path / "none"), str(raw), "n").count() == 0
    with pytest.raises(AnalysisException):
        FS.copy_binaries_to_raw(spark, str(tmp_path / "missing"), str(raw), "n")


def test_fetch_splits_large_batches(spark, tmp_path, monkeypatch):
    for i in range(5):
        (tmp_path / f"{i}").write_bytes(b"x" * 10)
    monkeypatch.setattr(FS, "FLUSH_BYTES", 15)
    meta = spark.createDataFrame([(i, f"{tmp_path}/{i}") for i in range(5)], "id INT, s3_path STRING").coalesce(1)
    assert FS.fetch_objects(meta).where("length(content) = 10").count() == 5


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_adhoc_sql(spark):
    assert sql(spark, "select sum(id) s from numbers", {"numbers": spark.range(5)}).first().s == 10


def test_list_tables_query_has_every_symbol(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sixth = events.limit(1).withColumn("event_type", F.lit("refund"))
    events.unionByName(sixth).write.parquet(str(tmp_path / "events.parquet"))
    want = {f"quotes_{r.event_type}" for r in events.select("event_type").distinct().collect()} | {"quotes_refund"}
    assert {r.tableName for r in QUERIES["list_tables"](spark, str(tmp_path)).collect()} == want


def test_files_of_one_name_stay_apart(spark, tmp_path):
    """Two folders below one root hold a file of the same name; both load, and a second run loads neither."""
    for day, n in (("d1", 3), ("d2", 5)):
        (tmp_path / day).mkdir()
        body = "".join(f"<TICK_CALL><tcnt>{i}</tcnt><c>1.5</c></TICK_CALL>" for i in range(n))
        (tmp_path / day / "ticks.xml").write_text(f"<DocumentElement>{body}</DocumentElement>")
    read = [
        X.add_provenance(X.read_xml(spark, str(tmp_path / d / "ticks.xml"), "TICK_CALL", "tcnt BIGINT, c DOUBLE"), "CALL", root=str(tmp_path))
        for d in ("d1", "d2")
    ]
    sums = N.file_checksums(spark, str(tmp_path))
    assert {r.src_file for r in sums.collect()} == {"d1/ticks.xml", "d2/ticks.xml"}
    nothing = spark.createDataFrame([], N.MANIFEST)
    first, loaded = N.idempotent_ingest(read[0], nothing, sums)
    assert first.count() == 3
    both = read[0].unionByName(read[1])
    second, more = N.idempotent_ingest(both, loaded, sums)
    assert {r.src_file for r in second.collect()} == {"d2/ticks.xml"}
    assert N.idempotent_ingest(both, loaded.unionByName(more), sums)[0].count() == 0


def test_bronze_parses_each_file_once(spark, tmp_path, monkeypatch):
    """Each kind is parsed into one stored table, which both appends read; a damaged row keeps its text."""
    for name, tag in (("tc", "TICK_CALL"), ("tp", "TICK_PUT"), ("cc", "CODE_CALL"), ("cp", "CODE_PUT")):
        (tmp_path / f"{name}.xml").write_text(f"<D><{tag}><tcnt>7</tcnt><code>A</code></{tag}><{tag}><tcnt>x7</tcnt><lastday>no</lastday></{tag}></D>")
    stored, keep = [], X.materialise
    monkeypatch.setattr(X, "materialise", lambda df, name, by: stored.append((name, by)) or keep(df, name, by))
    spark.sql("CREATE DATABASE IF NOT EXISTS once_db LOCATION '" + str(tmp_path / "db") + "'")
    T.create_tables(spark, "once_db", ["bronze_ticks", "bronze_codes"])
    X.ingest_bronze(spark, *[str(tmp_path / f"{n}.xml") for n in ("tc", "tp", "cc", "cp")], "once_db", root=str(tmp_path))
    assert stored == [("staged-ticks", ["damaged"]), ("staged-codes", ["damaged"])]
    assert spark.table("once_db.bronze_ticks").count() == 4 and spark.table("once_db.bronze_codes").count() == 4
    kept = spark.table("once_db.bronze_quarantine").collect()
    assert sorted({(r.kind, r.src_file) for r in kept}) == [("codes", "cc.xml"), ("codes", "cp.xml"), ("ticks", "tc.xml"), ("ticks", "tp.xml")]
    spark.sql("DROP DATABASE once_db CASCADE")


def test_broken_lines_are_never_rows(spark, tmp_path):
    lines = ['{"event_time": "2025-01-01T00:00:00", "level": "INFO", "message": "a"}', '{"event_time": "2025', "plain", '{"level": "WARN"}', ""]
    (tmp_path / "x.json").write_text("\n".join(lines))
    rows = FS.read_raw_json(spark, str(tmp_path)).collect()
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(lines[1:3])
    assert FS.read_raw_json(spark, str(tmp_path), keep_corrupt=False).count() == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS lines_db LOCATION '" + str(tmp_path / "db") + "'")
    T.create_tables(spark, "lines_db", ["raw_logs"])
    FS.ingest_logs(spark, str(tmp_path / "x.json"), "lines_db")
    assert sorted(r.level for r in spark.table("lines_db.raw_logs").collect()) == ["INFO", "WARN"]
    kept = sorted(r.reason for r in spark.table("lines_db.log_quarantine").collect())
    assert kept == ["broken JSON", "broken JSON", "no event time"]
    spark.sql("DROP DATABASE lines_db CASCADE")


def test_objects_keep_their_bytes(spark, tmp_path):
    import gzip

    packed = gzip.compress(b"content " * 50)
    (tmp_path / "x.gz").write_bytes(packed)
    row = FS.fetch_objects(spark.createDataFrame([(str(tmp_path / "x.gz"),)], "s3_path STRING")).first()
    assert bytes(row.content) == packed and row.error is None
