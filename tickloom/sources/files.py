"""JSON, text, CSV and binary files."""
from __future__ import annotations

import errno
import os
import re
import stat
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LOG_JSON
from ..session import materialise
from .tables import append, append_or_create, gathered

# MIME type per file extension.
MIME = {
    "png": "image/png",
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "gif": "image/gif",
    "webp": "image/webp",
    "txt": "text/plain",
    "json": "application/json",
    "csv": "text/csv",
    "pdf": "application/pdf",
}
FLUSH_BYTES = 64 * 1024 * 1024
# Tasks of Spark's scan of small files that one task here takes.
SCANS = 32
# Files or folders and bytes that one listing or copying task takes, and bytes that it holds of a file at a time.
COPY_FILES, COPY_BYTES, PIECE = 5_000, 1 << 30, 8 << 20
# Names that Spark's file sources pass over, of folders and of files.
HIDDEN_FOLDER = re.compile(r"_(?!common_metadata|metadata)[^=]*\Z|\.|.*\._COPYING_\Z", re.DOTALL)
HIDDEN_FILE = re.compile(r"_[^=]*\Z|\.|.*\._COPYING_\Z", re.DOTALL)


def write_raw_json(df: DataFrame, base: str, date: str | Column) -> None:
    """Append rows unchanged as JSON lines below `date=YYYY-MM-DD/`."""
    day = F.lit(date) if isinstance(date, str) else date
    gathered(df.withColumn("date", day), ["date"]).write.mode("append").partitionBy("date").json(base)


CORRUPT = "_corrupt_record"


def read_raw_json(spark: SparkSession, path: str, schema: str = LOG_JSON, keep_corrupt: bool = True) -> DataFrame:
    """JSON lines; a line that is no JSON object keeps its text in `_corrupt_record`, or is left out without `keep_corrupt`.

    Columns of `schema` that name a folder level take their value from there.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    row = F.from_json("value", f"{schema}, {CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select(row.alias("_r"), *[F.col(c).alias(f"_of_{c}") for c in lines.columns if c != "value"])
    kinds = T.StructType.fromDDL(schema).fields
    cols = [F.col(f"_of_{f.name}").cast(f.dataType).alias(f.name) if f"_of_{f.name}" in rows.columns else F.col(f"_r.{f.name}") for f in kinds]
    if keep_corrupt:
        return rows.select(*cols, f"_r.{CORRUPT}")
    return rows.where(F.col(f"_r.{CORRUPT}").isNull()).select(*cols)


def damaged_logs(raw: DataFrame) -> DataFrame:
    """Rows for quarantine, with the reason and the text of the row: broken JSON, or an event time that does not parse."""
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    late = F.try_to_timestamp(F.col("event_time")).isNull()
    text = F.to_json(F.struct(*[c for c in raw.columns if c != CORRUPT]))
    return raw.select(
        F.when(broken, "broken JSON").when(late, "no event time").alias("reason"),
        (F.coalesce(CORRUPT, text) if CORRUPT in raw.columns else text).alias("text"),
        F.current_timestamp().alias("ingest_time"),
    ).where("reason is not null")


def load_logs_bronze(raw: DataFrame) -> DataFrame:
    """Event time from text and one ingest time; append the result to `raw_logs`.

    A row whose time does not parse has NULL there; a line that was no JSON is left out when `_corrupt_record` tells.
    `damaged_logs` gives both for quarantine.
    """
    if CORRUPT in raw.columns:
        raw = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return raw.withColumns(
        {"event_time": F.try_to_timestamp(F.col("event_time")), "ingest_time": F.current_timestamp()}
    ).select("event_time", "level", "message", "meta", "ingest_time")


def ingest_logs(spark: SparkSession, path: str, database: str) -> None:
    """Append the JSON lines below `path` to `raw_logs`, and those that are broken or have no event time to `log_quarantine`.

    Lines are parsed once, into a stored table split by what becomes of them; both appends read their own part of it. A line
    without an event time goes to both tables, since its other fields are sound.
    """
    raw = read_raw_json(spark, path)
    timeless = F.try_to_timestamp(F.col("event_time")).isNull()
    fate = F.when(F.col(CORRUPT).isNotNull(), "broken").when(timeless, "timeless").otherwise("sound")
    staged = materialise(raw.withColumn("fate", fate), "staged-logs", ["fate"])
    append(load_logs_bronze(staged.where("fate <> 'broken'").drop("fate")), f"{database}.raw_logs")
    append_or_create(damaged_logs(staged.where("fate <> 'sound'").drop("fate")), f"{database}.log_quarantine")


def read_text_logs(spark: SparkSession, services: dict[str, str | list[str]]) -> DataFrame:
    """Lines of plain log files of several services, with service and file path."""
    out = None
    for service, paths in services.items():
        part = spark.read.text(paths).select(
            F.lit(service).alias("service"), F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("message")
        )
        out = part if out is None else out.unionByName(part)
    return out


def read_ticks_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV ticks with a header; only the wanted columns are parsed."""
    schema = "timestamp STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
    rows = spark.read.csv(path, header=True, schema=schema)
    if columns is not None:
        rows = rows.select(*columns)
    return rows.withColumn("timestamp", F.try_to_timestamp(F.col("timestamp"))) if "timestamp" in rows.columns else rows


def read_power_csv(spark: SparkSession, path: str) -> DataFrame:
    """Household power CSV: semicolons, `?` for missing, incomplete rows dropped."""
    schema = (
        "datetime TIMESTAMP, Global_active_power DOUBLE, Global_reactive_power DOUBLE, Voltage DOUBLE, "
        "Global_intensity DOUBLE"
    )
    return spark.read.csv(path, header=True, sep=";", nullValue="?", schema=schema).dropna()


def scan_binaries(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files below `path`. Spark counts 4 MB for opening a file and so gives a task some thirty small ones, less work than
    starting it; `SCANS` of its tasks make one here, as long as there are several for each core."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    tasks = files.select("path").rdd.getNumPartitions()
    return files.coalesce(max(1, tasks // SCANS, min(tasks, 4 * spark.sparkContext.defaultParallelism)))


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, so that tasks mean the place that Spark means."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString())


def is_folder(spark: SparkSession, path: str) -> bool:
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(named)


def below(spark: SparkSession, root: str, path: Column | None = None) -> Column:
    """Path of a scanned file below `root`; its bare name when `root` is a pattern or the file itself."""
    path = F.col("path") if path is None else path
    prefix = qualified(spark, root).rstrip("/") + "/"
    # some scans write a local address with one slash, some with three
    path = F.regexp_replace(path, "^file:/+", "file:/")
    prefix = re.sub("^file:/+", "file:/", prefix)
    rest = F.substring(path, F.lit(len(prefix) + 1), F.length(path))
    return F.when(F.startswith(path, F.lit(prefix)), rest).otherwise(F.element_at(F.split(path, "/"), -1))


def mime_of(path: str) -> Column:
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(table, ext), F.lit("application/octet-stream"))


def catalogue_binaries(spark: SparkSession, path: str, source: str, tag: str, checksum: bool = True) -> DataFrame:
    """One metadata row per file, whose id is its path below `path`; the content is read only for the checksum."""
    name = below(spark, path)
    cols = [
        F.regexp_replace(name, r"\.[^./]*$", "").alias("image_id"),
        F.col("path").alias("s3_path"),
        F.col("length").alias("file_size"),
        mime_of("path").alias("mime_type"),
        F.col("modificationTime").alias("upload_time"),
        F.lit(source).alias("source_system"),
        F.lit(tag).alias("tag"),
    ]
    if checksum:
        cols.append(F.md5("content").alias("checksum"))
    return scan_binaries(spark, path).select(*cols)


def store_of(address: str) -> str:
    """Scheme and, where it has one, host or bucket of a full address."""
    return re.match("[^:]+:(//[^/]*)?", address)[0]


def reached(address: str) -> Callable[[], tuple]:
    """What gives a task the file system of a full address and the path there."""
    mounted = store_of(address) == "file:"

    def reach() -> tuple:
        from pyarrow import fs

        # a name may have signs that an address may not
        return (fs.LocalFileSystem(), address.removeprefix("file:").rstrip("/")) if mounted else fs.FileSystem.from_uri(address)

    return reach


def tasks_for(spark: SparkSession, n: int) -> int:
    """Tasks for so many files or folders: several for each core, and a bounded number of them in each."""
    return max(n // COPY_FILES, min(n, 4 * spark.sparkContext.defaultParallelism))


def list_names(spark: SparkSession, folder: str) -> DataFrame:
    """The files that `scan_binaries` finds below `folder`, by their path below it, with their length, in stored tables.

    Tasks list the folders of one level after the other and pass on what they find as they go. Spark's file sources give all
    names to the driver, which holds several objects for each file until the scan has ended. In a store that is not mounted,
    a task holds the entries of one folder at a time.
    """
    reach = reached(qualified(spark, folder))
    hidden_folder, hidden_file = HIDDEN_FOLDER.match, HIDDEN_FILE.match

    def local(top: str) -> Iterator[tuple[str, bool, int]]:
        with os.scandir(top) as found:
            for entry in found:
                try:
                    held = entry.stat()
                except OSError as e:  # a link to nothing or to itself, or a file that has gone
                    if e.errno not in (errno.ENOENT, errno.ELOOP):
                        raise
                    continue
                yield entry.name, stat.S_ISDIR(held.st_mode), held.st_size

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = reach()

        def remote(top: str) -> Iterator[tuple[str, bool, int]]:
            for info in store.get_file_info(fs.FileSelector(top)):
                yield info.base_name, info.type == fs.FileType.Directory, info.size or 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lengths, pa.int64())], names=["name", "length"])

        entries = local if isinstance(store, fs.LocalFileSystem) else remote
        names, lengths = [], []
        for at in (at for batch in batches for at in batch.column(0).to_pylist()):
            for name, inner, length in entries(f"{root}/{at}"):
                if inner and not hidden_folder(name):
                    names.append(f"{at}{name}/")
                    lengths.append(None)
                elif not inner and length and not hidden_file(name):
                    names.append(f"{at}{name}")
                    lengths.append(length)
                if len(names) == COPY_FILES:
                    yield rows()
                    names, lengths = [], []
        yield rows()

    files, folders, tasks = [], spark.range(1).select(F.lit("").alias("name")), 1
    while tasks:
        level = materialise(folders.repartition(tasks, "name").mapInArrow(walk, "name STRING, length BIGINT"), "listing")
        files.append(level.where("length is not null"))
        folders = level.where("length is null").select("name")
        tasks = tasks_for(spark, folders.count())
    return reduce(DataFrame.unionByName, files)


def placed(df: DataFrame, base: str, contents: Callable[[pa.RecordBatch], Iterator[tuple[str, Iterable[bytes]]]]) -> DataFrame:
    """Write the names and pieces that `contents` gives for the rows to `base/name` from the tasks; gives path and length, lazily.

    A file appears under its name only when complete, so a repeated task or a lost executor leaves no partial file.
    """
    base = qualified(df.sparkSession, base)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(base)
        # a hidden folder for each task: tasks that make files in one folder wait for each other
        parts, made = f"{root}/_{uuid.uuid4().hex}", set()
        target.create_dir(parts, recursive=True)
        for batch in batches:
            paths, lengths = [], []
            for name, pieces in contents(batch):
                path, length = f"{root}/{name}", 0
                folder = os.path.dirname(path)
                if folder not in made:
                    target.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{parts}/{len(paths)}"
                with target.open_output_stream(part, compression=None) as stream:
                    for piece in pieces:
                        stream.write(piece)
                        length += len(piece)
                target.move(part, path)
                paths.append(path)
                lengths.append(length)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], names=["path", "length"])
        target.delete_dir(parts)

    return df.mapInArrow(write, "path STRING, length BIGINT")


def write_objects(df: DataFrame, base: str) -> DataFrame:
    """Write each row's `content` to `base/name`, as `placed` does."""

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[str, Iterable[bytes]]]:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield name, [bytes(content.as_py())]

    return placed(df.select("name", "content"), base, contents)


def copy_objects(names: DataFrame, source: str, base: str, folder: str) -> DataFrame:
    """Copy the files of a stored listing of `source` to `base/folder/name` from the tasks, as `placed` does.

    The tasks read the files themselves, in pieces, and get a bounded share of the files and of their bytes.
    """
    spark = names.sparkSession
    reach = reached(qualified(spark, source))
    files, size = names.agg(F.count("name"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, size // COPY_BYTES, tasks_for(spark, files))

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[str, Iterable[bytes]]]:
        store, root = reach()

        def pieces(path: str) -> Iterator[bytes]:
            with store.open_input_stream(path, compression=None) as stream:  # else names ending in .gz are unpacked
                while piece := stream.read(PIECE):
                    yield piece

        for name in batch.column(0).to_pylist():
            yield f"{folder}/{name}", pieces(f"{root}/{name}")

    return placed(names.select("name").repartition(tasks, "name"), base, contents)


def copy_binaries_to_raw(spark: SparkSession, path: str, raw_base: str, date: str) -> DataFrame:
    """Copy files unchanged to `raw_base/images/<date>/`, with their path below `path`; one row per copied file once an
    action runs.

    Folders that the tasks can reach, which are mounted ones and those of the store they write to, are listed and read by
    tasks. Patterns, single files and other stores go through Spark's scan, whose listing the driver holds.
    """
    source, folder = qualified(spark, path), f"images/{date}"
    known = store_of(source) in ("file:", store_of(qualified(spark, raw_base)))
    if known and not re.search(r"[][{}*?\\]", path) and is_folder(spark, path):
        return copy_objects(list_names(spark, path), path, raw_base, folder)
    name = F.concat(F.lit(f"{folder}/"), below(spark, path))
    return write_objects(scan_binaries(spark, path).select(name.alias("name"), "content"), raw_base)


def fetch_objects(meta: DataFrame, path: str = "s3_path") -> DataFrame:
    """Bytes of each metadata row's object, read where the row is; unreadable objects keep the row with an error.

    Only the wanted objects are opened and no bytes are shuffled.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in meta.schema.fields)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        clients: dict[str, fs.FileSystem] = {}

        def opened(uri: str):
            """A stream of the object; one client for each store and bucket."""
            if not isinstance(uri, str):
                raise FileNotFoundError(uri)
            uri = uri.replace("s3a://", "s3://", 1)
            scheme, mark, rest = uri.partition("://")
            store = f"{scheme}{mark}{rest.partition('/')[0]}" if mark else ""
            if store not in clients:
                clients[store], name = fs.FileSystem.from_uri(uri)
            else:
                name = rest if scheme in ("s3", "gs") else "/" + rest.partition("/")[2] if mark else uri
            return clients[store].open_input_stream(name, compression=None)  # else names ending in .gz are unpacked

        for pdf in batches:
            content, error, start, held = [], [], 0, 0
            for i, uri in enumerate(pdf[path]):
                try:
                    with opened(uri) as stream:
                        content.append(stream.read())
                    error.append(None)
                except (FileNotFoundError, PermissionError, IsADirectoryError, pa.ArrowInvalid) as e:
                    content.append(None)
                    error.append(type(e).__name__)
                held += len(content[-1] or b"")
                if held >= FLUSH_BYTES:
                    yield pdf.iloc[start : i + 1].assign(content=content, error=error)
                    content, error, start, held = [], [], i + 1, 0
            if content:
                yield pdf.iloc[start:].assign(content=content, error=error)

    return meta.mapInPandas(fetch, f"{schema}, content BINARY, error STRING")


def list_objects(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """Object paths below a prefix; no content is read."""
    return scan_binaries(spark, prefix, glob).select("path")


def raw_listing(spark: SparkSession, raw: str) -> DataFrame:
    """Number of entries directly below `raw`."""
    below = F.expr(f"substr(path, instr(path, '{raw.rstrip('/')}/') + {len(raw.rstrip('/')) + 1})")
    first = F.element_at(F.split(below, "/"), 1)
    return scan_binaries(spark, raw).agg(F.countDistinct(first).alias("n_entries"))
