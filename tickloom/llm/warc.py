"""WARC archives under Zstandard with a shared dictionary: one frame per record, the dictionary in a leading skippable frame.

`duplicates` finds the payloads that several pages share, `write_archives` writes every page as a response or, where
another page holds the same payload, as a revisit of the page with the smallest id, and `read_archives` reads archives
record by record. Archives are files below a folder that all executors share; each task rolls its file over at a size, and
only files that the manifest names count, so a task that is repeated or lost half-way leaves nothing that is read. Payloads
do not move: digests are grouped by key with partial aggregation, and only digests that occur more than once are joined
back.

Reading validates the version line, the headers, the record length, the HTTP length and the payload digest. A record that
fails keeps what could be read and says in `problem` what is wrong; a damaged frame ends its archive with a row that says so.

Edge cases: a null payload is empty; a null url has no target header, and control characters in urls are percent-encoded;
a null id is written as an empty id, never answers for others, and revisits the smallest id where there is one; rows that
repeat the smallest id are responses too; payloads below the smallest revisit size are always responses; an empty table
gives no archives; other columns are not read. A record is held whole, so a very long payload costs its task a few times
its size; numbers in headers count up to 64 bits, in ASCII digits.
"""
from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .common import arrow_rows, smallest_hashes, utf8

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20
TASK_BYTES = 128 << 20
CHUNK = 1 << 20
DICTIONARY_BYTES = 64 << 10
# The dictionary is fitted on the heads of so many pages. It changes the size of the archives, not their content.
SAMPLE_PAGES, SAMPLE_CHARS = 400, 8192
ID = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES, payload: str = "html") -> bytes:
    """A Zstandard dictionary from a sample bounded in rows and bytes; empty where there is too little to learn from."""
    head = F.substring(F.col(payload), 1, SAMPLE_CHARS)
    rows = pages.select(head.alias("head"), F.xxhash64("page_id", head).alias("h")).filter(F.length("head") > 0)
    rows = rows.filter(smallest_hashes("h", SAMPLE_PAGES, pages.count())).orderBy("h", "head").limit(SAMPLE_PAGES)
    samples = [r.head.encode() for r in rows.collect()]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes() if samples else b""
    except (zstandard.ZstdError, ValueError):
        return b""


def duplicates(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Payload digests (hexadecimal) of more than one row, with the smallest page id that holds them."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", F.sha1(body).alias("_tl_sha1"), F.octet_length(body).alias("n")).filter(F.col("n") >= smallest)
    return keyed.groupBy("_tl_sha1").agg(F.min("page_id").alias("_tl_first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and _tl_first is not null").drop("n")


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder as a full address, so that every executor means the same place."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: WARC headers, HTTP headers and, in a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = "" if page_id is None else page_id
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <{ID}{name}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


MANIFEST = "path string, records bigint, bytes bigint"


def write_archives(pages: DataFrame, folder: str, smallest: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write `pages` (page_id, url, html) below `folder`; the stored manifest of the archives."""
    spark = pages.sparkSession
    folder = shared_folder(spark, folder)
    learned = dictionary(pages)
    body = F.coalesce(F.col("html"), F.lit(""))
    # the join sends the few shared digests to the pages where they are small, else by key
    twice = materialise(duplicates(pages, smallest), "warc-duplicates")
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("_tl_sha1")).join(twice, "_tl_sha1", "left")
    rows = rows.select("page_id", "url", "html", "_tl_first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(learned) if learned else None)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in batches:
            for part in arrow_rows(batch, 64):
                ids, urls, firsts = (part.column(k).to_pylist() for k in ("page_id", "url", "_tl_first"))
                for page_id, url, payload, first in zip(ids, urls, utf8(part.column("html")), firsts, strict=True):
                    if out is None:
                        name = f"{base}/{uuid.uuid4().hex}.warc.zst"
                        out, records, size = store.open_output_stream(name, compression=None), 0, 0
                        if learned:
                            head = zstandard.ZstdCompressor(level=9).compress(learned)
                            size += out.write(struct.pack("<II", SKIPPABLE, len(head)) + head)
                    revisit = first is not None and first != page_id
                    made = packer.compress(record("revisit" if revisit else "response", page_id, url, payload, first, date))
                    out.write(made)
                    records, size = records + 1, size + len(made)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((name, records, size))
                        out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        prefix = folder.removesuffix(base) if folder.endswith(base) else folder[: folder.index(base)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([prefix + d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            names=["path", "records", "bytes"],
        )

    return materialise(rows.mapInArrow(write, MANIFEST), "warc-manifest")


RECORDS = (
    "path string, place bigint, kind string, record_id string, page_id bigint, url string, date string, digest string, "
    "refers_to bigint, payload_bytes bigint, payload binary, problem string"
)


def frames(stream) -> Iterator[bytes]:
    """The content of every frame of an archive, decoded with the dictionary of the leading skippable frame."""
    data, ended, first = b"", False, True
    unpacker = zstandard.ZstdDecompressor()
    while True:
        while len(data) < 8 and not ended:
            more = stream.read(CHUNK)
            data, ended = data + more, not more
        if not data:
            return
        magic = int.from_bytes(data[:4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # skippable
            if len(data) < 8:
                raise ValueError("skippable frame without a length")
            length = 8 + int.from_bytes(data[4:8], "little")
            while len(data) < length:
                more = stream.read(max(CHUNK, length - len(data)))
                if not more:
                    raise ValueError("skippable frame cut short")
                data += more
            content, data = data[8:length], data[length:]
            if first and magic == SKIPPABLE:
                if content[:4] == FRAME_MAGIC:
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                if content[:4] != DICTIONARY_MAGIC:
                    raise ValueError("leading frame holds no dictionary")
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            first = False
            continue
        first = False
        one, parts = unpacker.decompressobj(), []
        while not one.eof:
            if not data:
                data = stream.read(CHUNK)
                if not data:
                    raise ValueError("frame cut short")
            parts.append(one.decompress(data))
            data = one.unused_data if one.eof else b""
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """The fields of a record; `problem` names the first thing that is wrong."""
    row: dict = dict.fromkeys(("kind", "record_id", "page_id", "url", "date", "digest", "refers_to", "payload_bytes", "payload", "problem"))
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        return row | {"problem": "no version line or end of headers"}
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name != name.strip() or not name:
            return row | {"problem": f"header line {line[:80]!r}"}
        fields[name.lower()] = value.strip()
    missing = [k for k in ("warc-type", "warc-record-id", "warc-date", "content-length") if k not in fields]
    if missing or _number(fields["content-length"]) is None:
        return row | {"problem": "headers missing or malformed: " + ", ".join(missing or ["content-length"])}
    row |= {"kind": fields["warc-type"], "record_id": fields["warc-record-id"], "url": fields.get("warc-target-uri"), "date": fields["warc-date"]}
    row["page_id"], row["refers_to"] = _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to", ""))
    row["digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        return row | {"problem": "block is not as long as Content-Length says"}
    http, mark, payload = rest[:length].partition(b"\r\n\r\n")
    if row["kind"] not in ("response", "revisit"):
        return row
    told = [v.strip() for k, _, v in (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:]) if k.strip().lower() == "content-length"]
    if not mark or not told or _number(told[0]) is None:
        return row | {"problem": "HTTP headers without a length"}
    row["payload_bytes"] = int(told[0])
    if row["kind"] == "revisit":
        return row | {"problem": None if row["refers_to"] is not None and not payload else "revisit without a target, or with a payload"}
    row["payload"] = payload
    if len(payload) != row["payload_bytes"]:
        return row | {"problem": "payload is not as long as the HTTP headers say"}
    return row | {"problem": None if digest(payload) == row["digest"] else "payload digest differs"}


_DIGITS = re.compile(r"-?[0-9]{1,19}")


def _number(text: str) -> int | None:
    """A number of ASCII digits within 64 bits, not negative."""
    found = int(text) if _DIGITS.fullmatch(text) else -1
    return found if 0 <= found < 1 << 63 else None


def _page(name: str) -> int | None:
    """The page that a record's name tells; none for names of other makers or beyond 64 bits."""
    number = name.strip("<>").removeprefix(ID)
    found = int(number) if _DIGITS.fullmatch(number) else None
    return found if found is not None and -(1 << 63) <= found < 1 << 63 else None


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives that `archives` lists by `path`: RECORDS. Without `payloads` they stay behind.

    Archives are streamed; a task holds one record and a buffer.
    """
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()),
                        ("url", pa.string()), ("date", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("problem", pa.string())])

    def rows_of(path: str) -> Iterator[dict]:
        place = -1
        try:
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_stream(name, compression=None) as stream:
                for place, raw in enumerate(frames(stream)):
                    row = parse(raw) | {"path": path, "place": place}
                    yield row if payloads else row | {"payload": None}
        except (OSError, ValueError, zstandard.ZstdError) as e:
            yield dict.fromkeys(schema.names) | {"path": path, "place": place + 1, "problem": f"archive: {e}"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in rows_of(path):
                    held.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size > 4 * CHUNK:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    listed = archives.select(F.col("path").cast("string"))
    size = F.sum("bytes") if "bytes" in archives.columns else F.count("*") * ARCHIVE_BYTES
    found = archives.agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    # tasks by the archives' bytes; adaptive execution would put them all together for the few bytes of their names
    tasks = max(-(-found.bytes // TASK_BYTES), min(found.n, archives.sparkSession.sparkContext.defaultParallelism), 1)
    return listed.repartition(int(tasks)).mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """The records of `pages`, written below the shared folder and read back, without their payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, smallest), payloads=False)
