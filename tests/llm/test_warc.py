import hashlib
import io
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from tickloom.llm import warc
from tickloom.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, kind string, problem string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


ROWS = [
    (5, "http://a/é x\r\nWARC-Type: y", "<p>one</p>"), (3, None, "<p>one</p>"), (3, "http://b", "<p>one</p>"), (9, "", "<p>one</p>"),
    (None, "http://n", "<p>one</p>"), (None, "http://n", "<p>none</p>"), (1, "u", None), (2, "u", ""), (4, "u", "\r\n\r\n" * 9),
    (7, "u", "é" * 200_000), (8, "u", "x\r\n\r\nHTTP/1.1 200 OK\r\n"),
] + [(100 + k, f"http://c/{k}", f"<html><body>page {k // 2} of the site</body></html>" * 20) for k in range(300)]


def test_round_trip(spark):
    manifest = warc.write_archives(pages(spark, ROWS), scratch_path(spark, "warc-test"))
    read = warc.read_archives(manifest).collect()
    assert [r.problem for r in read if r.problem] == [] and len(read) == len(ROWS) == sum(r.records for r in manifest.collect())
    payloads = {}
    for page_id, _, html in ROWS:
        payloads.setdefault((html or "").encode(), []).append(page_id)
    first = {k: min((i for i in v if i is not None), default=None) for k, v in payloads.items()}
    want = sorted(((p, len(b), first[b] if p != first[b] and len(payloads[b]) > 1 else None) for b, ids in payloads.items() for p in ids), key=repr)
    assert sorted(((r.page_id, r.payload_bytes, r.refers_to) for r in read), key=repr) == want
    for r in read:
        assert (r.payload is None) == (r.kind == "revisit")
        if r.payload is not None:
            assert warc.digest(bytes(r.payload)) == r.digest and (bytes(r.payload)) in payloads
    assert {r.url for r in read if r.page_id == 5} == {"http://a/%C3%A9%20x%0D%0AWARC-Type:%20y"}


def test_smallest_revisit(spark):
    rows = warc.round_trip(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), smallest=3).collect()
    assert sorted((r.page_id, r.kind, r.refers_to) for r in rows) == [(1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)]


def test_empty(spark):
    assert warc.round_trip(pages(spark, ROWS).filter(F.lit(False))).collect() == []


def archive(records, learned=b"", plain=False):
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(learned) if learned else None)
    head = learned if plain or not learned else zstandard.ZstdCompressor().compress(learned)
    return (struct.pack("<II", warc.SKIPPABLE, len(head)) + head if learned else b"") + b"".join(map(pack.compress, records))


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7) if n > 0 else 7)


def test_frames():
    samples = [f"<p>sample {k} of the pages that the dictionary learns from {k * k}</p>".encode() * 3 for k in range(300)]
    learned = zstandard.train_dictionary(2048, samples).as_bytes()
    made = [warc.record("response", k, "u", s, None, "d") for k, s in enumerate(samples)]
    for plain in (False, True):
        data = archive(made, learned, plain)
        skip = struct.pack("<II", 0x184D2A55, 3) + b"abc"
        assert list(warc.frames(Trickle(data + skip))) == made
        with pytest.raises(ValueError):
            list(warc.frames(io.BytesIO(data[:-2])))
    assert list(warc.frames(io.BytesIO(archive(made[:2])))) == made[:2] and list(warc.frames(io.BytesIO(b""))) == []


def test_validation():
    good = warc.record("response", 1, "u", b"payload", None, "d")
    assert warc.parse(good)["problem"] is None
    for bad, word in (
        (good.replace(b"WARC/1.1", b"WARC/9"), "version"), (good.replace(b"payload", b"paylOad"), "digest"), (good[:-2], "Content-Length"),
        (good.replace(b"WARC-Date: d\r\n", b""), "warc-date"), (good.replace(b"WARC-Date: d", b"WARC-Date d"), "header line"),
        (good.replace(b"Content-Length: 7", b"Content-Length: 8"), "HTTP"), (b"", "version"),
    ):
        assert word in warc.parse(bad)["problem"]
    assert warc.parse(warc.record("revisit", 1, "u", b"p", None, "d"))["problem"]
    assert hashlib.sha1(b"").hexdigest() and warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_bytes_on_disk(spark):
    """The dictionary's skippable frame comes first, then one frame a record, and nothing around them."""
    manifest = warc.write_archives(pages(spark, ROWS), scratch_path(spark, "warc-raw")).collect()
    for row in manifest:
        with open(row.path.removeprefix("file://").removeprefix("file:"), "rb") as f:
            raw = f.read()
        assert len(raw) == row.bytes
        magic, length = struct.unpack("<II", raw[:8])
        assert magic == warc.SKIPPABLE
        at, frames, learned = 8 + length, 0, zstandard.ZstdDecompressor().decompressobj().decompress(raw[8 : 8 + length])
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(learned))
        while at < len(raw):
            assert raw[at : at + 4] == warc.FRAME_MAGIC
            one = unpacker.decompressobj()
            content = one.decompress(raw[at:])
            assert one.eof and content.startswith(b"WARC/1.1")
            at, frames = len(raw) - len(one.unused_data), frames + 1
        assert frames == row.records


def test_archive_of_another_maker(spark, tmp_path):
    """Hostile headers are a row each, and what stands behind them is read."""
    good = warc.record("response", 1, "u", b"payload", None, "d")
    length = good.split(b"Content-Length: ")[1].split(b"\r\n")[0]
    bad = [good.replace(b"Content-Length: " + length, b"Content-Length: " + x, 1) for x in ("²".encode(), b"--5", b"9" * 30, b"-1", b"")]
    far = good.replace(b":1>", b":99999999999999999999>")
    path = str(tmp_path / "other.warc.zst")
    with open(path, "wb") as f:
        f.write(archive([good, *bad, far, good]))
    rows = warc.read_archives(spark.createDataFrame([(path,)], "path string")).orderBy("place").collect()
    assert len(rows) == len(bad) + 3 and [r.problem is None for r in rows] == [True, *[False] * len(bad), True, True]
    assert rows[0].page_id == rows[-1].page_id == 1 and rows[-2].page_id is None and bytes(rows[-1].payload) == b"payload"
