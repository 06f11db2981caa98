r"""Secret scans with a recursive decoding worklist.

A text is scanned as it stands; then it is decoded to layers, which are scanned and searched for tokens in turn, until no
layer is new. Percent escapes (%41 and %u0041) and those of programs (Unicode, hexadecimal, octal of two or three digits) make one layer each, the whole
text with its escapes put in place, and percent escapes one more in which each + is a blank, as forms write it. A sign that was
escaped over and over, %252541 or \u005cu0041, is put in place at once. A base64 token,
in one line or in several, at each of the four places where its first group can begin, and compressed bytes in what any of
them gave (gzip, zlib, bzip2, xz, damaged ones as far as they go; zlib with a smaller window, if undamaged; raw deflate, which has no mark, where it is all of the token at one of the four
places), make a layer of their content between what stands on both sides, as far as a
rule that holds the edge can reach. So a key and its value are found together, however each is written. Decoded bytes are
read as one character each, for the rules know ASCII alone; no byte bars a layer, and the zeros of UTF-16 are left out. A layer is known by the
digest of its content and the part of the text it came from, so cycles end and a layer that occurs twice is found at both
places. Every layer keeps, for each of its characters, the span of the original text it was made from; a finding in a layer
is reported as the span of the original that holds it.

`scanned` adds the findings of the three kinds to each row; `redacted` replaces them in the text. Rows are independent, so
nothing is shuffled and whole texts are read. Compressed bytes are read to the end of their last member. Content of more than
`CHUNK` characters is scanned in chunks that overlap by `OVERLAP`; a token in it that is longer than a chunk is decoded in
parts, and of compressed bytes longer than a chunk that do not begin it only those of their first chunk are inflated, which
is the only bound.

Edge cases: a null text is empty and stays null when redacted; repeated rows are scanned alike; other columns are kept, also one that bears the name of a result, since all
results stand in one struct (`OUT`).
"""
from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterable, Iterator
from contextlib import suppress
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

OUT = "_tl_secrets"
KINDS = ("assign", "access", "hex")
CHUNK, OVERLAP = 1 << 24, 1 << 20  # characters of an inflated layer
FEED, PIECE = 1 << 16, 1 << 20  # bytes in and out of a decompressor at a time
NESTED = 200

ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A run that is too short fails as a whole, so asking for the least length finds the same matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6

# An escape whose first sign was escaped in turn, however often, is one escape.
PERCENT_ESCAPE = re.compile(r"%(?:25)*(?:([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4}))")
FORM_ESCAPE = re.compile(rf"{PERCENT_ESCAPE.pattern}|\+")
ESCAPE = re.compile(
    r"\\(?:u005[cC]|U0000005[cC]|u\{0*5[cC]\}|x5[cC]|134)*"
    r"(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2})|u\{([0-9A-Fa-f]{1,6})\}|([0-3][0-7]{2}|[0-7]{2}))"
)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
SHORT_ESCAPE = re.compile(r"""\\[abfnrtv0/'"\\]""")
ANY_ESCAPE = re.compile(ESCAPE.pattern + r"""|\\([abfnrtv0/'"\\])""")
SHORT = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0", strict=True))

# The two bytes at which zlib begins, for each size of its window (RFC 1950).
ZLIB = {bytes((size, flags)) for size in range(0x08, 0x79, 0x10) for flags in range(256) if (size << 8 | flags) % 31 == 0 and not flags & 0x20}
# These alone begin a damaged stream; the others occur in any bytes, so theirs must have an end and the right sum.
USUAL = {b"x\x01", b"x^", b"x\x9c", b"x\xda"}
# Where gzip, bzip2, xz and zlib begin, in bytes as characters.
MAGIC = re.compile("\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\0|" + "|".join(re.escape(z.decode("latin-1")) for z in sorted(ZLIB)))
BLANK = re.compile(r"[\x20\t\r\n]")
WIDE = re.compile(r"(?:[^\x00]\x00{1,3}){3,}[^\x00]?")
MORE = re.compile(rf"%u?[0-9A-Fa-f]{{2}}|\\(?:[uUx]|[0-7]{{2}})|{MAGIC.pattern}|{WIDE.pattern}")

# All that a match which holds the edge of a token can take in beside it.
REACH = re.compile(r"""[A-Za-z0-9+/_.=-]*[\x20"':=]*[A-Za-z0-9+/_.=-]*""")
# Base64 in lines; a line break may be written as an escape.
LINE_BREAK = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
UNBROKEN = re.compile(r"[A-Za-z0-9+/_-]+")
WRAPPED = re.compile(rf"{BASE64.pattern.removesuffix('={0,2}')}+(?:{LINE_BREAK.pattern}+{UNBROKEN.pattern}+)+={{0,2}}")

Span = tuple[int, int, str]


def find(text: str) -> list[Span]:
    """(start, end, kind) of the base rules, each kind leftmost and non-overlapping."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= SHORTEST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


class Layer:
    """A text with the span of the original behind each character; spans are in order.

    The text from `lo` to `hi` is what the layer adds to those before it; tokens and findings that keep out of it are known.
    """

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, lo: int = 0, hi: int | None = None):
        self.text, self.starts, self.ends, self.lo, self.hi = text, starts, ends, lo, len(text) if hi is None else hi

    def place(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])

    @cached_property
    def turned(self) -> str:
        return self.text[::-1]

    def found(self) -> Iterator[Span]:
        return ((*self.place(s, e), kind) for s, e, kind in find(self.text) if s < self.hi and e > self.lo)

    def beside(self, start: int, end: int) -> tuple[int, int]:
        """start:end with as much of the text on both sides as a rule can reach."""
        behind = len(self.text) - start
        return start + behind - REACH.match(self.turned, behind).end(), REACH.match(self.text, end).end()

    def put(self, start: int, end: int, text: str, starts: np.ndarray, ends: np.ndarray, first: bool = True, last: bool = True) -> Layer:
        """`text` in the place of start:end, with what stands beside it; a chunk has only the neighbour it adjoins."""
        left, right = self.beside(start, end)
        left, right = left if first else start, right if last else end
        if left == start and right == end:
            return Layer(text, starts, ends)
        return Layer(
            self.text[left:start] + text + self.text[end:right],
            np.concatenate([self.starts[left:start], starts, self.starts[end:right]]),
            np.concatenate([self.ends[left:start], ends, self.ends[end:right]]),
            start - left,
            start - left + len(text),
        )


def _opened(head: bytes):
    """A decompressor for bytes that begin so, or None."""
    if head[:3] == b"\x1f\x8b\x08":
        return zlib.decompressobj(31)
    if head[:2] in ZLIB:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if head[:6] == b"\xfd7zXZ\0" else None


class Members:
    """What compressed members, one after the other, hold, in pieces of PIECE bytes at most; of a damaged one what precedes the fault.

    When all is read, `fed` less the length of `rest` bytes were theirs, `whole` of them had an end, and `broken` tells whether the
    last has none.
    """

    def __init__(self, source: Iterator[bytes]):
        self.source, self.fed, self.rest, self.whole, self.broken = source, 0, b"", 0, False

    def _read(self) -> bytes:
        piece = next(self.source, b"")
        self.fed += len(piece)
        return piece

    def __iter__(self) -> Iterator[bytes]:
        while True:
            while len(self.rest) < 6 and (piece := self._read()):
                self.rest = (self.rest + piece).lstrip(b"\0")  # members may be padded
            d = _opened(self.rest)
            if d is None:
                return
            feed, self.rest = self.rest, b""
            while not d.eof:
                before = d.copy() if hasattr(d, "copy") else None
                try:
                    out = d.decompress(feed, PIECE)
                except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
                    self.broken = True
                    yield from _until_fault(before, feed)
                    return
                if out:
                    yield out
                feed = getattr(d, "unconsumed_tail", b"")
                if not (out or feed or d.eof) and getattr(d, "needs_input", True):
                    feed = self._read()
                    if not feed:
                        self.broken = True
                        return
            self.whole += 1
            self.rest = d.unused_data.lstrip(b"\0")


def _until_fault(d, feed: bytes) -> Iterator[bytes]:
    """What zlib gives before the byte at which it fails."""
    with suppress(zlib.error):
        for k in range(len(feed) if d else 0):
            yield d.decompress(feed[k : k + 1])


def _raw_deflate(raw: bytes) -> Iterator[bytes]:
    """What bytes hold that are one whole raw deflate stream, in pieces of PIECE bytes at most; nothing if they are not."""
    for keep in (False, True):  # read once to its end, for no sign tells such a stream before
        d, feed, size = zlib.decompressobj(-zlib.MAX_WBITS), raw, 0
        with suppress(zlib.error):
            while not d.eof and (out := d.decompress(feed, PIECE)):
                size += len(out)
                feed = d.unconsumed_tail
                if keep:
                    yield out
        if not d.eof or d.unused_data or not size:
            return


def _slices(raw: memoryview) -> Iterator[bytes]:
    return (bytes(raw[k : k + FEED]) for k in range(0, len(raw), FEED))


def _pieces(raw: memoryview) -> Iterator[bytes]:
    """The content of compressed bytes; if it is longer than a chunk and compressed again, the content of that."""
    found = iter(Members(_slices(raw)))
    for _ in range(NESTED):
        head, size = [], 0
        while size < CHUNK and (piece := next(found, None)) is not None:
            head.append(piece)
            size += len(piece)
        again = size >= CHUNK and _opened(b"".join(head[:8])) is not None
        found = chain(head, found)
        if not again:
            break
        found = iter(Members(found))
    return found


def _chunks(pieces: Iterable[bytes]) -> Iterator[tuple[str, bool, bool]]:
    """The bytes as texts of CHUNK characters or so, each with the last OVERLAP of the one before; whether it is the first, the last."""
    held, first = bytearray(), True
    for piece in pieces:
        if len(held) >= CHUNK:
            yield held.decode("latin-1"), first, False
            held, first = held[-OVERLAP:], False
        held += piece
    if held:
        yield held.decode("latin-1"), first, True


def _inflated(layer: Layer) -> Iterator[Layer]:
    raw, done = None, 0
    for m in MAGIC.finditer(layer.text, max(layer.lo - 9, 0), min(layer.hi + 9, len(layer.text))):
        if m.start() < done or m.start() >= layer.hi or m.end() <= layer.lo:
            continue
        raw = raw or memoryview(layer.text.encode("latin-1", "replace"))
        members = Members(_slices(raw[m.start() :]))
        if not sum(map(len, members)):
            continue
        if not members.whole and (begin := bytes(raw[m.start() : m.start() + 2])) in ZLIB and begin not in USUAL:
            continue
        if members.broken:
            end = _broken_end(layer, m.end())
        else:
            end = done = m.start() + members.fed - len(members.rest)
        start, stop = layer.starts[m.start() : end].min(), layer.ends[m.start() : end].max()
        for text, first, last in _chunks(_pieces(raw[m.start() :])):
            yield layer.put(m.start(), end, text, np.broadcast_to(start, len(text)), np.broadcast_to(stop, len(text)), first, last)


def _broken_end(layer: Layer, at: int) -> int:
    """Where bytes without an end stop: at the first blank that is written plainly, or with the token they came from."""
    for m in BLANK.finditer(layer.text, at):
        if layer.ends[m.start()] - layer.starts[m.start()] == 1:
            return min(m.start(), max(at, layer.hi))
    return max(at, layer.hi)


def _wide(layer: Layer) -> Iterator[Layer]:
    """The text of UTF-16 and UTF-32: the zeros between its characters left out."""
    if "\0" in layer.text and WIDE.search(layer.text):
        zeros = [(k, k + 1) for m in WIDE.finditer(layer.text) for k in range(m.start(), m.end()) if layer.text[k] == "\0"]
        yield _replaced(layer, [(a - 1, b) for a, b in zeros], WIDE.sub(lambda m: m.group().replace("\0", ""), layer.text))


def _replaced(layer: Layer, spans: Iterable[tuple[int, int]], text: str) -> Layer:
    """The whole text with a character in the place of each span."""
    whole = np.ones(len(layer.text), bool)
    for start, end in spans:
        whole[start + 1 : end] = False
    first = np.flatnonzero(whole)
    last = np.append(first[1:], len(layer.text)) - 1
    lo, hi = np.searchsorted(first, [layer.lo, layer.hi]).tolist()
    return Layer(text, layer.starts[first], layer.ends[last], lo, hi)


def _unescaped(layer: Layer, escape: re.Pattern, char) -> Layer:
    return _replaced(layer, (m.span() for m in escape.finditer(layer.text)), escape.sub(char, layer.text))


def _percent(layer: Layer) -> Iterator[Layer]:
    # a byte is a character: the rules know ASCII alone, and bytes above it part words as the letters they stand for do
    if "%" in layer.text and PERCENT_ESCAPE.search(layer.text):
        yield _unescaped(layer, PERCENT_ESCAPE, _byte)
        if "+" in layer.text:
            yield _unescaped(layer, FORM_ESCAPE, _byte)


def _char(code: int) -> str:
    return "\ufffd" if code > 0x10FFFF or 0xD800 <= code < 0xE000 else chr(code)


def _byte(m: re.Match) -> str:
    return _char(int(m.group(m.lastindex), 16)) if m.lastindex else " "


def _code(m: re.Match) -> str:
    digits = m.group(m.lastindex)
    if m.lastindex == 6:
        return SHORT.get(digits, digits)
    return _char(int(digits, 8 if m.lastindex == 5 else 16))


def _unicode(layer: Layer) -> Iterator[Layer]:
    if "\\" in layer.text and ESCAPE.search(layer.text):
        yield _unescaped(layer, ESCAPE, _code)
        if SHORT_ESCAPE.search(layer.text):  # bytes and strings as programs write them, every character of which counts
            yield _unescaped(layer, ANY_ESCAPE, _code)


def _base64(layer: Layer) -> Iterator[Layer]:
    for form in (BASE64, WRAPPED):
        for m in form.finditer(layer.text):
            if m.start() >= layer.hi or m.end() <= layer.lo:
                continue
            body = m.group().rstrip("=")
            at = None
            if form is WRAPPED:
                at = np.concatenate([np.arange(*r.span()) for r in UNBROKEN.finditer(LINE_BREAK.sub(lambda x: " " * len(x.group()), body))]) + m.start()
                body = LINE_BREAK.sub("", body)
            body = body.replace("-", "+").replace("_", "/")
            # the run may begin with a part of what stands before the token, so all four alignments are read
            for skip in range(4):
                size = len(body) - skip
                size -= size % 4 == 1
                raw = binascii.a2b_base64(body[skip : skip + size] + "=" * (-size % 4))
                if not raw:
                    continue
                place = at if at is not None else np.arange(m.start(), m.start() + len(body))
                start, end = int(place[skip]), m.end() if skip + size == len(body) else int(place[skip + size - 1]) + 1
                left, right = layer.beside(start, end)
                packed = _chunks(_raw_deflate(raw))
                span = layer.starts[place[skip] : end].min(), layer.ends[place[skip] : end].max()
                for text, first, last in packed:
                    yield layer.put(start, end, text, np.broadcast_to(span[0], len(text)), np.broadcast_to(span[1], len(text)), first, last)
                text = raw.decode("latin-1")
                if not _matters(layer.text[left:start], text, layer.text[end:right]):
                    continue
                # byte k comes from the characters that hold its first and its last bit
                k = np.arange(len(raw))
                low, high = place[skip + 8 * k // 6], place[skip + (8 * k + 7) // 6]
                ends = np.maximum(layer.ends[low], layer.ends[high])
                ends[-1] = max(ends[-1], layer.ends[end - 1])  # with the padding
                yield layer.put(start, end, text, np.minimum(layer.starts[low], layer.starts[high]), ends)


def _matters(left: str, text: str, right: str) -> bool:
    """Whether a layer can hold a finding or a token; most bytes of mere words hold neither."""
    whole = left + text + right
    lo, hi = len(left), len(left) + len(text)
    return bool(MORE.search(whole) or ENCODED.search(whole, max(lo - 15, 0), hi + 15) or any(s < hi and e > lo for s, e, _ in find(whole)))


TOKENS = (_percent, _unicode, _base64)
BYTES = (_inflated, _wide)  # of what has been decoded
# A text without these has no layers; most texts are done after one look.
ENCODED = re.compile(r"%u?[0-9A-Fa-f]{2}|\\[uU][0-9A-Fa-f{]|\\x[0-9A-Fa-f]|\\[0-7]{2}|[A-Za-z0-9+/_-]{16}")


def _decoded(layer: Layer, decoders: tuple) -> Iterator[Layer]:
    return (made for decode in decoders for made in decode(layer) if made.text and made.text != layer.text)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base findings, and all findings with those of the decoded layers; each sorted by start, then kind, then end."""
    base = find(text)
    every = set(base)
    if ENCODED.search(text):
        places = np.arange(len(text) + 1, dtype=np.int32)
        seen = set()
        # depth first, so that a long content is held a chunk at a time
        work = [_decoded(Layer(text, places[:-1], places[1:]), TOKENS)]
        while work:
            made = next(work[-1], None)
            if made is None:
                work.pop()
                continue
            mark = (hashlib.blake2b(made.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), int(made.starts[0]), int(made.ends[-1]), made.lo, made.hi)
            if mark in seen:
                continue
            seen.add(mark)
            every.update(made.found())
            work.append(_decoded(made, TOKENS + BYTES))
    order = lambda f: (f[0], KINDS.index(f[2]), f[1])
    return sorted(base, key=order), sorted(every, key=order)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = "base string, spans string, n_assign bigint, n_access bigint, n_hex bigint, clean string"


def _scanner(mask: bool):
    def scan_all(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base, every = scan(text)
                count = [sum(kind == k for _, _, kind in base) for k in KINDS]
                rows.append((listed(base), listed(every), *count, mask_spans(text, every) if mask and every else None))
            yield pd.DataFrame(rows, columns=["base", "spans", "n_assign", "n_access", "n_hex", "clean"])

    return F.pandas_udf(scan_all, SCHEMA)


def mask_spans(text: str, spans: list[Span]) -> str:
    """`text` with every found span, overlapping ones together, replaced by the kind that begins it."""
    out, at = [], 0
    merged: list[list] = []
    for start, end, kind in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def _result(text: str, mask: bool) -> Column:
    return _scanner(mask)(text_of(text))


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the struct `OUT`: base and spans as "kind:start:end,...", and the base counts per kind."""
    return docs.withColumn(OUT, _result(text, False))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every secret in the text, encoded ones too, replaced by its kind in brackets."""
    found = docs.withColumn(OUT, _result(text, True))
    clean = F.when(F.col(f"`{text}`").isNull(), F.lit(None)).otherwise(F.coalesce(F.col(f"{OUT}.clean"), F.col(f"`{text}`")))
    return found.select(*((clean.alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns))
