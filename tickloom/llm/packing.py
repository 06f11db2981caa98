"""Best-fit packing of documents into token sequences, planned over a histogram of lengths.

1. `tokenized` turns every document into pieces of at most `size` tokens: its ids, then a closing id 0, cut only where the
   whole is longer.
2. The lengths of all pieces are counted; at most `size` counts reach the driver, whatever the number of pieces.
3. `best_fit` places counts, longest first, each into the sequences with the least room that is enough. The plan is a list
   of slots: so many ranks of a length go to consecutive sequences at one offset. Its size depends on `size` alone.
4. `packed` ranks the pieces of each length and looks every rank up in the plan. Ranks need no group to be gathered: each
   task counts its pieces of every length as it stores them, and the tasks' counts are summed along the tasks. Ids are stored
   and sent with 16 bits where they fit.

Edge cases: a null or empty text is one piece, the closing id; rows are pieces of their own however often they repeat; an
empty table gives no pieces; other columns are not read. Which of several pieces of equal length takes which slot of that
length depends on how the rows are stored; the number of sequences and their filling do not.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise
from .common import arrow_rows, list_array, utf8, worker_table

SIZE = 2048
# Words kept with their ids by each Python worker; some 120 MB. A word beyond is encoded again.
REMEMBERED = 600_000
LONG_WORD = 64
SLICE = 256


def vocabulary() -> str:
    """The tokenizer's file in the installed collection of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# A mark between a letter or digit and white space is a piece of its own, so white space may stand before it too.
_MARK = re.compile(rb"[.,!?;:](?:(?<=[A-Za-z0-9].)|(?<=\xC3[\x80-\x96\x98-\xB6\xB8-\xBF].))(?=[\x20\x09-\x0D]|\Z)")
# Words that the vocabulary takes as one piece.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
# Lead bytes of combining marks, which the vocabulary joins with letters before it lowers them.
_COMBINING = (b"\xcc", b"\xcd")


class WordIds(dict):
    """The ids of a word as little-endian 32-bit integers.

    The vocabulary's rules drop white space and never join across it, so the ids of a text are those of its words, which
    are cut at ASCII white space; words repeat, and each is encoded once. Case does not count, and marks at the end of a
    word are pieces of their own, so words that differ in these share an entry. New words of a slice of texts are encoded
    together.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[ends] = True

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        """The words whose ids, one after the other, are those of the text."""
        if b"<|" not in text and not any(b in text for b in _COMBINING):
            text = _MARK.sub(rb" \g<0>", text.lower())
        return text.split()

    def __missing__(self, word: bytes) -> bytes:
        made = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= LONG_WORD:
            self[word] = made
        return made

    def learn(self, words: set[bytes]) -> None:
        """Encode the new words that are one piece each, many in one call."""
        if len(self) >= REMEMBERED:
            self.clear()
        new = [w for w in words if w not in self and len(w) <= LONG_WORD and _PLAIN.fullmatch(w.decode())]
        lines = [new[k : k + 1000] for k in range(0, len(new), 1000)]
        encoded = self.tokenizer.encode_batch_fast([b" ".join(x).decode() for x in lines], add_special_tokens=False)
        for line, found in zip(lines, encoded, strict=True):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(line):  # a vocabulary that cuts such words; each is encoded when it is met
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(line, (4 * cuts).tolist(), strict=True):
                self[word] = raw[start:end]
                start = end

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.__getitem__, words)) for words in split]


def word_ids(path: str) -> WordIds:
    """One table per Python worker, which the tasks it runs one after the other share."""
    return worker_table(f"ids of {path}", lambda: WordIds(path))


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
# The task that cut a piece, and the piece's place among those of its length there.
PLACES = "_tl_part bigint, _tl_nth bigint"


class _Counter:
    """Places of a task's pieces among those of equal length."""

    def __init__(self, size: int):
        self.part, self.seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)

    def columns(self, lengths: np.ndarray) -> list[pa.Array]:
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        nth = np.empty(len(lengths), np.int64)
        nth[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + self.seen[ordered]
        self.seen += np.bincount(lengths, minlength=len(self.seen))
        return [pa.array(np.full(len(lengths), self.part, np.int64)), pa.array(nth)]


def tokenized(
    docs: DataFrame, path: str | None = None, size: int = SIZE, key: str = "doc_id", text: str = "text", ranked: bool = False, narrow: bool = False
) -> DataFrame:
    """Pieces of the documents: doc_id, piece, start, length, ids (unsigned 32-bit integers, little-endian).

    With `ranked` the columns of `PLACES` follow, which spare `packed` a pass; with `narrow` ids that fit have 16 bits.
    """
    path = path or vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "piece", "start", "length", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        counter = _Counter(size) if ranked else None
        for batch in batches:
            for rows in arrow_rows(batch, SLICE):
                words = word_ids(path)
                out: list[list] = [[], [], [], [], []]
                for key_, ids in zip(rows.column(0).to_pylist(), words.of(utf8(rows.column(1))), strict=True):
                    ids += b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at : at + 4 * size]
                        for column, value in zip(out, (key_, piece, at // 4, len(part) // 4, _narrow(part) if narrow else part), strict=True):
                            column.append(value)
                columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
                if counter:
                    columns += counter.columns(np.array(out[3], np.int64))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["_tl_part", "_tl_nth"][: 2 * ranked])

    slim = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return slim.mapInArrow(cut, f"{PIECES}, {PLACES}" if ranked else PIECES)


def best_fit(counts: dict[int, int], size: int = SIZE) -> tuple[np.ndarray, int]:
    """The plan for so many pieces of each length, and its number of sequences.

    Rows of the plan: length, first rank, ranks, first sequence, offset, ordered by length and rank. Rank r of the length
    goes to sequence `first + r - first rank`.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # runs of open sequences (first, how many) by the room left in them
    plan: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            fits = [r for r in room if r >= length]
            if not fits:
                each = size // length
                opened = -(-left // each)
                for turn in range(each):
                    here = min(opened, left)
                    if not here:
                        break
                    plan.append((length, rank, here, sequences, turn * length))
                    rank, left = rank + here, left - here
                    if not left:  # sequences that got this many pieces, and those that got one fewer
                        _leave(room, size - (turn + 1) * length, sequences, here)
                        _leave(room, size - turn * length, sequences + here, opened - here)
                    elif turn == each - 1:
                        _leave(room, size - each * length, sequences, opened)
                sequences += opened
                continue
            best = min(fits)
            first, many = room[best].pop()
            if not room[best]:
                del room[best]
            here = min(many, left)
            plan.append((length, rank, here, first, size - best))
            rank, left = rank + here, left - here
            _leave(room, best - length, first, here)
            _leave(room, best, first + here, many - here)
    return np.array(sorted(plan), np.int64).reshape(-1, 5), sequences


def _leave(room: dict[int, list[tuple[int, int]]], left: int, first: int, many: int) -> None:
    if many and left:
        room.setdefault(left, []).append((first, many))


def _narrow(ids: bytes | None) -> bytes | None:
    """16 bits an id where all ids of a piece allow it."""
    if ids is None:
        return None
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if wide.size and wide.max() < 1 << 16 else ids


def _wide(ids: bytes | None, length: int) -> bytes | None:
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes() if ids is not None and len(ids) == 2 * length else ids


def _counted(pieces: DataFrame, size: int) -> DataFrame:
    """`pieces` with the columns of `PLACES`; ids narrow."""
    columns = pieces.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(size)
        for batch in batches:
            places = counter.columns(batch.column("length").to_numpy())
            if "ids" in columns:
                at = batch.schema.get_field_index("ids")
                batch = batch.set_column(at, "ids", pa.array([_narrow(x) for x in batch.column(at).to_pylist()], pa.binary()))
            yield batch.append_column("_tl_part", places[0]).append_column("_tl_nth", places[1])

    return pieces.mapInArrow(count, StructType([*pieces.schema.fields]).add("_tl_part", "long").add("_tl_nth", "long"))


def packed(pieces: DataFrame, size: int = SIZE, narrow: bool = False) -> DataFrame:
    """`pieces`, which have a `length` of 1 to `size`, with `sequence_id` and `offset` (where in it the piece begins).

    With `narrow`, ids that fit have 16 bits, as `sequences` takes them too.
    """
    columns = [c for c in pieces.columns if c not in ("_tl_part", "_tl_nth")]
    stored = materialise(pieces if "_tl_nth" in pieces.columns else _counted(pieces, size), "pieces")
    counts = materialise(stored.groupBy("length", "_tl_part").agg(F.count(F.lit(1)).alias("_tl_n")), "lengths")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_tl_n")).collect()}  # at most `size` rows
    plan, _ = best_fit(histogram, size)
    before = counts.select(
        "length", "_tl_part",
        (F.sum("_tl_n").over(Window.partitionBy("length").orderBy("_tl_part")) - F.col("_tl_n")).alias("_tl_before"),
    )
    ranked = stored.join(before, ["_tl_part", "length"]).select(*columns, (F.col("_tl_before") + F.col("_tl_nth")).alias("_tl_rank"))
    schema = ranked.drop("_tl_rank").schema.add("sequence_id", "long").add("offset", "long")
    starts = plan[:, 0] << 44 | plan[:, 1]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, lengths = batch.column("_tl_rank").to_numpy(), batch.column("length")
            slot = np.searchsorted(starts, lengths.to_numpy() << 44 | ranks, side="right") - 1
            batch = batch.drop_columns(["_tl_rank"])
            if "ids" in columns and not narrow:
                at = batch.schema.get_field_index("ids")
                ids = [_wide(x, n) for x, n in zip(batch.column(at).to_pylist(), lengths.to_pylist(), strict=True)]
                batch = batch.set_column(at, "ids", pa.array(ids, pa.binary()))
            batch = batch.append_column("sequence_id", pa.array(plan[slot, 3] + ranks - plan[slot, 1]))
            yield batch.append_column("offset", pa.array(plan[slot, 4]))

    return ranked.mapInArrow(look_up, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, tokens, ids, doc_ids, and the pieces in order as (doc_id, piece, offset, length).

    A sequence holds at most as many pieces as tokens, so a group is small by construction.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    df = placed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), parts.alias("pieces"))
    schema = "sequence_id bigint, tokens bigint, ids array<int>, doc_ids array<bigint>, pieces array<struct<doc_id:bigint,piece:int,offset:bigint,length:bigint>>"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces = batch.column("pieces").flatten(), batch.column("pieces")
            offsets = pa.array(pieces.offsets.to_numpy() - pieces.offsets[0].as_py(), pa.int32())
            column = {f.name: rows.field(k) for k, f in enumerate(rows.type)}
            ids = [_wide(x, n) for x, n in zip(column["ids"].to_pylist(), column["length"].to_pylist(), strict=True)]
            ids = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            names = ["doc_id", "piece", "offset", "length"]
            kept = pa.StructArray.from_arrays([column[n] for n in names], names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), batch.column("tokens"), list_array(ids, batch.column("tokens").to_pylist(), pa.int32()),
                 pa.ListArray.from_arrays(offsets, column["doc_id"]), pa.ListArray.from_arrays(offsets, kept)],
                names=["sequence_id", "tokens", "ids", "doc_ids", "pieces"],
            )

    return df.mapInArrow(join, schema)
