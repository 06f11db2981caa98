"""Language-model scores by deleted interpolation of n-gram estimates.

Tokens are words in lower case (A-Z) and one end token a document. The probability of a token w behind v is

    a(v) * c(v w) / c(v)  +  b(v) * c(w) / N  +  (1 - a(v) - b(v)) / (V + 1)

with counts c over the training documents, their tokens N and distinct tokens V, and weights that depend on the bucket of c(v):
0, then powers of two. A document begins behind a start mark, which counts once a document and is no token; behind what was
never seen a(v) is 0. Every context's probabilities add up to 1, one share of the last term going to all unknown words together.

The weights of each bucket are learned by expectation-maximisation on deleted counts: one in `FOLDS` of the training texts (by
a hash of the text, so copies stay together) is taken out of the counts, and what the others say of its tokens is counted
by bucket and by both estimates to a quarter of an octave. The driver gets those counts, whose number is bounded
by the steps of the estimates and not by the input, and EM runs over them. Scores then use the counts of all training texts.

How the work is spread. Tasks cut documents into chunks of `CHUNK` tokens, stored once as numbers of words with a list of
64-bit word hashes. Each chunk asks for its distinct words and word pairs, sorted, by ranges of their 63-bit keys: one row for
a chunk and range, holding differences of keys and the chunk's own counts. The owner of a range adds up what all chunks bring
and answers each in its order. So a frequent word is one entry a chunk, an owner's size follows from the number
of ranges, and texts are not shuffled. Ranges and chunks grow with the input, the rows between them with their product: at some
terabytes `CHUNK` and `RANGE` are to be raised together. Distinct words share a key with probability 2^-63 a pair.

Edge cases: null, empty and blank texts are one end token; without training documents every probability is 1 and every score 0;
without deleted texts (few documents) the weights of a bucket are equal; a bucket without deleted tokens takes the weights of
the next smaller one; documents that repeat, ids too, are scored row by row; a null in `train` means no training; columns other
than id and text are ignored, whatever their names; a very long text makes its chunk larger.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import runs, text_of, utf8

CHUNK = 1 << 19
RANGE = 1 << 20
FOLDS = 8
ROUNDS = 200
# Steps of an estimate's logarithm to the base of two, and what stands for an estimate of 0.
STEPS, NEVER = 4, -9999
# No word has a blank.
END, START = b" end", b" start"
CHUNKS = (
    "chunk bigint, deleted boolean, tokens bigint, train_tokens bigint, train_docs bigint, "
    "ids array<bigint>, train array<boolean>, lengths array<bigint>, words binary, stream binary"
)
ANSWERS = "chunk bigint, part int, deleted boolean, every binary, kept binary, distinct_all bigint, distinct_kept bigint"
SCORES = "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def packed(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


class _Words(dict):
    """Numbers of words in order of first use; 0 is the end token."""

    def __init__(self) -> None:
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class _Open:
    """A chunk being filled."""

    def __init__(self) -> None:
        self.words, self.streams, self.ids, self.train, self.size = _Words(), [], [], [], 0

    def add(self, key: int | None, train: bool, text: bytes) -> None:
        words = text.lower().split()
        words.append(END)
        self.streams.append(np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words)))
        self.ids.append(key)
        self.train.append(train)
        self.size += len(words)

    def row(self, chunk: int, deleted: bool) -> list:
        lengths = np.fromiter(map(len, self.streams), np.int64, len(self.streams))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        train = np.array(self.train)
        return [
            chunk, deleted, self.size, int(lengths[train].sum()), int(train.sum()), self.ids, self.train, lengths.tolist(),
            packed(hashes), packed(np.concatenate(self.streams)),
        ]


def _record(fields: list[tuple[str, pa.DataType]], rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


_LONG, _BOOL, _BYTES = pa.int64(), pa.bool_(), pa.binary()
_CHUNK_FIELDS = [
    ("chunk", _LONG), ("deleted", _BOOL), ("tokens", _LONG), ("train_tokens", _LONG), ("train_docs", _LONG), ("ids", pa.list_(_LONG)),
    ("train", pa.list_(_BOOL)), ("lengths", pa.list_(_LONG)), ("words", _BYTES), ("stream", _BYTES),
]


def chunked(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", size: int = CHUNK) -> DataFrame:
    """Stored chunks of documents; those whose counts are deleted have chunks of their own."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        open_ = {False: _Open(), True: _Open()}
        made = 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for key_, train_, deleted, text_ in zip(*columns, utf8(batch.column(3)), strict=True):
                chunk = open_[deleted]
                chunk.add(key_, train_, text_)
                if chunk.size >= size:
                    yield _record(_CHUNK_FIELDS, [chunk.row(first + made, deleted)])
                    open_[deleted] = _Open()
                    made += 1
        for deleted, chunk in open_.items():
            if chunk.size:
                yield _record(_CHUNK_FIELDS, [chunk.row(first + made, deleted)])
                made += 1

    learn = F.coalesce(train, F.lit(False))
    fold = F.pmod(F.xxhash64(text_of(text)), F.lit(FOLDS)) == 0
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), learn.alias("train"), (learn & fold).alias("deleted"), text_of(text).alias("text"))
    return materialise(rows.mapInArrow(fill, CHUNKS), "lm-chunks")


class Chunk:
    """The distinct keys of a stored chunk in order, and where its tokens find theirs."""

    def __init__(self, words: bytes, stream: bytes, train: list[bool], lengths: list[int]):
        hashes = unpacked(words, np.uint64)
        self.stream = unpacked(stream, np.uint32)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.learned = np.repeat(np.array(train, bool), self.lengths)
        words_ = hashes[self.stream]
        before = np.empty_like(words_)
        before[1:] = words_[:-1]
        before[self.starts] = xxhash.xxh3_64_intdigest(START)
        pairs, self.pair_of = np.unique(pair_keys(before, words_), return_inverse=True)
        keys = np.concatenate([hashes & ~np.uint64(1), pairs])
        self.n_words = len(hashes)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def counts(self) -> np.ndarray:
        """How often each key stands in the training documents of the chunk."""
        words = np.bincount(self.stream[self.learned], minlength=self.n_words)
        pairs = np.bincount(self.pair_of[self.learned], minlength=len(self.keys) - self.n_words)
        return np.concatenate([words, pairs])[self.order].astype(np.uint32)

    def looked_up(self, totals: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token its count, that of the one before (at the start: of documents), and that of the pair."""
        found = np.empty(len(totals), np.int64)
        found[self.order] = totals
        words = found[:self.n_words][self.stream]
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[self.starts] = documents
        return words, before, found[self.n_words:][self.pair_of]


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of pairs of word hashes, odd; those of words are even."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + second
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ mixed >> np.uint64(31)) | np.uint64(1)


_REQUEST_FIELDS = [("part", pa.int32()), ("chunk", _LONG), ("deleted", _BOOL), ("keys", _BYTES), ("counts", _BYTES)]


def requests(chunks: DataFrame, parts: int) -> DataFrame:
    """What each chunk asks of each range of keys."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row["words"], row["stream"], row["train"], row["lengths"])
                counts = chunk.counts()
                part = (chunk.keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                rows = []
                for p in np.flatnonzero(np.diff(cuts)):
                    lo, hi = cuts[p], cuts[p + 1]
                    steps = np.diff(chunk.keys[lo:hi], prepend=np.uint64(0))
                    rows.append([int(p), row["chunk"], row["deleted"], packed(steps), packed(counts[lo:hi])])
                yield _record(_REQUEST_FIELDS, rows)

    return chunks.select("chunk", "deleted", "train", "lengths", "words", "stream").mapInArrow(ask, "part int, chunk bigint, deleted boolean, keys binary, counts binary")


_ANSWER_FIELDS = [
    ("chunk", _LONG), ("part", pa.int32()), ("deleted", _BOOL), ("every", _BYTES), ("kept", _BYTES), ("distinct_all", _LONG), ("distinct_kept", _LONG),
]


def _single(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """One batch for each value of a sorted key."""
    for batch in batches:
        values = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(lo, hi - lo)


def answers(asked: DataFrame, parts: int) -> DataFrame:
    """The counts over all chunks, and for chunks of deleted texts also those without such texts, in the order asked.

    Rows without a chunk hold the number of distinct words of a range.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owned in _single(runs(batches, "part"), "part"):
            part, chunk, deleted = (owned.column(i).to_pylist() for i in range(3))
            keys = [np.cumsum(unpacked(k.as_py(), np.uint64)) for k in owned.column(3)]
            counts = np.concatenate([unpacked(c.as_py(), np.uint32) for c in owned.column(4)]).astype(np.int64)
            sizes = [len(k) for k in keys]
            keys = np.concatenate(keys)
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            word = (ordered[starts] & np.uint64(1)) == 0
            found = []
            for own in (counts, np.where(np.repeat(np.array(deleted), sizes), 0, counts)):
                totals = np.add.reduceat(own[order], starts)
                back = np.empty(len(keys), np.uint64)
                back[order] = totals[group]
                found.append((back, int((totals[word] > 0).sum())))
            (every, n_all), (kept, n_kept) = found
            rows, at = [[None, part[0], None, None, None, n_all, n_kept]], 0
            for c, d, n in zip(chunk, deleted, sizes, strict=True):
                rows.append([c, part[0], d, packed(every[at:at + n]), packed(kept[at:at + n]) if d else None, None, None])
                at += n
            yield _record(_ANSWER_FIELDS, rows)

    dealt = asked.repartition(ceil(parts / 4), "part").sortWithinPartitions("part")
    return materialise(dealt.mapInArrow(add_up, ANSWERS), "lm-counts")


def bucket_of(before: np.ndarray) -> np.ndarray:
    """0 for no occurrence, then one bucket for each power of two."""
    return np.frexp(before.astype(np.float64))[1]


def estimates(words: np.ndarray, before: np.ndarray, pairs: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates behind the token before, and without context."""
    return pairs / np.maximum(before, 1), words / max(tokens, 1)


def _with_answers(chunks: DataFrame, answered: DataFrame, column: str, parts: int) -> DataFrame:
    """Each chunk, followed by its answers in order of keys."""
    none = lambda *names: [F.lit(None).cast(chunks.schema[n].dataType).alias(n) for n in names]
    heads = chunks.select("chunk", F.lit(-1).alias("part"), "ids", "train", "lengths", "words", "stream", F.lit(None).cast("binary").alias("counts"))
    found = answered.filter(F.col("chunk").isNotNull()).select("chunk", "part", *none("ids", "train", "lengths", "words", "stream"), F.col(column).alias("counts"))
    return heads.unionByName(found).repartition(parts, "chunk").sortWithinPartitions("chunk", "part")


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Chunk, np.ndarray]]:
    """Row, keys and counts of each chunk."""
    head, counts = None, []

    def done() -> tuple[dict, Chunk, np.ndarray]:
        return head, Chunk(head["words"], head["stream"], head["train"], head["lengths"]), np.concatenate(counts)

    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column("part")[i].as_py() < 0:
                if head:
                    yield done()
                head, counts = batch.slice(i, 1).to_pylist()[0], []
            else:
                counts.append(unpacked(batch.column("counts")[i].as_py(), np.uint64).astype(np.int64))
    if head:
        yield done()


def deleted_counts(chunks: DataFrame, answered: DataFrame, parts: int, tokens: int, documents: int) -> DataFrame:
    """Tokens of deleted texts by bucket and by the steps of both estimates: bucket, pair, word, n."""

    def steps(values: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.where(values > 0, np.rint(STEPS * np.log2(values)), NEVER).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk, totals in _answered(batches):
            words, before, pairs = chunk.looked_up(totals, documents)
            pair, word = map(steps, estimates(words, before, pairs, tokens))
            cells = np.stack([bucket_of(before), pair, word], 1)
            found, n = np.unique(cells, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(pa.array(found[:, i].astype(np.int64)) for i in range(3)), pa.array(n)], names=["bucket", "pair", "word", "n"])

    rows = _with_answers(chunks.filter("deleted"), answered.filter("deleted"), "kept", parts)
    return rows.mapInArrow(count, "bucket bigint, pair bigint, word bigint, n bigint").groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))


def learned_weights(rows: list[tuple[int, int, int, int]], uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """For each bucket the weights of pair, word and uniform estimate, by expectation-maximisation over counted cells.

    One token more for each weight keeps every weight above 0. Behind what was never seen the pair estimate has none.
    """
    cells = np.array(rows, np.int64).reshape(-1, 4)
    weights = np.zeros((65, 3))
    for bucket in range(65):
        own = cells[cells[:, 0] == bucket]
        known = bucket > 0
        start = np.array([1.0, 1.0, 1.0]) if known else np.array([0.0, 1.0, 1.0])
        if not len(own):
            weights[bucket] = weights[bucket - 1] if bucket > 1 else start / start.sum()
            continue
        given = np.where(own[:, 1:3] == NEVER, 0.0, np.exp2(own[:, 1:3] / STEPS))
        given = np.column_stack([given, np.full(len(own), uniform)])
        now = start / start.sum()
        for _ in range(rounds):
            shares = given * now
            shares *= (own[:, 3] / shares.sum(1))[:, None]
            after = (shares.sum(0) + start) / (own[:, 3].sum() + start.sum())
            near = np.abs(after - now).max() < 1e-9
            now = after
            if near:
                break
        weights[bucket] = now
    return weights


def scored(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", size: int = CHUNK, range_: int = RANGE) -> DataFrame:
    """For each document: doc_id, train, n_tokens, n_known (in training texts), train_tokens, base_score (add-one), score."""
    chunks = chunked(docs, train, key, text, size)
    total = chunks.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("chunks"),
        *(F.coalesce(F.sum(F.when(cond, F.col(f"train_{n}"))), F.lit(0)).alias(f"{of}_{n}")
          for of, cond in (("all", F.lit(True)), ("kept", ~F.col("deleted"))) for n in ("tokens", "docs")),
    ).first()
    parts, groups = max(1, ceil(total.tokens / range_)), max(1, ceil(total.chunks / 4))
    answered = answers(requests(chunks, parts), parts)
    distinct = answered.agg(*(F.coalesce(F.sum(f"distinct_{n}"), F.lit(0)).alias(n) for n in ("all", "kept"))).first()
    deleted = deleted_counts(chunks, answered, groups, total.kept_tokens, total.kept_docs)
    weights = learned_weights([tuple(r) for r in deleted.collect()], 1 / (distinct.kept + 1))
    if not total.all_tokens:
        weights = np.tile([0.0, 0.0, 1.0], (65, 1))
    tokens, documents, types = total.all_tokens, total.all_docs, distinct.all

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk, totals in _answered(batches):
            words, before, pairs = chunk.looked_up(totals, documents)
            pair, word = estimates(words, before, pairs, tokens)
            a, b, c = weights[bucket_of(before)].T
            logs = np.log10(a * pair + b * word + c / (types + 1))
            base = np.log10((words + 1) / (tokens + types + 1))
            sums = [np.add.reduceat(x, chunk.starts) for x in ((words > 0).astype(np.int64), base, logs)]
            columns = [pa.array(row["ids"], _LONG), pa.array(row["train"], _BOOL), pa.array(chunk.lengths), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

    found = _with_answers(chunks, answered, "every", groups).mapInArrow(score, SCORES)
    return found.withColumn("train_tokens", F.lit(tokens).cast("long"))
