"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a text: its words and pairs of words, the shapes of its words (letters and digits by class, other characters as
they are) alone, in pairs and in threes, and immediate repeats of a word. They are hashed to `BUCKETS` places; a value is
the root of the feature's share in the text, so that every text has length one whatever its size.

Training reads at most `TRAIN_ROWS` labelled documents, those with the smallest hash of their id, with their whole texts.
Each pass streams them through `SHARDS` learners at once, whose states are averaged before the next pass; a learner holds
its state and one batch. Scores are sparse dot products over the whole text.

Edge cases: a null or empty text has the intercept alone and is scored; labels without a value or a document are left out,
repeated ones count once, contradicting ones both; without any label every score is one half; repeated documents are scored
alike; other columns are kept by `scored`, also one that bears the name of a result, since it stands in one struct (`OUT`).
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import arrow_rows, list_array, smallest_hashes, text_of, utf8

OUT = "_tl_quality"
BITS = 18
BUCKETS = 1 << BITS  # and one place more, for the intercept
TRAIN_ROWS = 20_000
SHARDS, PASSES = 4, 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-3, 1e-3
CUT = 0.3
REMEMBERED = 400_000
LONG_WORD = 64

# Classes of bytes: lower case and all beyond ASCII, upper case, digits; the others stand for themselves.
_CLASSES = bytes(
    0x61 if 0x61 <= b <= 0x7A else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256)
)
_BEYOND = bytes(range(0x80, 0x100))
_RUN = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """`The` gives `Aa`, `1,55%` gives `0,0%`; runs count as one, letters beyond ASCII are passed over."""
    return _RUN.sub(rb"\1", word.translate(_CLASSES, _BEYOND))[:16]


class _ShapeHashes(dict):
    def __missing__(self, classes: bytes) -> int:
        made = xxhash.xxh32_intdigest(_RUN.sub(rb"\1", classes)[:16], 1)
        if len(self) < REMEMBERED and len(classes) <= LONG_WORD:
            self[classes] = made
        return made


class WordHashes(dict):
    """Hash of a word in the upper, of its shape in the lower 32 bits."""

    def __init__(self):
        super().__init__()
        self.shapes = _ShapeHashes()

    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh32_intdigest(word) << 32 | self.shapes[word.translate(_CLASSES, _BEYOND)]
        if len(word) <= LONG_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = made
        return made


@lru_cache(1)
def word_hashes() -> WordHashes:
    """One table per Python worker, which the tasks it runs one after the other share."""
    return WordHashes()


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _places(*parts: np.ndarray, kind: int) -> np.ndarray:
    """Bucket of each n-gram, given the hashes of its members in order."""
    h = np.full(len(parts[0]), kind + 1, np.uint64)
    for p in parts:
        h = (h ^ p) * _ODD
        h ^= h >> np.uint64(29)
    return (h * _ODD >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: bytes, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending, the intercept last) and values of a text."""
    words = text.split()
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    w, s = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    again = s[1:][w[1:] == w[:-1]]
    every = np.concatenate([
        _places(w, kind=0), _places(w[:-1], w[1:], kind=1), _places(s, kind=2), _places(s[:-1], s[1:], kind=3),
        _places(s[:-2], s[1:-1], s[2:], kind=4), _places(np.zeros_like(again), kind=5),
    ])
    every.sort()
    new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    share = np.diff(np.append(new, len(every))) / max(1, len(every))
    return np.append(every[new], np.int32(BUCKETS)), np.append(np.sqrt(share), 1.0).astype(np.float32)


class Learner:
    """FTRL-proximal state per place: z and the sum of squared gradients."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros(BUCKETS + 1) if z is None else z.copy()
        self.n = np.zeros(BUCKETS + 1) if n is None else n.copy()

    def weights(self, places: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        g = (probability(float(w @ values)) - label) * values
        n = self.n[places]
        self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[places] = n + g * g


def probability(margin: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(30.0, max(-30.0, margin))))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Features of the labelled documents to learn from: shard, place in it, label, places, values."""
    order = F.xxhash64("doc_id", F.lit("quality"))
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).dropna().withColumn("_tl_order", order)
    chosen = known.filter(smallest_hashes("_tl_order", rows, known.count())).distinct().orderBy("_tl_order", "doc_id", "label").limit(rows)
    # at most `rows` rows of three numbers, whatever the size of the tables
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batches:
            for part in arrow_rows(batch, 128):
                made = [features(t, hashes) for t in utf8(part.column("text"))]
                size = [len(p) for p, _ in made]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_tl_order"), part.column("doc_id"), part.column("label"),
                     list_array(np.concatenate([p for p, _ in made]), size, pa.int32()), list_array(np.concatenate([v for _, v in made]), size, pa.float32())],
                    names=["place", "doc_id", "label", "places", "values"],
                )

    schema = "place bigint, doc_id bigint, label int, places array<int>, values array<float>"
    made = texts.select("_tl_order", "doc_id", "label", "text").mapInArrow(make, schema)
    return made.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int"))


def _pass(rows: DataFrame, state: Learner) -> Learner:
    """One pass of every shard from the same state; the average of what they learn."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, shard, seen = None, None, 0
        out = lambda: pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([seen], pa.int64()), pa.array([learner.z.tobytes()], pa.binary()), pa.array([learner.n.tobytes()], pa.binary())],
            names=["shard", "seen", "z", "n"])
        for batch in batches:
            for k, (own, label) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("label").to_pylist(), strict=True)):
                if own != shard:
                    if learner:
                        yield out()
                    learner, shard, seen = Learner(state.z, state.n), own, 0
                learner.learn(batch.column("places")[k].values.to_numpy(), batch.column("values")[k].values.to_numpy().astype(float), label)
                seen += 1
        if learner:
            yield out()

    dealt = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", "doc_id", "label")
    found = dealt.select("shard", "label", "places", "values").mapInArrow(learn, "shard int, seen bigint, z binary, n binary").collect()  # SHARDS rows
    if not found:
        return state
    found.sort(key=lambda r: r.shard)
    share = np.array([r.seen for r in found], float) / sum(r.seen for r in found)
    mix = lambda name: sum(s * np.frombuffer(r[name]) for s, r in zip(share, found, strict=True))
    return Learner(mix("z"), mix("n"))


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, passes: int = PASSES) -> np.ndarray:
    """The weights, BUCKETS + 1 numbers, learned from `labels` (doc_id, quality 0 or 1)."""
    stored = materialise(training_rows(docs, labels, rows), "quality-features")
    state = Learner()
    for _ in range(passes):
        state = _pass(stored, state)
    return state.weights().astype(np.float32)


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text", cut: float = CUT) -> DataFrame:
    """`docs` with the struct `OUT` of score (0 to 1, higher: better) and predicted (1 where the score reaches `cut`)."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = word_hashes()
        for texts in batches:
            out = np.empty(len(texts))
            for k, text_ in enumerate(texts):
                places, values = features(text_.encode("utf-8", "surrogatepass"), hashes)
                out[k] = probability(float(weights[places] @ values))
            yield pd.Series(out)

    value = F.pandas_udf(score, "double")(text_of(text))
    found = docs.withColumn("_tl_score", value)
    result = F.struct(F.col("_tl_score").alias("score"), (F.col("_tl_score") >= cut).cast("int").alias("predicted"))
    return found.withColumn(OUT, result).drop("_tl_score")
