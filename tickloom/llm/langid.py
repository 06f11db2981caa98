"""Language identification with rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters, words padded with a blank) of a text in order. Profiles
of languages are counted over all training documents: tasks count what they read per language, Spark adds the counts up and
keeps the `TOP` n-grams of each. A document's own `TOP` n-grams are compared to each language by the out-of-place distance,
the sum over the document's n-grams of the difference in rank, or `TOP` where the language lacks the n-gram.

Letters count, in lower case, and the combining marks that follow one, so that a word of a script that writes vowels as marks
stays whole; everything else parts words. A character has 21 bits, so three of any script fit into one 63-bit code. Ties in
frequency go to the smaller code. Texts are not normalised: a letter with a mark and its composed form are different n-grams.

Edge cases: a null text, or one without letters (marks alone are none), is `und` with score 0; when nothing is there to learn from, every text is
`und`; rows whose language is null are not learned from but predicted; repeated rows count as often as they stand there;
other columns are kept by `predicted`, also one that bears the name of a result, since results stand in one struct (`OUT`).
"""
from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import text_of

OUT = "_tl_lang"
TOP = 400
UNKNOWN = "und"
BITS = 21
# Stands where a shorter n-gram has no character; no code point is so high.
NONE = (1 << BITS) - 1
# Set in the table of characters where one counts only behind a letter.
MARK = np.uint32(1 << 31)
# A task hands its counts on after so many characters, so that what it holds stays small.
CHARS = 2 << 20


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point: its lower-case letter, a combining mark with `MARK`, 0 where it is neither."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if c.isalpha():
            table[code] = ord(c.lower()[0])
        elif unicodedata.category(c) in ("Mn", "Mc"):
            table[code] = code | MARK
    return table


def _joined(codes: np.ndarray) -> np.ndarray:
    """Marks behind a letter, other marks between, as characters; those behind anything else as 0."""
    marks = codes >= MARK
    if not marks.any():
        return codes
    base = np.maximum.accumulate(np.where(marks, -1, np.arange(len(codes))))
    held = (base >= 0) & (codes[base] != 0)
    return np.where(marks, np.where(held, codes & ~MARK, 0), codes)


def letter_codes(text: str) -> np.ndarray:
    """Letters and their marks with single blanks (0) between words and at both ends; one blank where there is no letter."""
    codes = _joined(letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)])
    codes = np.concatenate([[np.uint32(0)], codes, [np.uint32(0)]])
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])].astype(np.int64)


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of `letter_codes` in ascending order, and how often each occurs."""
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = codes[:-1] << BITS | codes[1:]
    triples = pairs[:-1] << BITS | codes[2:]
    # a blank stands at the ends of an n-gram only, and never alone
    triples = triples[codes[1:-1] != 0]
    singles = codes[codes != 0] | NONE << BITS | NONE << 2 * BITS
    every = np.concatenate([triples, pairs | NONE << 2 * BITS, singles])
    every.sort()
    new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[new], np.diff(np.append(new, len(every)))


def ranked(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams in order."""
    found, counts = grams(codes)
    if len(found) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.argsort(-counts, kind="stable")][:top]


def counted(docs: DataFrame) -> DataFrame:
    """n-gram counts of the rows (lang, text), added up by stretches: lang, gram, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                found, counts = grams(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts)], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = letter_codes(text)
                if len(codes) > 2:
                    # stretches join at a blank, which both have
                    parts = held.setdefault(lang, [])
                    parts.append(codes[1:] if parts else codes)
                    size += len(codes)
                if size >= CHARS:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.select(F.col("lang").cast("string"), text_of().alias("text")).mapInArrow(count, "lang string, gram bigint, n bigint")


def profiles(docs: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """The n-grams of each language in order of frequency, learned from all rows whose lang is not null.

    What reaches the driver is `top` n-grams for each value of lang.
    """
    totals = counted(docs.filter(F.col("lang").isNotNull())).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = materialise(totals, "lang-grams")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)
    found: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "place").collect():
        found.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(g, np.int64) for lang, g in found.items()}


def distances(own: np.ndarray, known: dict[str, np.ndarray], top: int = TOP) -> dict[str, int]:
    """Out-of-place distance of a document's ranked n-grams to each profile."""
    return {lang: _distance(own, *_lookup(profile), top) for lang, profile in known.items()}


def _lookup(profile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(profile, kind="stable")
    return profile[order], order


def _distance(own: np.ndarray, grams_: np.ndarray, ranks: np.ndarray, top: int) -> int:
    at = np.minimum(np.searchsorted(grams_, own), len(grams_) - 1)
    known = grams_[at] == own
    return int(np.where(known, np.abs(ranks[at] - np.arange(len(own))), top).sum())


def prediction(known: dict[str, np.ndarray], text: Column, top: int = TOP) -> Column:
    """Struct of lang_pred and score: 1 less the distance as a share of the largest possible."""
    tables = [(lang, *_lookup(profile)) for lang, profile in sorted(known.items()) if len(profile)]

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text_ in texts:
                own = ranked(letter_codes(text_), top)
                if not len(own) or not tables:
                    rows.append((UNKNOWN, 0.0))
                    continue
                far, lang = min((_distance(own, g, r, top), lang) for lang, g, r in tables)
                rows.append((lang, 1.0 - far / (top * len(own))))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")(text)


def predicted(docs: DataFrame, known: dict[str, np.ndarray], text: str = "text", top: int = TOP) -> DataFrame:
    """`docs` with the struct `OUT` of lang_pred and score."""
    return docs.withColumn(OUT, prediction(known, text_of(text), top))
