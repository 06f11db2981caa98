"""Periodic runs in the words of a text, by seeds on diagonals.

A run is a stretch of words that repeats with its smallest period q at least twice and has at least `LEAST` words, and that no
neighbouring word extends. On the diagonal of lag q, where word i is compared to word i + q, it is a stretch of max(LEAST - q, q)
or more matches. So a run of a lag from `low` to 2 * low - 1 contains equal k-grams at that lag, with k = low from `LEAST`
words on and k = LEAST / 2 for all lags below. For each such octave of lags the k-grams are indexed by exact names (a gram's
name is that of the pair of its halves' names), occurrence pairs at these lags are enumerated, and each is extended to both
sides unless the table of the lag's furthest covered word says that it lies in a stretch known already.

Pairs stay few in any text. Occurrences of a gram at most k / 2 apart form a chain of one short period. A pair within a chain
cannot start a run of an octave that begins at k; of two chains, a pair on the same diagonal has the first occurrence of one of
them. So only those pairs are enumerated, and there are about as many as words in each octave, whatever repeats.

Edge cases: null and empty texts, and those with fewer than `LEAST` words, have no run; their words are kept. Repeated rows are
judged each for itself. Other columns are kept, also one that bears the name of a result, since results stand in one struct
(`OUT`, the only reserved name). A text is held whole by the task that reads it, with some hundred bytes a word.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, utf8

OUT = "_tl_runs"
LEAST = 12
SCHEMA = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class _Names(dict):
    """Numbers in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs: equal where both parts are."""
    return np.unique(left * (np.int64(right.max()) + 1) + right, return_inverse=True)[1]


def _doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of grams twice as long."""
    return _paired(names[:-size], names[size:])


def _close_pairs(at: np.ndarray, names: np.ndarray, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of occurrences at lags up to a small `high`; `at` sorts places by name, then place."""
    found = []
    for step in range(1, high + 1):
        first, second = at[:-step], at[step:]
        near = (names[first] == names[second]) & (second - first <= high)
        if not near.any():
            break
        found.append((first[near], (second - first)[near]))
    return found


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, repeated, and its members."""
    sizes = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)


def _chain_pairs(at: np.ndarray, names: np.ndarray, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs at lags from `low` to `high` that hold the first member of one of two chains."""
    sorted_names = names[at]
    cuts = np.flatnonzero((sorted_names[1:] != sorted_names[:-1]) | (np.diff(at) > low // 2)) + 1
    first, last = np.concatenate([[0], cuts]), np.append(cuts, len(at)) - 1
    width = np.int64(len(names) + high + low + 1)
    key = sorted_names * width + at
    found = []
    step = 1
    while step < len(first):
        c, d = np.arange(len(first) - step), np.arange(step, len(first))
        near = (sorted_names[first[c]] == sorted_names[first[d]]) & (at[first[d]] - at[last[c]] <= high)
        if not near.any():
            break
        c, d = c[near], d[near]
        base, head, follower = sorted_names[first[c]] * width, at[first[c]], at[first[d]]
        # the first of the earlier chain with members of the later one
        lo = np.maximum(first[d], np.searchsorted(key, base + head + low))
        which, member = _ranges(lo, np.minimum(last[d] + 1, np.searchsorted(key, base + head + high, "right")))
        found.append((head[which], at[member] - head[which]))
        # members of the earlier chain with the first of the later one
        lo = np.maximum(first[c], np.searchsorted(key, base + np.maximum(follower - high, 0)))
        hi = np.where(follower >= low, np.searchsorted(key, base + np.maximum(follower - low, 0), "right"), 0)
        which, member = _ranges(lo, np.minimum(last[c] + 1, hi))
        found.append((at[member], follower[which] - at[member]))
        step += 1
    return found


def _seeds(names: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(place, lag) of occurrence pairs, by lag and place; of neighbours on a diagonal only the first."""
    at = np.argsort(names, kind="stable")
    found = _close_pairs(at, names, high) if low == 1 else _chain_pairs(at, names, low, high)
    if not found:
        return
    width = len(names) + 1
    every = np.unique(np.concatenate([lag * width + place for place, lag in found]))
    every = every[np.flatnonzero(np.diff(every, prepend=-2) != 1)]
    yield from zip((every % width).tolist(), (every // width).tolist(), strict=True)


def _extended(words: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The maximal stretch of matches around `place` on the diagonal."""
    start, end, size = place, place, 16
    while start:
        size = min(4 * size, start)
        differ = np.flatnonzero(words[start - size:start] != words[start - size + lag:start + lag])
        if len(differ):
            start += int(differ[-1]) + 1 - size
            break
        start -= size
    size, stop = 16, len(words) - lag
    while end < stop:
        size = min(4 * size, stop - end)
        differ = np.flatnonzero(words[end:end + size] != words[end + lag:end + size + lag])
        if len(differ):
            end += int(differ[0])
            break
        end += size
    return start, end


def runs_of(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of a sequence of word numbers as (start, length, period), sorted by start, then period.

    `least` is even, as the first grams have half as many words.
    """
    n = len(words)
    if n < least:
        return []
    half = least // 2
    names = _gram_names(words, half)
    found: dict[tuple[int, int], int] = {}
    low, high, size = 1, least - 1, half
    while True:
        covered: dict[int, int] = {}
        for place, lag in _seeds(names, low, high):
            if place < covered.get(lag, 0):
                continue
            start, end = _extended(words, place, lag)
            covered[lag] = end
            # a smaller period has the same bounds and came first
            if end - start >= max(least - lag, lag):
                found.setdefault((start, end + lag), lag)
        low, high = high + 1, 2 * high + 1
        if 2 * low > n or len(names) <= size or names.max() == len(names) - 1:
            break
        names, size = _doubled(names, size), 2 * size
    return sorted(((start, end - start, lag) for (start, end), lag in found.items()), key=lambda r: (r[0], r[2]))


def _gram_names(words: np.ndarray, size: int) -> np.ndarray:
    """Names of all grams of `size` words."""
    if size == 1:
        return words
    part = _gram_names(words, size // 2)
    grams = _doubled(part, size // 2)
    return _paired(grams[:-1], words[size - 1:]) if size % 2 else grams


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside what repeats, joined by one blank: of each run its first period stays."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _judged(texts: pa.Array, least: int) -> pa.Array:
    counts, sizes, flat, kept = [], [0], [], []
    for text in utf8(texts):
        words = text.split()
        names = _Names()
        runs = runs_of(np.fromiter(map(names.__getitem__, words), np.int64, len(words)), least)
        counts.append(len(words))
        flat += runs
        sizes.append(len(flat))
        kept.append(collapsed(words, runs).decode("utf-8", "surrogatepass"))
    columns = np.array(flat, np.int64).reshape(-1, 3)
    run = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), run)
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists, pa.array(kept, pa.string())], names=["n_words", "runs", "collapsed"])


def judged(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """`docs` with the struct `OUT`: n_words, all runs by start and period, and the text without what they repeat."""
    if least < 4 or least % 2:
        raise ValueError("the least length is an even number from four on")

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _judged(texts, least)

    return docs.withColumn(OUT, F.arrow_udf(judge, SCHEMA)(text_of(text)))


def longest(runs: Column) -> Column:
    """The run with the greatest length; of equal ones that of the smallest start, then period."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best.start).alias("start"), best.length.alias("length"), (-best.period).alias("period")))
