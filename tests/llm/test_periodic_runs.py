"""Runs against all lags one by one, on texts made to repeat and on the odd table."""
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import periodic_runs as p
from tickloom.llm.queries import damaged_words


def plain(words, least=p.LEAST):
    """Every maximal stretch of matches of every lag, smaller lags first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def numbers(words):
    return np.array(words, np.int64)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=20), st.integers(1, 6), st.integers(1, 70)), max_size=4), st.sampled_from([4, 6, 8, 10, 12]))
def test_against_all_lags(parts, least):
    words = [w for unit, times, length in parts for w in (unit * times)[:length]]
    assert sorted(p.runs_of(numbers(words), least)) == plain(words, least)


def test_random_binary():
    r = random.Random(3)
    for n in (11, 12, 13, 200, 700):
        words = [r.randrange(2) for _ in range(n)]
        assert p.runs_of(numbers(words)) == plain(words)


def test_few_pairs_whatever_repeats():
    """One word, one word between seven equal ones, and Fibonacci words: as many pairs as words, in each octave."""
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    for words in ([0] * 3000, ([0] * 7 + [1]) * 375, b[:3000]):
        names, size = p._gram_names(numbers(words), 6), 6
        low = 12
        while 2 * low < 3000:
            names, size = p._doubled(names, size), 2 * size
            at = np.argsort(names, kind="stable")
            assert sum(len(x) for x, _ in p._chain_pairs(at, names, low, 2 * low - 1)) <= 6 * 3000
            low *= 2


def test_long_text_is_fast():
    words = numbers(([0] * 7 + [1]) * 20_000)
    assert p.runs_of(words) == [(0, 160_000, 8)]


def test_collapsed():
    words = b"x y a b a b a b a b a b a b z".split()
    runs = p.runs_of(numbers([hash(w) % 997 for w in words]))
    assert runs == [(2, 12, 2)] and p.collapsed(words, runs) == b"x y a b z"


def test_odd_rows(odd_docs):
    rows = p.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count() and set(rows[0].__fields__) == {*odd_docs.columns, p.OUT}
    for row in rows:
        words = (row.text or "").encode().split()
        want = plain(words) if len(words) < 2000 else None
        found = [tuple(r) for r in row[p.OUT].runs]
        assert row[p.OUT].n_words == len(words)
        if want is not None:
            assert found == want
            keep = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in want)]
            assert row[p.OUT].collapsed == b" ".join(keep).decode()


def test_empty_table(no_docs):
    assert p.judged(no_docs).count() == 0


def test_bad_length(odd_docs):
    with pytest.raises(ValueError):
        p.judged(odd_docs, least=7)


def test_longest(spark):
    one = "array(named_struct('start', {}, 'length', {}, 'period', {}), named_struct('start', 9, 'length', 12, 'period', 3))"
    rows = spark.sql(f"select 1 i, {one.format(4, 12, 6)} r union all select 2, {one.format(9, 12, 2)} union all select 3, filter({one.format(1, 1, 1)}, x -> x.start > 50)")
    best = {row.i: row.b for row in rows.select("i", p.longest(F.col("r")).alias("b")).collect()}
    assert (best[1].start, best[1].period) == (4, 6) and (best[2].start, best[2].period) == (9, 2) and best[3] is None


def test_damage(docs, odd_docs):
    for table in (docs, odd_docs):
        texts = {}
        for row in damaged_words(table).collect():
            texts.setdefault(row.doc_id, []).append(row.text)
        for row in table.collect():
            h = zlib.crc32(("" if row.doc_id is None else str(row.doc_id)).encode())
            words = (row.text or "").encode().split()
            if h % 10 == 0 and words:
                g, n = h // 10, len(words)
                a = g % n
                q = 1 + (n - a) // (3 + g % 8)
                assert b" ".join(words[i] if i < a else words[a + (i - a) % q] for i in range(n)).decode() in texts[row.doc_id]
            else:
                assert (row.text or "") in texts[row.doc_id]
