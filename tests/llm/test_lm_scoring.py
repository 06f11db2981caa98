"""The whole model against a plain one with dictionaries, and its parts."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import lm_scoring as m
from tickloom.llm.common import remainder, text_of


def tokens_of(text):
    return [*(text or "").encode().lower().split(), "end"]


def plain(rows):
    """Scores of rows (id, text, train, deleted): (id, train, n_tokens, n_known, train_tokens, base, score)."""

    def counted(texts):
        words, pairs = Counter(), Counter()
        for text in texts:
            tokens = tokens_of(text)
            words.update(tokens)
            pairs.update(zip(["start", *tokens], tokens))
        before = Counter(words)
        before["start"] = len(texts)
        return words, pairs, before

    def steps(p):
        return 0.0 if not p else 2 ** (round(m.STEPS * math.log2(p)) / m.STEPS)

    def bucket(n):
        return n.bit_length()

    kept = counted([t for _, t, train, deleted in rows if train and not deleted])
    every = counted([t for _, t, train, _ in rows if train])
    cells = {}
    words, pairs, before = kept
    n, v = sum(words.values()), len(words)
    for _, text, train, deleted in rows:
        if train and deleted:
            tokens = tokens_of(text)
            for prev, w in zip(["start", *tokens], tokens):
                pair = pairs[prev, w] / before[prev] if before[prev] else 0.0
                cells.setdefault(bucket(before[prev]), Counter())[steps(pair), steps(words[w] / n if n else 0.0), 1 / (v + 1)] += 1
    weights = {}
    for b in range(65):
        prior = [float(b > 0), 1.0, 1.0]
        now = [x / sum(prior) for x in prior]
        if b not in cells:
            weights[b] = weights[b - 1] if b > 1 else now
            continue
        total = sum(cells[b].values()) + sum(prior)
        for _ in range(m.ROUNDS):
            sums = list(prior)
            for given, count in cells[b].items():
                mix = sum(x * y for x, y in zip(now, given))
                for i in range(3):
                    sums[i] += count * now[i] * given[i] / mix
            after = [x / total for x in sums]
            near = max(abs(x - y) for x, y in zip(after, now)) < 1e-9
            now = after
            if near:
                break
        weights[b] = now
    words, pairs, before = every
    n, v = sum(words.values()), len(words)
    out = []
    for key, text, train, _ in rows:
        tokens = tokens_of(text)
        score = 0.0
        for prev, w in zip(["start", *tokens], tokens):
            x, y, z = weights[bucket(before[prev])] if n else (0, 0, 1)
            score += math.log10(x * (pairs[prev, w] / before[prev] if before[prev] else 0) + y * (words[w] / n if n else 0) + z / (v + 1))
        base = math.fsum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((key, train, len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return out


def same(table, train, **sizes):
    fold = F.pmod(F.xxhash64(text_of()), F.lit(m.FOLDS)) == 0
    rows = [tuple(r) for r in table.select("doc_id", "text", F.coalesce(train, F.lit(False)), fold).collect()]
    found = m.scored(table, train, **sizes).select("doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    exact = lambda r: (repr(r[0]), *r[1:5])
    got, want = (sorted(rs, key=lambda r: (exact(r), round(r[5], 6), round(r[6], 6))) for rs in (map(tuple, found), plain(rows)))
    assert [exact(r) for r in got] == [exact(r) for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_given_table(docs):
    same(docs, remainder(F.col("doc_id"), 7) != 2)


def test_small_chunks_and_ranges(docs):
    same(docs.repartition(3), remainder(F.col("doc_id"), 7) != 2, size=3000, range_=10_000)


def test_odd_rows(odd_docs):
    same(odd_docs, F.col("doc_id") % 3 != 0)  # null ids are no training


def test_nothing_to_learn_from(odd_docs):
    found = m.scored(odd_docs, F.lit(False)).collect()
    assert len(found) == odd_docs.count() and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in found)


def test_empty_table(no_docs):
    assert m.scored(no_docs, F.lit(True)).count() == 0


def test_contexts_add_up(spark):
    """The probabilities behind any context, unknown words together, add up to 1."""
    texts = ["a b a c", "b b c", "a", "c a b b a", "d e a b", "a b c d", "e d", "b a"]
    weights = m.learned_weights([(0, m.NEVER, -8, 5), (1, -4, -8, 7), (2, 0, -12, 9), (2, m.NEVER, m.NEVER, 1)], 1 / 7)
    assert np.allclose(weights.sum(1), 1) and weights[0, 0] == 0 and (weights[1:] > 0).all()
    words = Counter(t for x in texts for t in tokens_of(x))
    pairs = Counter(p for x in texts for p in zip(["start", *tokens_of(x)], tokens_of(x)))
    n, v = sum(words.values()), len(words)
    for prev in [*words, "start", "unseen"]:
        if prev == "end":
            continue
        before = len(texts) if prev == "start" else words[prev]
        a, b, c = weights[before.bit_length()]
        total = sum(a * (pairs[prev, w] / before if before else 0) + b * words[w] / n + c / (v + 1) for w in words) + c / (v + 1)
        assert total == pytest.approx(1)


def test_weights_follow_the_estimate_that_fits():
    sure = m.learned_weights([(3, 0, -20, 1000)], 1e-6)[3]
    unsure = m.learned_weights([(3, m.NEVER, -8, 1000)], 1e-6)[3]
    assert sure[0] > 0.99 and unsure[1] > 0.99


def test_packing():
    for values in (np.arange(5, dtype=np.uint64) << np.uint64(50), np.array([], np.uint32), np.array([7], np.uint32)):
        assert (m.unpacked(m.packed(values), values.dtype.type) == values).all()


def test_held_out_texts_are_predicted(run_query):
    rows = [r for r in run_query("op11_lm_scoring") if r.held_out]
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)
