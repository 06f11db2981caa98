import random
import unicodedata
import zlib
from collections import Counter

import numpy as np

from tickloom.llm import langid as L


NONE = 2**21 - 1


def code(gram):
    padded = [NONE] * (3 - len(gram)) + [ord(c) for c in gram]
    return padded[0] * 2**42 + padded[1] * 2**21 + padded[2]


def plain_words(text):
    """Letters and the combining marks behind them, in lower case."""
    words, inside = [], False
    for c in text:
        if c.isalpha():
            words += [] if inside else [""]
            words[-1] += c.lower()[0]
            inside = True
        elif inside and unicodedata.category(c) in ("Mn", "Mc"):
            words[-1] += c
        else:
            inside = False
    return words


def plain_counts(text):
    c = Counter()
    for w in plain_words(text):
        p = f"\0{w}\0"
        for n in (1, 2, 3):
            for k in range(len(p) - n + 1):
                g = p[k : k + n]
                if g.strip("\0"):
                    c[g] += 1
    return c


def plain_top(c, top):
    return sorted(c, key=lambda g: (-c[g], code(g)))[:top]


def plain_ranked(text, top):
    return [code(g) for g in plain_top(plain_counts(text), top)]


def test_ranking_against_a_plain_one():
    dice = random.Random(4)
    for n in (0, 1, 2, 5, 40, 600):
        # a blank that ends a word also begins the next: pairs of blank and letter count once for each word
        for signs in ("abcdeÀéß 1.\n-", "aШ \U00020061\U00010400\U00010428日", "a हिन्दी\u0301 1e\u0302\u0308\u200d"):
            text = "".join(dice.choice(signs) for _ in range(n))
            for top in (5, 50, 400):
                assert L.ranked(L.letter_codes(text), top).tolist() == plain_ranked(text, top), text


def test_no_letters():
    for text in ("", " ", "123 !?", "́"):
        assert len(L.ranked(L.letter_codes(text))) == 0
    assert len(L.ranked(L.letter_codes("日本"))) > 0


def test_letters_beyond_16_bits_and_marks():
    for one, other in (("\U00020061", "a"), ("\U00010400", "Ш")):
        assert not set(L.ranked(L.letter_codes(one)).tolist()) & set(L.ranked(L.letter_codes(other)).tolist())
    assert L.letter_codes("\U00010400").tolist() == [0, 0x10428, 0]  # in lower case
    assert L.letter_codes("हिन्दी").tolist() == [0, *map(ord, "हिन्दी"), 0]  # one word
    assert L.letter_codes("1\u0301 \u0301a\u0301").tolist() == [0, ord("a"), 0x301, 0]  # marks behind a letter only
    assert max(L.ranked(L.letter_codes("\U0010ffff\U0003134a" * 3)).tolist()) < 2**63


def test_distance():
    known = {"a": np.array([5, 7, 9]), "b": np.array([9, 8])}
    assert L.distances(np.array([9, 5, 1]), known, 10) == {"a": 2 + 1 + 10, "b": 0 + 10 + 10}


def test_query(run_query, docs):
    rows = {r.doc_id: r for r in run_query("op7_language_id")}
    truth = {r.doc_id: r for r in docs.select("doc_id", "lang", "text").collect()}
    assert set(rows) == set(truth)
    right = total = 0
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out and truth[k].lang and len(truth[k].text) > 40:
            total += 1
            right += r.lang_pred == truth[k].lang
    assert total > 20 and right / total > 0.95


def test_query_against_a_plain_learner(run_query, docs):
    rows = docs.select("doc_id", "lang", "text").collect()
    learned = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned.setdefault(r.lang, Counter()).update(plain_counts(r.text or ""))
    known = {lang: {g: k for k, g in enumerate(plain_top(c, L.TOP))} for lang, c in learned.items() if c}
    got = {r.doc_id: r for r in run_query("op7_language_id")}
    for r in rows:
        own = plain_top(plain_counts(r.text or ""), L.TOP)
        if not own:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        far, lang = min((sum(abs(p[g] - k) if g in p else L.TOP for k, g in enumerate(own)), lang) for lang, p in known.items())
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - (1 - far / (L.TOP * len(own)))) < 1e-12


def test_counts_are_those_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "CHARS", 50)
    texts = [("x", f"aber das {k % 7} ist gut") for k in range(60)] + [("y", "le un"), ("x", ""), ("y", None), (None, "zz")]
    got = L.profiles(spark.createDataFrame(texts, "lang string, text string").repartition(3), 1000)
    want = L.ranked(L.letter_codes(" ".join(t or "" for lang, t in texts if lang == "x")), 1000)
    assert got["x"].tolist() == want.tolist() and set(got) == {"x", "y"}


def test_odd_rows(odd_docs, no_docs):
    known = L.profiles(odd_docs)
    got = L.predicted(odd_docs, known)
    assert got.columns == [*odd_docs.columns, L.OUT]
    for r in got.collect():
        has = any(c.isalpha() for c in r.text or "")
        assert (r[L.OUT].lang_pred == "und") == (not has)
    assert L.profiles(no_docs) == {} and L.predicted(no_docs, known).collect() == []
    assert {r[L.OUT].lang_pred for r in L.predicted(odd_docs, {}).collect()} == {"und"}
