import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from tickloom.llm import packing


def whole_ids(text):
    tok = whole_ids.tok = getattr(whole_ids, "tok", None) or Tokenizer.from_file(packing.vocabulary())
    return [*tok.encode(text or "", add_special_tokens=False).ids, 0]


def test_query_against_the_tokenizer(run_query, docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = run_query("op1_best_fit_packing")
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for key, parts in by_doc.items():
        ids = whole_ids(texts[key])
        total += len(ids)
        parts.sort(key=lambda r: r.piece)
        want = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        assert [(p.piece, p.start, p.length) for p in parts] == [(k, 2048 * k, len(w)) for k, w in enumerate(want)]
        assert [p.ids_crc32 for p in parts] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    filled = check_places(rows)
    assert len(filled) <= -(-total // 2048) * 1.01 + 1


def check_places(rows):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return by_sequence


def test_plan_places_every_rank_once():
    dice = random.Random(3)
    for size in (1, 7, 64, 2048):
        counts = {dice.randint(1, size): dice.randint(1, 5000) for _ in range(60)}
        plan, n = packing.best_fit(counts, size)
        rooms = defaultdict(list)
        for length, count in counts.items():
            ranks = sorted((r, m) for le, r, m, _, _ in plan.tolist() if le == length)
            assert ranks[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(ranks, ranks[1:])) and sum(m for _, m in ranks) == count
        for length, _, many, first, offset in plan.tolist():
            for s in range(first, first + many):
                rooms[s].append((offset, length))
        assert set(rooms) == set(range(n))
        for places in rooms.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= size


def test_plan_is_best_fit():
    # 6+4, 6+3, 5+5 with room for ten: the fours and threes go where the least room is left
    plan, n = packing.best_fit({6: 2, 5: 2, 4: 1, 3: 1}, 10)
    assert n == 3
    assert packing.best_fit({10: 3, 1: 20}, 10)[1] == 5


def test_odd_rows(spark, odd_docs, no_docs):
    placed = packing.packed(packing.tokenized(odd_docs))
    rows = placed.collect()
    check_places(rows)
    assert sum(1 for r in rows if r.doc_id == 2) == 2 and sum(1 for r in rows if r.length == 1) == 4
    joined = packing.sequences(placed).collect()
    ids = {r.sequence_id: r.ids for r in joined}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.sequence_id][r.offset : r.offset + r.length]
    long = sorted((r.piece, np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.doc_id == 8)
    text = odd_docs.filter("doc_id = 8").first().text
    assert [i for _, part in long for i in part] == whole_ids(text)
    assert packing.packed(packing.tokenized(no_docs)).collect() == []
    assert packing.sequences(packing.packed(packing.tokenized(no_docs))).collect() == []


def test_words_give_the_ids_of_the_whole_text(odd_docs):
    words = packing.WordIds(packing.vocabulary())
    texts = [r.text for r in odd_docs.select("text").collect() if r.text]
    texts += ["don't DON'T 12a3 ΑΣ ΑΣ. ̈́a e ́x \x85\x1d\xa0b <|startoftext|>", "I'll we've…'s 's   ok\r\n\r\nso"]
    texts += ["Onanst onanst. ONANST!! onanst.,; Élan élan. ÉLAN, straße. Straße? ǅ. a1. 1. 1 .,. x'st. it's, IT'S. a$. <|ENDOFTEXT|>. <|endoftext|>a. e\u0301. \u0130. İI. ΑΣ. İ, K. K, ﬁ. ª. µ. ×. é×. <\u0338 ,\u0338 a.\u0338"]
    texts += ["J\u030c A.\u0338 b", "J\u01f0 \u212aelvin. caf\u00c9, CAF\u00c9. x.\ty,\nz;\x0bq! r? 9. $. !. ... ."]
    for t, ids in zip(texts, words.of([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == whole_ids(t)[:-1]


def test_narrow_ids(spark, odd_docs):
    """Ids of 16 bits give the same sequences; a piece with a larger id keeps 32."""
    pieces = packing.tokenized(odd_docs)
    narrow = packing.packed(pieces, narrow=True)
    assert all(len(r.ids) == 2 * r.length for r in narrow.collect())
    texts = Counter(tuple(r.ids) for r in packing.sequences(narrow).collect())
    assert texts == Counter(tuple(r.ids) for r in packing.sequences(packing.packed(pieces)).collect())
    large = np.array([70_000, 1, 0], "<u4").tobytes()
    made = spark.createDataFrame([(1, 0, 0, 3, large), (2, 0, 0, 1, b"\0\0\0\0")], packing.PIECES)
    rows = packing.sequences(packing.packed(made, narrow=True)).collect()
    assert len(rows) == 1 and rows[0].ids == [70_000, 1, 0, 0]


def test_places_counted_while_cutting(odd_docs):
    """Pieces that come with their places give the same sequences as those that are counted later."""
    whole = Counter(tuple(r.ids) for r in packing.sequences(packing.packed(packing.tokenized(odd_docs))).collect())
    for narrow in (False, True):
        placed = packing.packed(packing.tokenized(odd_docs, ranked=True, narrow=narrow), narrow=narrow)
        assert placed.columns == [*(c.split()[0] for c in packing.PIECES.split(", ")), "sequence_id", "offset"]
        check_places(placed.collect())
        got = Counter(tuple(r.ids) for r in packing.sequences(placed).collect())
        assert sum(map(len, got.elements())) == sum(map(len, whole.elements())) and len(list(got.elements())) == len(list(whole.elements()))


def test_ranks_in_many_tasks(spark):
    rows = [(k, 0, 0, 1 + k * k % 7, None) for k in range(3000)]
    made = spark.createDataFrame(rows, packing.PIECES).repartition(7)
    placed = packing.packed(made, 16).collect()
    assert len({(r.sequence_id, r.offset) for r in placed}) == 3000
    assert len(check_places(placed)) <= -(-sum(r[3] for r in rows) // 16) * 1.01 + 1
