import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickloom.llm import mixing
from tickloom.session import materialise


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cap, and share the excess again until nothing is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: float(most * sizes[s]) for s in over})


def test_query(run_query, docs):
    rows = run_query("op2_source_mix")
    texts = {r.doc_id: (r.text or "", r.source) for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, (t, _) in texts.items()}
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0
    goal = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
    for s in goal:
        assert abs(taken[s] - goal[s]) <= largest[s]


def test_runs_agree(spark, docs):
    take = lambda: sorted((r.doc_id, r.copies) for r in mixing.decisions(mixing.numbered(docs)).collect())
    assert take() == take()


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5, "d": 70, None: 3}, {"x": 10}, {"a": 0, "b": 0}, {"a": 0, "b": 7}, {"a": 5, "b": 5, "c": 5000}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), f"source string, {mixing.SIZE} bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_flight_keeps_the_totals():
    import random

    dice = random.Random(5)
    for n in (0, 1, 2, 3, 50, 2000):
        sizes = [dice.choice([0, 1, 5, 5, 900, dice.randint(1, 20_000)]) for _ in range(n)]
        p = [dice.random() for _ in range(n)]
        q = mixing.flight(p, sizes, 1)
        assert sum(x not in (0.0, 1.0) for x in q) <= 2
        assert sum(q) == pytest.approx(sum(p), abs=1e-3)
        assert sum(a * b for a, b in zip(q, sizes)) == pytest.approx(sum(a * b for a, b in zip(p, sizes)), rel=1e-4, abs=1)
        assert all(x in (0.0, 1.0) for x in mixing.landing(q, sizes))


def test_several_flights(spark, monkeypatch, tmp_path):
    """Small blocks, one hot source and one id that a third of its rows share."""
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rows = [(None if k % 3 == 0 else k, "w " * (1 + k * 7 % 40), "hot" if k % 3 else f"s{k % 4}") for k in range(3000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "d"))
    got = mixing.decisions(mixing.numbered(spark.read.parquet(str(tmp_path / "d"))))
    for r in got.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("target")).collect():
        assert r.n == sum(x[2] == r.source for x in rows) and abs(r.t - r.target) <= 40


def test_odd_rows(odd_docs, no_docs):
    rows = mixing.decisions(mixing.numbered(odd_docs)).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.copies <= 3 for r in rows)
    mix = mixing.mixed(odd_docs)
    assert mix.columns == odd_docs.columns
    want = sum(r.copies for r in rows)
    assert mix.count() == want
    assert mixing.decisions(mixing.numbered(no_docs)).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_mix_does_not_follow_the_cores(spark, tmp_path, monkeypatch):
    """Files are split otherwise when the mix is read than when it was decided; columns bear names the operator uses."""
    rows = [(k, f"w{k} " * (1 + k % 40), "a" if k % 3 else "b", k, k, k) for k in range(300)]
    names = "doc_id bigint, text string, source string, copies bigint, _tl_row bigint, _tl_copies bigint"
    spark.createDataFrame(rows, names).repartition(12).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    decided = {}

    def note(df, name):
        stored = materialise(df, name)
        if name == "mix-copies":
            decided.update({r[mixing.ROW]: r._tl_copies for r in stored.collect()})
            spark.conf.set("spark.sql.files.minPartitionNum", "16")
        elif name == "mix-rows":
            spark.conf.set("spark.sql.files.minPartitionNum", "2")
            decided["rows"] = stored
        return stored

    monkeypatch.setattr(mixing, "materialise", note)
    try:
        mix = mixing.mixed(docs)
        assert mix.columns == docs.columns
        got = Counter(r.doc_id for r in mix.collect())
        want = {r._tl_doc.doc_id: decided.get(r[mixing.ROW], 0) for r in decided["rows"].collect()}
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert got == Counter({k: n for k, n in want.items() if n}) and len(got) > 100
    assert all(r.copies == r._tl_row == r._tl_copies == r.doc_id for r in mix.collect())
