import re
from collections import Counter

import pytest
from test_near_dedup import brute
from test_packing import check_places, whole_ids

import corpus_pipeline
from tickloom.llm import mixing, secret_scan
from tickloom.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows that each stage gets, and those that the last one returns."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, seen[-1], sf_dir).write.parquet(path)
        seen.append(spark.read.parquet(path))
    return seen


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_failed(text):
    w = words(text)
    grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    covered = {k + j for k, g in enumerate(grams) if g in twice for j in range(5)}
    return len(w) < 10 or 100 * len(covered) > 20 * len(w)


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(stages, spark, sf_dir):
    kept = {r.doc_id for r in stages[1].collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = stages[0].collect()
    assert not any(base_failed(r.text) for r in rows if r.doc_id in kept)
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not base_failed(r.text)]
    assert all(r.doc_id in kept for r in good)


def test_dedup(stages):
    want = {i for i, _, c in brute([(r.doc_id, r.text) for r in stages[1].collect()]) if i == c}
    got = [r.doc_id for r in stages[2].collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_secrets(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    after = {r.doc_id: r.text for r in stages[3].collect()}
    assert after == {k: secret_scan.mask_spans(t, secret_scan.scan(t)[1]) for k, t in before.items()}


def test_mix(stages):
    before, after = stages[3].collect(), Counter(stages[4].collect())
    assert set(after) <= set(before) and max(after.values()) <= 3
    sizes, taken, goal = Counter(), Counter(), {}
    for r in before:
        sizes[r.source] += len(words(r.text))
        taken[r.source] += len(words(r.text)) * after[r]
    for r in mixing.decisions(mixing.numbered(stages[3])).collect():
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) <= max(len(words(r.text)) for r in before if r.source == s) for s in sizes)


def test_pack(stages):
    docs, rows = stages[4].collect(), stages[5].collect()
    assert all(len(r.ids) == r.tokens <= 2048 and r.doc_ids == [p.doc_id for p in r.pieces] for r in rows)
    texts = {r.doc_id: r.text for r in docs}
    heads = Counter(p.doc_id for r in rows for p in r.pieces if p.piece == 0)
    assert heads == Counter(r.doc_id for r in docs)
    for r in rows:
        for p in r.pieces:
            part = r.ids[p.offset : p.offset + p.length]
            assert part == whole_ids(texts[p.doc_id])[2048 * p.piece : 2048 * (p.piece + 1)]
    total = sum(r.tokens for r in rows)
    assert len(rows) <= -(-total // 2048) * 1.01 + 1


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, f"odd-{name}")
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
            assert name == "best_fit_packing" or docs.columns == columns


def test_texts_go_to_python_in_small_batches(spark, tmp_path):
    import pyarrow as pa
    from pyspark.sql import functions as F

    import corpus_pipeline
    from tickloom.llm import common

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('x', 4000)").alias("text"))
    for _, stage in corpus_pipeline.STAGES[1:3]:
        stage(spark, docs.limit(1), "")
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == common.BATCH

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    rows = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in rows) == 4000 and max(r.size for r in rows) < 8_000_000
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
