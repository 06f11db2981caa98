import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import embedding_dedup as E
from tickloom.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, rep string"


def brute(rows):
    """vec_id: (n_links, component_id) by comparing all pairs."""
    rows = list(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows))
    unit = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            unit[k] = x / np.linalg.norm(x)
    near = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9] for k in unit}
    root = {i: i for i, _ in rows}
    for _ in rows:
        for k, js in near.items():
            low = min([root[rows[k][0]], *(root[rows[j][0]] for j in js)])
            for j in [k, *js]:
                root[rows[j][0]] = min(low, root[rows[j][0]])
    return sorted(((i, len(near.get(k, [])), root[i]) for k, (i, _) in enumerate(rows)), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(3)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


def cloud(seed, n, groups, d=16, noise=0.25):
    dice = np.random.default_rng(seed)
    centres = dice.standard_normal((groups, d))
    return [(i, (centres[i % groups] + noise * dice.standard_normal(d)).astype(np.float32).tolist()) for i in range(n)]


def test_against_all_pairs(spark):
    rows = cloud(1, 700, 60) + [(1000 + k, v) for k, (_, v) in enumerate(cloud(1, 30, 60))]
    assert got(E.near_duplicates(table(spark, rows))) == brute(rows)


def test_hot_buckets_are_divided(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 20)
    rows = cloud(2, 300, 3, noise=0.1)
    assert got(E.near_duplicates(table(spark, rows))) == brute(rows)


def test_recall(spark, monkeypatch):
    """Many narrow buckets: nearly all links are found, and none that is none."""
    monkeypatch.setattr(E, "BUCKET", 8)
    rows = cloud(3, 1500, 150)
    found = {i: n for i, n, _ in got(E.near_duplicates(table(spark, rows)))}
    want = {i: n for i, n, _ in brute(rows)}
    assert all(found[i] <= want[i] for i in want) and sum(found.values()) >= 0.99 * sum(want.values())


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, v), (1, v), (2, v), (None, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [nan, 1.0, 1.0]),
            (8, [inf, 1.0, 1.0]), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (12, [1e-30, 2e-30, 3e-30]), (None, None), (13, [0.0, -0.0, 5.0]), (14, [-0.0, 0.0, 5.0])]
    out = got(E.near_duplicates(table(spark, rows)))
    assert (1, 3, 1) in out and (9, 3, 1) in out and (12, 3, 1) in out and (13, 1, 13) in out and (14, 1, 13) in out
    assert all((i, 0, i) in out for i in (3, 4, 5, 6, 7, 8, 10, 11)) and (None, 0, None) in out
    assert E.near_duplicates(table(spark, rows).filter(F.lit(False))).collect() == []


def test_query(run_query, spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in run_query("op8_embedding_dedup")), key=repr) == brute(rows)


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(None, 2), (3, None)], [(5, 4), (4, 3), (3, 2), (2, 1)], [(k, k + 1) for k in range(200)],
    [(0, k) for k in range(1, 300)] + [(k, 1000 - k) for k in range(301, 400)], [(7, k) for k in range(8, 60)] + [(3, 59), (3, 3)],
])
def test_components(spark, edges):
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for _ in edges:
        for a, b in edges:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in components(df).collect()} == root
