import zlib

import numpy as np

from tickloom.llm import quality_model as Q


def test_features():
    hashes = Q.WordHashes()
    places, values = Q.features(b"the cat the cat the", hashes)
    assert (np.diff(places) > 0).all() and places[-1] == Q.BUCKETS and values[-1] == 1
    assert abs(float((values[:-1] ** 2).sum()) - 1) < 1e-5
    assert Q.features(b"", hashes)[0].tolist() == [Q.BUCKETS] and Q.features(b" \n", hashes)[1].tolist() == [1.0]
    # a feature that occurs more often has the larger value, and the order of words matters
    assert Q.features(b"a b", hashes)[0].tolist() != Q.features(b"b a", hashes)[0].tolist()


def test_shape():
    words = ("The", "THE!!", "the$$$", "1,55%", "|", "élan", "a1b", "日本")
    assert [Q.shape(w.encode()).decode() for w in words] == ["Aa", "A!", "a$", "0,0%", "|", "a", "a0a", ""]


def test_updates_against_a_plain_version():
    dice = np.random.default_rng(2)
    learner = Q.Learner()
    z, n = {}, {}
    for _ in range(200):
        places = np.sort(dice.choice(50, 6, replace=False))
        values = dice.random(6)
        label = int(dice.random() < 0.5)
        w = {}
        for i in places.tolist():
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= Q.L1 else -(zi - np.sign(zi) * Q.L1) / ((Q.BETA + ni**0.5) / Q.ALPHA + Q.L2)
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(places.tolist(), values))))
        for i, v in zip(places.tolist(), values):
            g = (p - label) * v
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            z[i], n[i] = zi + g - ((ni + g * g) ** 0.5 - ni**0.5) / Q.ALPHA * w[i], ni + g * g
        learner.learn(places, values, label)
    assert np.allclose([learner.z[i] for i in z], list(z.values())) and np.allclose([learner.n[i] for i in n], list(n.values()))


def test_query(run_query, docs, spark, sf_dir):
    rows = {r.doc_id: r for r in run_query("op3_quality_model")}
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(rows) == ids
    for k, r in rows.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy(spark, sf_dir):
    import os

    from tickloom.llm.queries import QUERIES

    big = sf_dir.replace("sf0.001", "sf0.01")
    if not os.path.isdir(big):
        return
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_quality_model"](spark, big).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    ranked = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ranked > 0.95
    assert sum(r.predicted for r in rows if labels[r.doc_id] == 1) / len(good) > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (13, 0), (13, 1), (None, 1), (2, None), (99, 0), (4, 0), (8, 1)], "doc_id bigint, quality int")
    weights = Q.trained(odd_docs, labels)
    got = Q.scored(odd_docs, weights)
    assert got.columns == [*odd_docs.columns, Q.OUT]
    scores = {}
    for r in got.collect():
        assert 0 <= r[Q.OUT].score <= 1
        scores.setdefault(r.text or "", set()).add(r[Q.OUT].score)
    assert all(len(s) == 1 for s in scores.values())
    assert Q.scored(no_docs, weights).collect() == []
    none = Q.trained(no_docs, labels)
    assert {r[Q.OUT].score for r in Q.scored(odd_docs, none).collect()} == {0.5}
