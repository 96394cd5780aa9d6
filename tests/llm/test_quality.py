import math

import numpy as np

from scoreloom.llm import quality as Q


def test_probabilities_and_order():
    rng = np.random.default_rng(0)
    good, poor, bad = "calm plain prose {}", "LOUD NOISE!! {}", "vile insult {}"
    texts = [(t.format(rng.integers(1000)), g) for t, g in ((good, 2), (poor, 1), (bad, 0)) for _ in range(60)]
    rows = [Q.features(t.encode()) for t, _ in texts]
    model = Q.fit(rows, np.array([g for _, g in texts]))
    assert model.thresholds[0] < model.thresholds[1]
    p = model.probabilities(np.array([model.weights[r].sum() for r in rows]))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert (p.argmax(axis=1) == [g for _, g in texts]).mean() > 0.95


def test_slopes_against_differences():
    """The derivatives of the loss by scores and thresholds are its finite differences."""
    rng = np.random.default_rng(1)
    score, grades, cut = rng.normal(size=40), rng.integers(0, 4, 40), np.array([-0.7, 0.1, 1.3])

    def loss(score, cut):
        p = Q.Ordinal(np.zeros(1), cut).probabilities(score)
        return -np.log(p[np.arange(40), grades]).mean()

    by_score, by_cut = Q.slopes(score, cut, grades)
    step = 1e-5
    for found, at, f in ((by_score, score, lambda x: loss(x, cut)), (by_cut, cut, lambda x: loss(score, x))):
        for i in range(len(at)):
            move = np.zeros(len(at))
            move[i] = step
            assert abs((f(at + move) - f(at - move)) / (2 * step) - found[i]) < 1e-7


def test_fit_lowers_the_loss():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(80)]
    grades = rng.integers(0, 3, 80)

    def loss(model):
        p = model.probabilities(np.array([model.weights[r].sum() for r in rows]))
        return -np.log(p[np.arange(80), grades]).mean()

    assert loss(Q.fit(rows, grades, bits=6, rounds=60, l1=0)) < loss(Q.fit(rows, grades, bits=6, rounds=1, l1=0))


def test_sample(spark):
    """Labels without a document take no place, and a document has one row whatever its texts."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(3, "other text"), (3, "text 3"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(i, 0, 0) for i in range(1000, 1400)], "doc_id long, quality int, toxic int")
    rows = Q.sampled(docs, labels, 20).collect()
    assert sorted(r.doc_id for r in rows) == list(range(20)) and {r.grade for r in rows} == {2}
    assert {r.doc_id: r.idx for r in rows} == {r.doc_id: r.idx for r in Q.sampled(docs.repartition(3), labels, 20).collect()}
    assert Q.sampled(docs, labels, 5).count() == 5


def test_scores_against_brute_force(spark, small_docs):
    """The query's probabilities from its own weights and thresholds, text by text."""
    model = Q.train(small_docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    got = {r.doc_id: r for r in Q.score(small_docs, model).collect()}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for r in small_docs.collect():
        z = sum(float(model.weights[i]) for i in Q.features((r.text or "").encode()).tolist())
        low, high = (sigmoid(float(c) - z) for c in model.thresholds)
        assert abs(got[r.doc_id].p_top - (1 - high)) < 1e-9 and abs(got[r.doc_id].expected_grade - (high - low + 2 * (1 - high))) < 1e-9
        assert got[r.doc_id].keep == (got[r.doc_id].p_top >= Q.TAIL)


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels.where("doc_id % 4 <> 0"))
    held = Q.score(docs, model).join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    clean = held[(held.quality == 1) & (held.toxic == 0)]
    assert clean.keep.mean() > 0.9 and len(held) > 50


def test_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    model = Q.train(odd_docs, labels)
    assert len(Q.score(odd_docs, model).collect()) == 8 and Q.score(no_docs, model).collect() == []
    assert Q.select(odd_docs, model).columns == odd_docs.columns
    nothing = Q.train(no_docs, labels.limit(0))
    assert all(r.keep for r in Q.score(odd_docs, nothing).collect())
