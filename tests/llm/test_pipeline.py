import corpus_pipeline as P
import pytest

from scoreloom.llm import quality
from tests.llm import test_decontaminate, test_lines, test_near, test_packing, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    docs, out = P._shared.documents(spark, SF), []
    for name, stage in P.STAGES:
        result = P._shared.stored(stage(spark, docs, SF), name)
        out.append((name, docs, result))
        docs = result
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < after.count() <= before.count(), name


def test_quality(spark, stages):
    """Documents go by the probability that their own features and the model's weights give."""
    _, before, after = stages[0]
    model = quality.train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    keep = set()
    for r in before.collect():
        score = sum(float(model.weights[i]) for i in quality.features((r.text or "").encode()).tolist())
        if model.probabilities(quality_array(score))[0, -1] >= quality.TAIL:
            keep.add(r.doc_id)
    assert ids(after) == keep and 0 < len(keep) < before.count()


def quality_array(score):
    import numpy as np

    return np.array([score])


def test_lines_against_all_pairs(stages):
    _, before, after = stages[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    gone = test_lines.expected(rows)
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    emptied = {d for d, t in want.items() if any(x == d for x, _ in gone) and not any(c.isalnum() for c in t)}
    got = {r.doc_id: r.text for r in after.collect()}
    kept = {d: t for d, t in want.items() if d not in emptied}
    assert sum(got.get(d) == t for d, t in kept.items()) >= 0.98 * len(kept) and len(set(got) ^ set(kept)) <= 0.02 * len(kept)
    assert all(r.n_chars == len(r.text or "") for r in after.collect())


def test_near_against_all_pairs(stages):
    _, before, after = stages[2]
    classes = test_simhash.slow_classes({r.doc_id: test_near.sets(r.text) for r in before.collect()}, test_near.similar)
    assert ids(after) == set(classes.values()) and after.count() == len(ids(after))


def test_decontamination_against_brute_force(spark, stages):
    _, before, after = stages[3]
    items = test_decontaminate.pairs(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id")
    assert ids(after) == {r[0] for r in test_decontaminate.expected(test_decontaminate.pairs(before, "doc_id"), items) if not r[5]}


def test_packing_of_what_is_left(stages):
    _, before, after = stages[4]
    assert sorted((tuple(r)[:5] for r in after.collect()), key=str) == test_packing.expected([(r.doc_id, r.text) for r in before.collect()])


def test_run(spark, stages):
    assert P.run(spark, SF).count() == stages[-1][2].count()


def test_odd_rows(spark, odd_docs, no_docs):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns, and an empty table, stage by stage."""
    for docs in (odd_docs, no_docs):
        n = docs.count()
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= n, name
        assert stage_rows(spark, docs) >= n
    stage = dict(P.STAGES)
    assert stage["line_dedup"](spark, odd_docs, SF).count() == 6
    assert sorted((r.doc_id for r in stage["near_dedup"](spark, odd_docs, SF).collect()), key=str) == [1, 3, 4, 7, None]
    assert stage["decontamination"](spark, odd_docs, SF).count() == 8


def stage_rows(spark, docs):
    return P.STAGES[-1][1](spark, docs, SF).count()


def test_equal_ids(spark):
    """Rows of one id and several texts: one of each class goes on, once."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    docs = spark.createDataFrame([(1, a), (1, a), (1, a + " more"), (1, b), (None, b), (2, b), (None, "c d"), (None, "c d")], "doc_id long, text string")
    got = [(r.doc_id, r.text[:2]) for r in P.near_dedup(spark, docs, SF).collect()]
    assert sorted(got, key=str) == sorted([(1, "a0"), (1, "b0"), (None, "c ")], key=str)
