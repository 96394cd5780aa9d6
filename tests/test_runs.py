import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloom import cli
from scoreloom.functions import structural
from scoreloom.operators import contextual, models, validation, word2vec
from scoreloom.plans import catalog, runs
from scoreloom.schema import TARGETS
from scoreloom.sources import files

from .encoders import tiny_encoder

ROWS = {"train": 2, "valid": 1, "test": 1}
ESSAYS = {"train": ["[T] Alpha [P] beta", "Alpha beta"], "valid": ["Alpha gamma"], "test": ["Alpha delta"]}


@pytest.fixture()
def folder(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    for split, essays in ESSAYS.items():
        head = ["id", "essay", "prompt", *(TARGETS if split != "test" else ())]
        lines = [",".join(head)]
        for i, e in enumerate(essays):
            lines.append(",".join([f"{split}-{i + 1}", f'"{e}"', "P", *([str(i + 1)] * 4 if split != "test" else [])]))
        (data / f"{split}.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    (data / "sample_submission.csv").write_text("id\n")
    return data


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,essay\n1,"a ""q""\nb, c"\n2,NA\n3,\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", 'a "q"\nb, c'), ("2", "NA"), ("3", "")]
    with pytest.raises(FileNotFoundError, match="train.csv"):
        files.file_hashes(spark, str(tmp_path))


def test_end_to_end(spark, folder, tmp_path):
    root, out = str(tmp_path / "runs"), str(tmp_path / "out")
    run = cli.main(["preprocess", "--data-dir", str(folder), "--runs", root], spark, ROWS)
    manifest = runs.manifest_of(spark, run)
    assert set(manifest["representations"]) == set(catalog.DEFAULT_SET) and manifest["row_counts"] == ROWS and len(manifest["input_hashes"]) == 4
    assert set(manifest["representations"]["structural"]["feature_definitions"]) == set(structural.NAMES)
    assert runs.resolve_run(spark, root).endswith(run.rsplit("/", 1)[1])
    df = runs.load(spark, run, "structural")
    assert df.count() == 4 and df.where("split = 'train'").agg(F.sum("cohesion")).first()[0] == 3
    tuned = cli.main(["tune", "--runs", root, "--output", out, "--representation", "structural", "--representation", "bert"], spark)
    assert tuned["bert"]["status"] == "skipped" and len(tuned["structural"]["ridge"]["cohesion"]) == 10
    for name in ("structural", "bow"):
        cli.main(["train", "--runs", root, "--output", out, "--representation", name], spark)
        result = cli.main(["evaluate", "--runs", root, "--output", out, "--representation", name], spark)[name]
        assert set(result["targets"]) == set(TARGETS) and result["overall"]["rmse"] == pytest.approx(np.mean([v["rmse"] for v in result["targets"].values()]))
    with pytest.raises(ValueError, match="model"):
        models.evaluate_bundle(spark, run, "bow", runs.load(spark, run, "bow"), "linear_svr", f"{out}/bow/ridge")
    broken = manifest | {"row_ids": {k: v | {"sha256": "x"} for k, v in manifest["row_ids"].items()}}
    runs.write_text(spark, f"{run}/manifest.json", json.dumps(broken))
    with pytest.raises(ValueError, match="ids"):
        runs.load(spark, run, "structural")
    with pytest.raises(FileNotFoundError):
        runs.resolve_or_raise(spark, root, "bert")
    runs.write_text(spark, f"{run}/manifest.json", "{")
    with pytest.raises(ValueError):
        runs.manifest_of(spark, run)


def test_states_and_transform(spark, folder, tmp_path):
    """What a run fitted gives its own rows their features again, and new texts theirs."""
    root, out = str(tmp_path / "runs"), str(tmp_path / "out")
    config = word2vec.Word2VecConfig(vector_size=4, epochs=1)
    encoder = tiny_encoder(tmp_path / "tiny")
    states = {"tfidf": {"vocabulary"}, "word2vec_cbow": {"vectors"}, "essay_prompt": {"vocabulary", "cbow_vectors", "skipgram_vectors"}, "bert": set()}
    for name, want in states.items():
        run = runs.preprocess(spark, str(folder), root, name, expected_rows=ROWS, config=config, encoder=contextual.Encoder(encoder))
        metadata = runs.manifest_of(spark, run)["representations"][name]
        assert set(metadata["states"]) == want == set(runs.load_states(spark, run, name))
        rows = spark.read.parquet(f"{run}/cleaned").select("split", "row_idx", "id", "essay", "prompt")
        again = {r.row_idx: r.features for r in runs.transform(spark, run, name, rows, contextual.Encoder(encoder)).collect()}
        first = {r.row_idx: r.features for r in runs.load(spark, run, name).collect()}
        assert set(first) == set(again)
        for k, v in first.items():
            flat = lambda x: [float(z) for y in x for z in (y if isinstance(y, tuple) else (y,))]
            assert flat(again[k]) == pytest.approx(flat(v), abs=1e-6)
        if name == "bert":
            assert metadata["split_statistics"]["train"]["multi_chunk_documents"] == 0 and metadata["maximum_length"] == 8
        if name == "essay_prompt":
            assert json.loads(runs.read_text(spark, f"{run}/states/{name}/feature_names.json")) == metadata["feature_names"]
    (tmp_path / "new.csv").write_text("id,essay,prompt\nn-1,Alpha Alpha unseen,P\n")
    cli.main(["transform", "--runs", root, "--csv", str(tmp_path / "new.csv"), "--representation", "tfidf", "--output", out], spark)
    made = spark.read.parquet(out).first()
    assert made.id == "n-1" and [(c.term_idx, c.value) for c in made.features] == [(0, 1.0)]
    run = runs.resolve_or_raise(spark, root, "tfidf")
    spark.createDataFrame([(0, "other", 1, 1.0)], "term_idx long, term string, df long, idf double").write.mode("overwrite").parquet(f"{run}/states/tfidf/vocabulary")
    with pytest.raises(ValueError, match="vocabulary differs"):
        runs.load_states(spark, run, "tfidf")


def collection(spark, **change):
    rows = [("train", "train-1", "A", "P", "1"), ("train", "train-2", "B", "P", "2.0"), ("valid", "valid-1", "C", "P", "3"), ("test", "test-1", "D", "P", None)]
    df = spark.createDataFrame([(i, *r, *[r[-1]] * 3) for i, r in enumerate(rows)], "row_idx long, split string, id string, essay string, prompt string, " + ", ".join(f"{t} string" for t in TARGETS))
    return df.withColumns(change)


COLUMNS = {s: ["id", "essay", "prompt", *(TARGETS if s != "test" else ())] for s in ("train", "valid", "test")}


def test_validation(spark):
    cast, summary, _ = validation.validate(collection(spark), COLUMNS, ROWS)
    assert dict(cast.dtypes)["cohesion"] == "bigint" and [r.cohesion for r in cast.orderBy("row_idx").collect()] == [1, 2, 3, None]
    assert {r.dataset: r["rows"] for r in summary.collect()} == ROWS
    for change, message in (
        ({"id": F.when(F.col("id") == "valid-1", "train-1").otherwise(F.col("id"))}, "share IDs"),
        ({"cohesion": F.when(F.col("id") == "train-1", "9").otherwise(F.col("cohesion"))}, "train: 1 invalid scores in cohesion"),
        ({"cohesion": F.when(F.col("id") == "train-1", "3d").otherwise(F.col("cohesion"))}, "invalid scores"),
        ({"id": F.when(F.col("id") == "train-1", " ").otherwise(F.col("id"))}, "contains empty IDs"),
        ({"id": F.when(F.col("split") == "train", "same").otherwise(F.col("id"))}, "contains duplicate IDs"),
    ):
        with pytest.raises(ValueError, match=message):
            validation.validate(collection(spark, **change), COLUMNS, ROWS)
    with pytest.raises(ValueError, match=r"missing columns=\['essay'\]"):
        validation.validate(collection(spark), COLUMNS | {"test": ["id", "prompt"]}, ROWS)


def test_ridge_closed_forms(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)), rng.normal(size=40)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    for intercept in (True, False):
        w, b = models.solve_ridge(x, y, 2.0, intercept)
        got = models.ridge_gram(df, ["a", "b", "c"], "y", 2.0, intercept)
        assert [got[k] for k in "abc"] == pytest.approx(w.tolist()) and got["intercept"] == pytest.approx(b)
        wide = rng.normal(size=(10, 30))
        w, b = models.solve_ridge(wide, y[:10], 0.5, intercept)
        c = wide - wide.mean(axis=0) if intercept else wide
        assert c.T @ (c @ w - (y[:10] - y[:10].mean() * intercept)) + 0.5 * w == pytest.approx(np.zeros(30), abs=1e-8)


@pytest.mark.parametrize("loss", ["epsilon_insensitive", "squared_epsilon_insensitive"])
def test_svr_objective(loss):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    w, b = models.solve_svr(x, y, C=1.0, epsilon=0.1, loss=loss)

    def objective(w, b):
        e = np.maximum(0, np.abs(y - x @ w - b) - 0.1)
        return 0.5 * (w @ w + b * b) + (e**2 if loss.startswith("sq") else e).sum()

    best = objective(w, b)
    assert all(best <= objective(w + d[:3], b + d[3]) + 1e-3 for d in rng.normal(scale=0.05, size=(200, 4)))


def slow_svr(a, y, C, epsilon, squared):
    """Dual coordinate descent, a row at a time."""
    diagonal, bound = (0.5 / C, np.inf) if squared else (0.0, C)
    beta, w = np.zeros(len(a)), np.zeros(a.shape[1])
    for _ in range(5000):
        for i in range(len(a)):
            norm = a[i] @ a[i] + diagonal
            g = a[i] @ w - y[i] + diagonal * beta[i]
            low, high = beta[i] - (g + epsilon) / norm, beta[i] - (g - epsilon) / norm
            new = np.clip(low if low > 0 else high if high < 0 else 0.0, -bound, bound)
            w += (new - beta[i]) * a[i]
            beta[i] = new
    return w


@pytest.mark.parametrize("squared", [False, True])
@pytest.mark.parametrize("epsilon", [0.0, 0.1])
def test_svr_against_coordinate_descent(squared, epsilon):
    rng = np.random.default_rng(2)
    loss = "squared_epsilon_insensitive" if squared else "epsilon_insensitive"
    for n, d, C in ((25, 2, 1.0), (25, 2, 0.01), (8, 12, 10.0)):
        x, y = rng.normal(size=(n, d)), rng.integers(1, 6, n).astype(float)
        w, b = models.solve_svr(x, y, C=C, epsilon=epsilon, loss=loss)
        assert [*w, b] == pytest.approx(slow_svr(np.hstack([x, np.ones((n, 1))]), y, C, epsilon, squared).tolist(), abs=2e-3)


def test_svr_grid_on_unscaled_features():
    """All 20 points on 12,000 rows of 21 features from 0 to 10; coordinate descent took hours for them. The objective has no lower neighbour."""
    import time

    rng = np.random.default_rng(4)
    x = np.log1p(rng.integers(0, 20000, (12000, 21)) * (rng.random(21) + 0.001))
    y = rng.integers(1, 6, 12000).astype(float)
    began = time.time()
    for point in models.grid("linear_svr"):
        w, b = models.solve_svr(x, y, **point)

        def objective(w, b):
            e = np.maximum(0, np.abs(y - x @ w - b) - point["epsilon"])
            return 0.5 * (w @ w + b * b) + point["C"] * ((e**2).sum() if point["loss"].startswith("sq") else e.sum())

        best = objective(w, b)
        assert all(best <= objective(w + s * d[:21], b + s * d[21]) + 1e-6 * best for s in (1e-3, 1e-2, 1e-1) for d in rng.normal(size=(10, 22)))
    assert time.time() - began < 100


def test_grid_sends_rows_once_per_target(spark, monkeypatch):
    """Each target's matrix is made once for all points, and every point has its own fit."""
    rng = np.random.default_rng(6)
    rows = [("train" if i < 40 else "valid", i, rng.normal(size=3).tolist(), *map(int, rng.integers(1, 6, 4))) for i in range(60)]
    df = spark.createDataFrame(rows, "split string, row_idx long, features array<double>, " + ", ".join(f"{t} long" for t in TARGETS))
    points = models.grid("linear_svr")
    made = models.fit_and_predict(df, "linear_svr", points)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "point" not in plan.split("FlatMapGroupsInPandas")[-1].split("\n", 1)[1]
    got = {(r.point, r.target, r.row_idx): r for r in made.collect()}
    assert set(got) == {(p, t, i) for p in range(20) for t in TARGETS for i in range(40, 60)}
    x, z = (np.array([r[2] for r in rows if r[0] == s]) for s in ("train", "valid"))
    for k, t in enumerate(TARGETS):
        y = np.array([r[3 + k] for r in rows if r[0] == "train"], float)
        for p in (0, 7, 19):
            w, b = models.solve_svr(x, y, **points[p])
            assert [got[p, t, i].prediction for i in range(40, 60)] == pytest.approx(np.clip(z @ w + b, 1, 5).tolist())


def test_config(tmp_path):
    assert len(models.grid("ridge")) == 10 and len(models.grid("linear_svr")) == 20
    path = tmp_path / "m.yaml"
    good = {"targets": list(TARGETS), "representations": ["bow"], "models": {"ridge": {"params": {"alpha": {"default": 1.0, "values": [1.0]}}}}}
    path.write_text(json.dumps(good))
    assert models.load_config(str(path))["models"]["ridge"]["alpha"]["values"] == [1.0]
    for bad in (good | {"targets": ["x"]}, good | {"representations": ["bow", "bow"]}, good | {"models": {"tree": {}}}, good | {"models": {"ridge": {"params": {"alpha": {"default": 2.0, "values": [1.0]}}}}}):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            models.load_config(str(path))
    assert catalog.canonical("word2vec", "skipgram") == "word2vec_skipgram"
    with pytest.raises(ValueError):
        catalog.canonical("lsa")
