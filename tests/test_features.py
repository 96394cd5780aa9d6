import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scoreloom import queries
from scoreloom.operators import contextual, lexical, pairs, word2vec

from .encoders import tiny_encoder

TRAIN = ["Alpha Alpha beta", "Alpha beta gamma", "Alpha beta gamma"]
OTHER = [("valid", "Alpha validationonly"), ("valid", "beta gamma"), ("test", "testonly beta"), ("test", "Alpha beta")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, s, t) for i, (s, t) in enumerate([*(("train", t) for t in TRAIN), *OTHER])]
    return spark.createDataFrame(rows, "k int, split string, text string")


def test_lexical(spark, docs):
    counts = lexical.term_counts(docs, "k", "text")
    vocab = lexical.vocabulary(counts)
    assert [(r.term_idx, r.term) for r in vocab.orderBy("term_idx").collect()] == list(enumerate(["Alpha", "Alpha beta", "beta", "beta gamma", "gamma"]))
    first = {r.term_idx: r.value for r in lexical.bow(counts, vocab, "k").where("k = 0").collect()}
    assert first == {0: 2, 1: 1, 2: 1}
    tf = {r.term_idx: r.value for r in lexical.tf(counts, vocab, "k").where("k = 0").collect()}
    assert tf == pytest.approx({k: v / 6**0.5 for k, v in first.items()})
    idf = np.log(4 / np.array([4.0, 4, 4, 3, 3])) + 1
    w = np.array([1, 1, 1, 1, 1]) * idf
    got = {r.term_idx: r.value for r in lexical.tfidf(counts, vocab, "k", 3).where("k = 1").collect()}
    assert [got[i] for i in range(5)] == pytest.approx((w / np.linalg.norm(w)).tolist())
    sparse = lexical.vectors(docs, lexical.bow(counts, vocab, "k"), "k").orderBy("k").collect()
    assert len(sparse) == 7 and [c.term_idx for c in sparse[3].features] == [0]
    with pytest.raises(ValueError):
        lexical.require_vocabulary(lexical.vocabulary(counts.where("split = 'none'")))


def test_overlap(spark):
    df = spark.createDataFrame([(0, "alpha alpha beta", "alpha alpha"), (1, "Olá mãe", "mãe café"), (2, "", "")], "k int, e string, p string")
    rows = [tuple(r)[1:] for r in pairs.overlap(df, "e", "p", ("k",)).orderBy("k").collect()]
    assert rows == [(1, 0.5, 1.0), (1, pytest.approx(1 / 3), 0.5), (0, 0.0, 0.0)]


def test_pool(spark):
    vectors = spark.createDataFrame([("known", [1.0, 3.0]), ("other", [3.0, 5.0])], "word string, vector array<float>")
    df = spark.createDataFrame([(0, "t", "known other missing"), (1, "t", "missing"), (2, "t", "")], "k int, split string, text string")
    pooled = word2vec.pool(df, "k", "text", vectors)
    assert [list(r.vector) for r in pooled.orderBy("k").collect()] == [[2, 4], [0, 0], [0, 0]]
    (r,) = word2vec.coverage(df.select("k", "split").join(pooled, "k")).collect()
    assert (r.token_count, r.known_token_count, r.token_coverage, r.zero_vector_documents) == (4, 2, 0.5, 2)


@pytest.mark.parametrize("architecture", ["cbow", "skipgram"])
def test_word2vec(spark, docs, architecture):
    config = word2vec.Word2VecConfig(vector_size=8, epochs=2, architecture=architecture)
    fits = [{r.word: list(r.vector) for r in word2vec.fit(docs.where("split = 'train'"), "text", config, "k").collect()} for _ in range(2)]
    assert fits[0] == fits[1] and set(fits[0]) == {"Alpha", "beta", "gamma"} and len(fits[0]["beta"]) == 8
    with pytest.raises(ValueError):
        word2vec.fit(docs.where("split = 'none'"), "text", config)
    with pytest.raises(ValueError):
        word2vec.Word2VecConfig(architecture="glove")


def test_skipgram_leaves_the_vocabulary_to_its_shards(spark, monkeypatch):
    """pyspark.ml's holds all words on the driver. Words of one topic come to lie together, in many shards and several epochs too."""
    monkeypatch.setattr("pyspark.ml.feature.Word2Vec", None)
    monkeypatch.setattr(word2vec, "SHARD_TOKENS", 6000)
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{k}" for k in rng.integers(0, 20, 40)) + f" once{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, text string")
    for least, epochs in ((1, 8), (2, 8)):
        config = word2vec.Word2VecConfig(vector_size=8, epochs=epochs, min_count=least, architecture="skipgram", workers=2)
        got = {r.word: np.array(r.vector) for r in word2vec.fit(df, "text", config, "k").collect()}
        topics = {f"{t}{k}" for t in "ab" for k in range(20)}
        assert set(got) == topics | ({f"once{i}" for i in range(600)} if least == 1 else set())
        a, b = (np.array([got[f"{t}{k}"] / np.linalg.norm(got[f"{t}{k}"]) for k in range(20)]) for t in "ab")
        assert min((a @ a.T).mean(), (b @ b.T).mean()) > (a @ b.T).mean() + 0.5
    same = spark.createDataFrame([(0, "a " * 30000), (1, "a b " * 30000)], "k int, text string")
    assert all(np.abs(r.vector).max() < 100 for r in word2vec.fit(same, "text", config, "k").collect())


def test_word2vec_docs_trains_with_the_default_settings(spark, monkeypatch):
    """The query's model once had 16 dimensions and 1 epoch of the 100 and 20."""
    seen = []

    def fit(train, text, config, key):
        seen.append(config)
        return spark.createDataFrame([("the", [1.0] * config.vector_size)], "word string, vector array<float>")

    monkeypatch.setattr(word2vec, "fit", fit)
    out = queries.word2vec_docs(spark, "/root/testdata/sf0.001")
    default = word2vec.Word2VecConfig()
    assert [(c.vector_size, c.window, c.min_count, c.epochs, c.seed) for c in seen] == [(default.vector_size, default.window, default.min_count, default.epochs, default.seed)] == [(100, 5, 1, 20, 42)]
    assert {len(r.vector) for r in out.collect()} == {100}


def test_skipgram_step_against_pairs():
    """The products over blocks are the sums over pairs of words; epochs in one call are those in several."""
    rng = np.random.default_rng(3)
    lists = [[f"w{k}" for k in rng.integers(0, 60, n)] for n in (1, 7, 40, 90, 160)]
    rows = pa.table({"shard": pa.array([4] * 5, pa.int32()), "order": range(5), "tokens": lists})
    config = word2vec.Word2VecConfig(vector_size=6, window=11, epochs=1, architecture="skipgram")
    names = list(dict.fromkeys(w for r in lists for w in r))
    inner, outer = rng.normal(size=(2, len(names), 6)).astype(np.float32)
    shuffled = rng.permutation(len(names))
    given = pa.table({"shard": pa.array([4] * len(names), pa.int32()), "word": [names[i] for i in shuffled], "vector": [inner[i].tobytes() for i in shuffled], "outer": [outer[i].tobytes() for i in shuffled]})
    got = word2vec._skipgram(rows, given, config, range(1))

    code = {w: i for i, w in enumerate(names)}
    ids, doc = [code[w] for r in lists for w in r], [i for i, r in enumerate(lists) for _ in r]
    n = np.bincount(ids)
    drawing = np.random.default_rng([config.seed, 0])
    far = drawing.integers(1, config.window + 1, word2vec.STEP)
    noise = np.cumsum(n**0.75)
    drawn = np.searchsorted(noise, drawing.random(word2vec.NOISE) * noise[-1], side="right")
    pull = lambda s: 1 / (1 + np.exp(-np.clip(s, -20, 20)))
    moves = {"vector": np.zeros_like(inner), "outer": np.zeros_like(outer)}
    sums = {"vector": np.zeros(len(names)), "outer": np.zeros(len(names))}

    def move(a, b, g):
        moves["vector"][a] += g * outer[b]
        moves["outer"][b] += g * inner[a]
        sums["vector"][a] += abs(g)
        sums["outer"][b] += abs(g)

    for i, a in enumerate(ids):
        near = [j for j in range(max(0, i - far[i]), min(len(ids), i + far[i] + 1)) if j != i and doc[j] == doc[i]]
        for j in near:
            move(a, ids[j], 0.025 * (1 - pull(inner[a] @ outer[ids[j]])))
        for z in drawn:
            move(a, z, -0.025 * len(near) * 5 / word2vec.NOISE * pull(inner[a] @ outer[z]))
    assert got.column("word").to_pylist() == names and got.column("k").to_pylist() == n.tolist()
    for c, start in (("vector", inner), ("outer", outer)):
        expected = start + moves[c] / np.maximum(sums[c], 1)[:, None]
        assert np.array([np.frombuffer(b, np.float32) for b in got.column(c).to_pylist()]) == pytest.approx(expected, abs=1e-4)

    config = word2vec.Word2VecConfig(vector_size=6, epochs=3, architecture="skipgram")
    first = word2vec._skipgram(rows, None, config, range(1))
    assert word2vec._skipgram(rows, first, config, range(1, 3)) == word2vec._skipgram(rows, None, config, range(3))


def test_means_of_shards():
    """By count, of words in any order and over several chunks."""
    pack = lambda *x: np.array(x, np.float32).tobytes()
    schema = pa.schema({"shard": pa.int32(), "word": pa.string(), "k": pa.int64(), "vector": pa.binary(), "outer": pa.binary()})
    rows = [(1, "b", 1, pack(1, 2), pack(0, 0)), (0, "a", 5, pack(7, 8), pack(1, 1)), (0, "b", 3, pack(5, 6), pack(4, 8)), (2, "c", 2, pack(9, 9), pack(3, 3))]
    made = pa.concat_tables([pa.Table.from_pylist([dict(zip(schema.names, r)) for r in part], schema) for part in (rows[:1], rows[1:])])
    got = {(r["shard"], r["word"]): (np.frombuffer(r["vector"], np.float32).tolist(), np.frombuffer(r["outer"], np.float32).tolist()) for r in word2vec._averaged(made).to_pylist()}
    assert got == {(1, "b"): ([4, 5], [3, 6]), (0, "b"): ([4, 5], [3, 6]), (0, "a"): ([7, 8], [1, 1]), (2, "c"): ([9, 9], [3, 3])}
    assert {r["word"]: r["vector"] for r in word2vec._final(made).to_pylist()} == {"a": [7, 8], "b": [4, 5], "c": [9, 9]}


def test_essay_prompt(spark, docs):
    own = docs.withColumn("prompt", F.when(F.col("k") == 3, "").otherwise("Alpha beta"))
    models = [word2vec.fit(own.where("split = 'train'"), "text", word2vec.Word2VecConfig(vector_size=4, epochs=1, architecture=a), "k") for a in ("cbow", "skipgram")]
    out = pairs.essay_prompt(own, "k", "text", "prompt", *models)
    pairs.check_finite(out, pairs.NAMES)
    rows = {r.k: r for r in out.collect()}
    assert len(rows) == 7 and rows[6].tfidf_cosine_similarity == pytest.approx(1) and rows[3].tfidf_cosine_similarity == 0 and rows[3].word2vec_cbow_cosine_similarity == 0


def test_chunks_and_means(spark):
    df = spark.createDataFrame([(0, list(range(7))), (1, [])], "k int, ids array<int>")
    assert [r[0] for r in df.orderBy("k").select(contextual.chunks(F.col("ids"), 3)).collect()] == [[[0, 1, 2], [3, 4, 5], [6]], [[]]]
    hidden = np.array([[[1, 2], [3, 4], [100, 100]]], float)
    assert contextual.chunk_vectors(hidden, np.array([[1, 1, 0]])).tolist() == [[2, 3]] and contextual.chunk_vectors(hidden, np.zeros((1, 3))).tolist() == [[0, 0]]
    with pytest.raises(ValueError):
        contextual.chunk_vectors(hidden, np.ones((1, 2)))


def test_limits_and_places():
    assert contextual.least_limit(10**9, 512, None, 0, True) == 512
    with pytest.raises(ValueError):
        contextual.least_limit(None, 10**9)
    cpu, gpu = ["CPUExecutionProvider"], ["CPUExecutionProvider", "CUDAExecutionProvider"]
    assert contextual.place("auto", cpu) == "cpu" and contextual.place("auto", gpu) == "cuda" and contextual.place("cpu", gpu) == "cpu"
    with pytest.raises(RuntimeError):
        contextual.place("cuda", cpu)
    for bad in ({"device": "tpu"}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            contextual.Encoder("x", **bad)


def test_length_statistics(spark):
    df = spark.createDataFrame([("t", n) for n in (1, 2, 3, 10)], "split string, n int")
    r = contextual.length_statistics(df, "n", 3).first()
    assert (r.min, r.max, r.over_max, r.median, r["mean"]) == (1, 10, 25.0, 2.5, 4.0)


def test_embed(spark, tmp_path):
    """Against means by hand: hidden states of id i are (i, 2i, 1), a chunk has ids 2 and 3 around six of a text's."""
    encoder = contextual.Encoder(tiny_encoder(tmp_path / "tiny"), batch_size=2)
    texts = ["a b", " ".join("abcdefghi"), "", None, "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    rows = {r.k: r for r in contextual.embed(df, "k", "text", encoder).collect()}
    mean = lambda ids: (5 + sum(ids)) / (2 + len(ids))
    want = [mean([4, 5]), (mean(range(4, 10)) + mean(range(10, 13))) / 2, mean([]), mean([]), mean([1])]
    for k, m in enumerate(want):
        assert rows[k].vector == pytest.approx([m, 2 * m, 1])
    assert [(rows[k].n_tokens, rows[k].n_chunks) for k in range(5)] == [(2, 1), (9, 2), (0, 1), (0, 1), (1, 1)]
    assert contextual.embed(df.limit(0), "k", "text", encoder).count() == 0
    with pytest.raises(ValueError, match="special"):
        contextual.Encoder(encoder.folder, limit=2).room()
    stats = contextual.chunk_statistics(df.sparkSession.createDataFrame([("t", 1), ("t", 3)], "split string, n int"), "n").first()
    assert (stats.multi_chunk_documents, stats.max_chunks, stats.mean_chunks) == (1, 3, 2.0)
