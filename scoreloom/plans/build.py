"""Representations by name from a cleaned collection: states fitted on training rows, and (split, row_idx, id, features) of any rows.

``df`` has split, row_idx, id, essay_clean, prompt and the cleaning columns. What is fitted are tables, so a run
can store them and give the features of new texts later.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import structural, text
from ..operators import contextual, lexical, pairs, word2vec
from . import catalog

KEY = "row_idx"
LEXICAL = ("bow", "tf", "tfidf")


def fit(name: str, df: DataFrame, config: word2vec.Word2VecConfig | None = None) -> dict[str, DataFrame]:
    """The tables that ``transform`` needs besides the rows."""
    train = df.where("split = 'train'")
    words = lambda architecture: word2vec.fit(train, "essay_clean", replace(config or word2vec.Word2VecConfig(), architecture=architecture), KEY)
    weights = lambda: lexical.with_idf(lexical.fit_vocabulary(df, KEY, "essay_clean"), train.count())
    if name in LEXICAL:
        return {"vocabulary": lexical.require_vocabulary(weights())}
    if name.startswith("word2vec_"):
        return {"vectors": words(name.removeprefix("word2vec_"))}
    if name == "essay_prompt":
        return {"vocabulary": weights(), **{f"{a}_vectors": words(a) for a in word2vec.ARCHITECTURES}}
    return {}


def _dense(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.select(KEY, F.array(*(F.col(n).cast("double") for n in names)).alias("features"))


def transform(name: str, df: DataFrame, states: dict[str, DataFrame], encoder: contextual.Encoder | None = None) -> DataFrame:
    """split, row_idx, id, features, and the counts that the statistics of a representation are made from."""
    base = df.select("split", KEY, "id")
    if name in LEXICAL:
        counts, vocab = lexical.term_counts(df, KEY, "essay_clean"), states["vocabulary"]
        weights = lexical.weighted(counts, vocab, KEY) if name == "tfidf" else {"bow": lexical.bow, "tf": lexical.tf}[name](counts, vocab, KEY)
        return lexical.vectors(base, weights, KEY)
    if name == "structural":
        return base.join(_dense(structural.structural(df, (KEY,)), structural.NAMES), KEY)
    if name.startswith("word2vec_"):
        return base.join(word2vec.pool(df, KEY, "essay_clean", states["vectors"]).withColumnRenamed("vector", "features"), KEY)
    if name == "essay_prompt":
        own = df.withColumn("prompt_clean", text.clean(F.col("prompt")))
        features = pairs.essay_prompt(own, KEY, "essay_clean", "prompt_clean", states["cbow_vectors"], states["skipgram_vectors"], states["vocabulary"])
        return base.join(_dense(features, pairs.NAMES), KEY)
    if encoder is None:
        raise ValueError(f"{name} needs the folder of an encoder")
    return base.join(contextual.embed(df, KEY, "essay_clean", encoder).withColumnRenamed("vector", "features"), KEY)


def _by_split(df: DataFrame) -> dict[str, dict]:
    return {r["split"]: {k: v for k, v in r.asDict().items() if k != "split"} for r in df.collect()}


def describe(name: str, out: DataFrame, states: dict[str, DataFrame], config: word2vec.Word2VecConfig | None = None, encoder: contextual.Encoder | None = None) -> dict:
    """What a manifest says of a representation; ``out`` and ``states`` are stored tables."""
    spec = catalog.CATALOG[name]
    found: dict = {"name": name, "family": spec.family, "storage": spec.storage, "format": spec.format, "tokenization": text.TOKENS}
    if name in LEXICAL:
        n = states["vocabulary"].count()
        return found | {"feature_dimension": n, "vocabulary_size": n, "parameters": {"ngram_range": [1, 2], "min_df": lexical.MIN_DF, "lowercase": False}}
    first = out.select(F.size("features").alias("n")).first()
    found["feature_dimension"] = first.n if first else 0
    if name == "structural":
        return found | {"feature_dimension": len(structural.NAMES), "feature_names": list(structural.NAMES), "feature_definitions": structural.DEFINITIONS, "scaling": "none"}
    if name == "essay_prompt":
        pairs.check_finite(out.select(F.explode("features").alias("x")), ("x",))
        held = out.select("split", *(F.col("features")[i].alias(n) for i, n in enumerate(pairs.NAMES[:3])))
        more = {"feature_dimension": len(pairs.NAMES), "feature_names": list(pairs.NAMES), "zero_comparisons": _by_split(pairs.zero_comparisons(held, pairs.NAMES[:3]))}
        return found | more | {"parameters": {k: v for k, v in (config or word2vec.Word2VecConfig()).parameters().items() if k != "architecture"}}
    if name.startswith("word2vec_"):
        own = replace(config or word2vec.Word2VecConfig(), architecture=name.removeprefix("word2vec_"))
        return found | {"parameters": own.parameters(), "vocabulary_size": states["vectors"].count(), "coverage": _by_split(word2vec.coverage(out))}
    lengths, counts = _by_split(contextual.length_statistics(out, "n_tokens", encoder.stated_limit())), _by_split(contextual.chunk_statistics(out, "n_chunks"))
    return found | encoder.described() | {"tokenization": "the encoder's own", "split_statistics": {k: {"token_lengths": v, **counts[k]} for k, v in lengths.items()}}
