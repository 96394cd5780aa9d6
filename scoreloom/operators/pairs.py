"""Features of an essay and its prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.structural import ratio
from ..functions.text import words
from ..storage import bounded, stored
from . import lexical

# The features in their order.
NAMES = ("tfidf_cosine_similarity", "word2vec_cbow_cosine_similarity", "word2vec_skipgram_cosine_similarity", "shared_token_count", "essay_prompt_token_jaccard", "prompt_token_coverage")


def overlap(df: DataFrame, essay: str, prompt: str, keep: tuple[str, ...]) -> DataFrame:
    """shared_token_count, essay_prompt_token_jaccard and prompt_token_coverage of distinct words."""
    own = df.select(*keep, F.array_distinct(words(F.col(essay))).alias("_e"), F.array_distinct(words(F.col(prompt))).alias("_p"))
    own = own.withColumn("_n", F.size(F.array_intersect("_e", "_p")).cast("long"))
    n, e, p = F.col("_n"), F.size("_e"), F.size("_p")
    return own.select(*keep, n.alias("shared_token_count"), ratio(n, e + p - n).alias("essay_prompt_token_jaccard"), ratio(n, p).alias("prompt_token_coverage"))


def tfidf_cosine(df: DataFrame, key: str, essay: str, prompt: str, vocab: DataFrame | None = None) -> DataFrame:
    """key, tfidf_cosine_similarity; 0 where a side has no known term.

    ``vocab``: term_idx, term, idf; without it the weights are fitted on training essays. Prompts are weighted once for each distinct text.
    """
    if vocab is None:
        vocab = lexical.with_idf(lexical.fit_vocabulary(df, key, essay), df.where("split = 'train'").count())
    essays = lexical.weighted(lexical.term_counts(df, key, essay), vocab, key)
    prompts = df.select(F.xxhash64(prompt).alias("_prompt"), F.col(prompt).alias("_text"), F.lit("prompt").alias("split")).dropDuplicates(["_prompt"])
    weights = stored(lexical.weighted(lexical.term_counts(prompts, "_prompt", "_text"), vocab, "_prompt").select("_prompt", "term_idx", F.col("value").alias("_other")), "prompts")
    both = essays.join(df.select(key, F.xxhash64(prompt).alias("_prompt")), key).join(bounded(weights), ["_prompt", "term_idx"])
    dots = both.groupBy(key).agg(F.sum(F.col("value") * F.col("_other")).alias("_dot"))
    return df.select(key).join(dots, key, "left").select(key, F.coalesce("_dot", F.lit(0.0)).alias("tfidf_cosine_similarity"))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays; 0 where it is undefined."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def zero_comparisons(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """split and, for each column, how many comparisons are zero."""
    return df.groupBy("split").agg(*(F.sum((F.col(c) == 0).cast("long")).alias(f"{c}_zero") for c in columns))


def check_finite(df: DataFrame, columns: tuple[str, ...]) -> None:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.isnan(c) | (F.abs(c) == float("inf"))
    if df.where(bad).take(1):
        raise AssertionError("features are not finite")


def vector_cosine(df: DataFrame, key: str, essay: str, prompt: str, vectors: DataFrame) -> DataFrame:
    """key, cosine: that of the pooled vectors (word, vector) of essay and prompt. Prompts are pooled once for each distinct text."""
    from . import word2vec

    e = word2vec.pool(df.select(key, F.col(essay).alias("_t")), key, "_t", vectors).select(key, F.col("vector").alias("_e"))
    asked = df.select(key, F.xxhash64(prompt).alias("_prompt"), F.col(prompt).alias("_t"))
    p = word2vec.pool(asked.select("_prompt", "_t").dropDuplicates(["_prompt"]), "_prompt", "_t", vectors).select("_prompt", F.col("vector").alias("_p"))
    return e.join(asked.select(key, "_prompt").join(p, "_prompt"), key).select(key, cosine(F.col("_e"), F.col("_p")).alias("cosine"))


def essay_prompt(df: DataFrame, key: str, essay: str, prompt: str, cbow: DataFrame, skipgram: DataFrame, vocab: DataFrame | None = None) -> DataFrame:
    """The six features. ``cbow`` and ``skipgram``: word, vector; ``vocab``: term_idx, term, idf."""
    out = tfidf_cosine(df, key, essay, prompt, vocab).join(overlap(df, essay, prompt, (key, "split")), key)
    for name, model in (("word2vec_cbow_cosine_similarity", cbow), ("word2vec_skipgram_cosine_similarity", skipgram)):
        out = out.join(vector_cosine(df, key, essay, prompt, model).withColumnRenamed("cosine", name), key)
    return out.select(key, "split", *(F.col(n).cast("double").alias(n) for n in NAMES))
