"""Counts, term frequency and TF-IDF of words and bigrams, as long tables (row, term_idx, value).

The vocabulary is fitted on training rows only and stored. Nothing is ever densified, and the vocabulary is
joined: broadcast while it is small, else by a shuffle that adaptive execution splits at frequent terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import lexical_terms, lexical_words
from ..storage import bounded, stored

MIN_DF = 2


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, split, term, n: tokenised once, counted within each document.

    Texts are dealt by key before they are cut up, so that counting and norms need no further shuffle.
    """
    tokens = df.select(key, "split", text).repartition(key).select(key, "split", lexical_words(F.col(text)).alias("_t"))
    return tokens.select(key, "split", F.explode(lexical_terms(F.col("_t"))).alias("term")).groupBy(key, "split", "term").agg(F.count("*").alias("n"))


def indexed(terms: DataFrame) -> DataFrame:
    """term_idx, term, df (stored) of ``terms`` (term, df), indexed in code-point order.

    Terms are dealt by range; the order is that of ranges, by their counts, then of terms within a range.
    """
    ranged = stored(terms.repartitionByRange("term").withColumn("_p", F.spark_partition_id()), "terms")
    # A row for each partition of a shuffle.
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_m"))
    sizes = sizes.withColumn("_base", F.coalesce(F.sum("_m").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("term"))).join(F.broadcast(sizes), "_p")
    return stored(ranked.select((F.col("_base") + F.col("_r") - 1).alias("term_idx"), "term", "df"), "vocabulary")


def vocabulary(counts: DataFrame, min_df: int = MIN_DF) -> DataFrame:
    """term_idx, term, df of the training terms in ``min_df`` documents or more."""
    return indexed(counts.where("split = 'train'").groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= min_df))


def fit_vocabulary(df: DataFrame, key: str, text: str, min_df: int = MIN_DF) -> DataFrame:
    """As ``vocabulary``, from the texts of distinct keys: each training document gives its distinct terms, which are counted once."""
    # The tokens are a column of their own: within the expression for pairs they would be cut anew for each pair.
    tokens = df.where("split = 'train'").select(lexical_words(F.col(text)).alias("_t"))
    held = tokens.select(F.explode(F.array_distinct(lexical_terms(F.col("_t")))).alias("term"))
    return indexed(held.groupBy("term").agg(F.count("*").alias("df")).where(F.col("df") >= min_df))


def require_vocabulary(vocab: DataFrame) -> DataFrame:
    if not vocab.take(1):
        raise ValueError("empty vocabulary: no term is in enough training documents")
    return vocab


def bow(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    return counts.join(bounded(vocab.select("term", "term_idx"), "term"), "term").select(key, "split", "term_idx", F.col("n").alias("value"))


def normalised(weights: DataFrame, key: str) -> DataFrame:
    """Each row's values divided by their Euclidean norm."""
    return weights.withColumn("value", F.col("value") / F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(key))))


def tf(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    return normalised(bow(counts, vocab, key).withColumn("value", F.col("value").cast("double")), key)


def with_idf(vocab: DataFrame, n_train: int) -> DataFrame:
    return vocab.withColumn("idf", F.log((1.0 + n_train) / (1.0 + F.col("df"))) + 1.0)


def weighted(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """Counts times the ``idf`` of ``vocab``, then Euclidean norm."""
    held = counts.join(bounded(vocab.select("term", "term_idx", "idf"), "term"), "term")
    return normalised(held.select(key, "split", "term_idx", (F.col("n") * F.col("idf")).alias("value")), key)


def tfidf(counts: DataFrame, vocab: DataFrame, key: str, n_train: int) -> DataFrame:
    """Smoothed inverse document frequency, then Euclidean norm; ``n_train`` counts empty documents too."""
    return weighted(counts, with_idf(vocab, n_train), key)


def shapes(df: DataFrame, vocab: DataFrame) -> DataFrame:
    """split, rows, feature_dimension."""
    return df.groupBy("split").agg(F.count("*").alias("rows")).withColumn("feature_dimension", F.lit(vocab.count()).cast("long"))


def vectors(df: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """Every row of ``df`` with its sorted (term_idx, value) list; rows without known terms have an empty one."""
    held = weights.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("term_idx", "value"))).alias("features"))
    empty = F.array().cast("array<struct<term_idx:bigint,value:double>>")
    typed = held.withColumn("features", F.col("features").cast("array<struct<term_idx:bigint,value:double>>"))
    return df.join(typed, key, "left").withColumn("features", F.coalesce("features", empty))
