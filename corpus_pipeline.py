"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Cases, for every stage: null and empty texts have no words and no lines and are equal to each other, so the first
stage scores them as empty and the third keeps one of them; documents without an id are kept and told apart by their
texts; a repeated row keeps one copy of its lines, and one of its rows goes on; an empty table gives empty tables;
extra columns, whatever their names, go through all stages but the last, which returns pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.llm import _shared, decontaminate, lines, near, packing, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is below one half go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.select(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar lines the first stays; documents that lose every line go."""
    kept = lines.dedup_lines(docs, drop_emptied=True).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays: by fingerprints, or at a similarity of 0.8 or more over shingles of five words.

    Documents that share the least id: the one with the least hash of its text, once.
    """
    stay = near.representatives(docs)
    keyed = docs.withColumn("_text", F.xxhash64(_shared.whole_text()))
    kept = keyed.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_part")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_text"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    hit = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_text"))
    return docs.join(hit, same, "left_anti")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its sequence and offset."""
    return packing.pack(packing.tokenize(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no tokenizer and no fitted model; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _shared.documents(spark, sf_dir)
    for name, stage in STAGES:
        with _shared.cleared() as made:
            docs = _shared.stored(stage(spark, docs, sf_dir), name)
            made.remove(docs._stored)
    return docs
