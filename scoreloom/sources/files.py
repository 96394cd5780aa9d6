"""Split collections read from CSV, with content hashes. All paths go through Spark's readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import REQUIRED_FILES, SPLITS


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def file_hashes(spark: SparkSession, folder: str, names: tuple[str, ...] = REQUIRED_FILES) -> dict[str, str]:
    """SHA-256 of each required file; FileNotFoundError names those that lack."""
    if missing := [n for n in names if not _exists(spark, f"{folder}/{n}")]:
        raise FileNotFoundError(f"Missing required input files: {missing}")
    rows = spark.read.format("binaryFile").load([f"{folder}/{n}" for n in names]).select("path", F.sha2("content", 256).alias("h")).collect()
    return {r.path.rsplit("/", 1)[1]: r.h for r in rows}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; empty stays empty and NA stays NA; quotes may hold line ends."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": "", "nullValue": "\x01"}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n.lstrip("﻿"), T.StringType()) for n in names])
    return spark.read.schema(schema).options(**options).csv(path).na.fill("")


def load_rows(spark: SparkSession, path: str, split: str = "new", base: int = 0) -> DataFrame:
    """The rows of one file with ``split`` and ``row_idx``, their place in it from ``base``."""
    from pyspark.sql import Window

    # A multi-line CSV file is one partition, so its order is that of the file.
    at = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) - 1
    return read_csv(spark, path).withColumns({"split": F.lit(split), "row_idx": F.lit(base).cast("long") + at})


def load_collection(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, list[str]]]:
    """One frame of all splits with ``split`` and ``row_idx`` (the place in its file), and each split's own columns."""
    parts, columns = [], {}
    for order, split in enumerate(SPLITS):
        df = load_rows(spark, f"{folder}/{split}.csv", split, order << 40)
        columns[split] = [c for c in df.columns if c not in ("split", "row_idx")]
        parts.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), columns
