"""Relational audits of a split collection: one frame with a ``split`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import comparison_key, stripped
from ..schema import SCORES, TARGETS, columns_of

#: Identifiers that a message lists at most.
LISTED = 100
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def schema_problems(split: str, columns: list[str]) -> list[str]:
    want, have = set(columns_of(split)), set(columns)
    if want == have:
        return []
    return [f"{split}: missing columns={sorted(want - have)}, extra columns={sorted(have - want)}"]


def diagnostics(df: DataFrame) -> DataFrame:
    """dataset, rows, columns, and counts of empty and repeated values, a row per split.

    Repeats are counted by aggregating twice, so no split is gathered in one task.
    """
    data = [c for c in df.columns if c != "split"]
    blank = lambda c: F.sum((stripped(F.col(c)) == "").cast("long")).alias(c)
    base = df.groupBy("split").agg(F.count("*").alias("rows"), *(blank(c).alias(f"_{c}") for c in ("id", "essay", "prompt")))
    sizes = lambda keys: df.groupBy("split", *keys).agg(F.count("*").alias("n"))
    ids = sizes(["id"]).groupBy("split").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate_id_rows"))
    rows = sizes(data).groupBy("split").agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))
    essays = sizes(["essay"]).groupBy("split").agg(F.sum(F.col("n") - 1).alias("duplicate_essays"))
    joined = base.join(ids, "split").join(rows, "split").join(essays, "split")
    return joined.select(
        F.col("split").alias("dataset"), "rows", F.lit(len(data)).cast("long").alias("columns"), F.col("_id").alias("empty_ids"), "duplicate_id_rows",
        F.col("_essay").alias("empty_essays"), F.col("_prompt").alias("empty_prompts"), "duplicate_rows", "duplicate_essays",
    )


def valid_score(value: Column) -> Column:
    number = F.when(value.cast("string").rlike(NUMERIC), value.cast("string").try_cast("double"))
    return F.coalesce(number.isin([float(s) for s in SCORES]), F.lit(False))


def invalid_scores(df: DataFrame, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """dataset, target, invalid: how many scores of each labelled split are outside the range."""
    counts = df.where("split <> 'test'").groupBy("split").agg(*(F.sum((~valid_score(F.col(t))).cast("long")).alias(t) for t in targets))
    return counts.unpivot("split", list(targets), "target", "invalid").withColumnRenamed("split", "dataset")


def shared_ids(df: DataFrame) -> DataFrame:
    """first, second, id for every id in two splits."""
    own = df.select("split", "id").distinct()
    left, right = own.select(F.col("split").alias("first"), "id"), own.select(F.col("split").alias("second"), "id")
    return left.join(right, "id").where("first < second").select("first", "second", "id")


def duplicate_report(df: DataFrame, position: str = "position") -> DataFrame:
    """group, dataset, id, across_datasets for every essay whose comparison key has another row; ``position`` is the input order.

    Groups are numbered by first appearance. Only rows in groups are ranked.
    """
    keyed = df.select("split", "id", position, comparison_key(F.col("essay")).alias("key")).where("key <> ''")
    # Grouped by a digest, so that no text is shuffled.
    keyed = keyed.withColumn("key", F.sha2("key", 256))
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min(position).alias("first"), (F.min("split") != F.max("split")).alias("across_datasets")).where("n > 1")
    groups = groups.withColumn("_cell", F.floor(F.col("first") / 65536))
    # Numbers come from counts of position ranges, then ranks within a range of at most 65,536 rows.
    cells = groups.groupBy("_cell").agg(F.count("*").alias("_m"))
    cells = cells.withColumn("_base", F.coalesce(F.sum("_m").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = groups.join(cells, "_cell").withColumn("group", F.col("_base") + F.row_number().over(Window.partitionBy("_cell").orderBy("first")))
    return keyed.join(ranked, "key").select("group", F.col("split").alias("dataset"), "id", "across_datasets", F.col(position).alias("position"))


def validate(df: DataFrame, columns: dict[str, list[str]], expected_rows: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores cast, diagnostics, duplicate report); one ValueError with every problem found.

    ``columns``: each split's own columns as read.
    """
    problems = [p for split, names in columns.items() for p in schema_problems(split, names)]
    if any("missing columns=[]" not in p for p in problems):
        raise ValueError("Validation failed:\n- " + "\n- ".join(problems))
    summary = diagnostics(df.select("split", *(c for c in df.columns if c in ("id", "essay", "prompt", *TARGETS))))
    for r in sorted(summary.collect(), key=lambda r: r.dataset):
        if expected_rows and expected_rows.get(r.dataset) != r["rows"]:
            problems.append(f"{r.dataset}: expected {expected_rows.get(r.dataset)} rows, found {r['rows']}")
        if r.empty_ids:
            problems.append(f"{r.dataset}: contains empty IDs")
        if r.duplicate_id_rows:
            problems.append(f"{r.dataset}: contains duplicate IDs")
    problems += [f"{r.dataset}: {r.invalid} invalid scores in {r.target}" for r in invalid_scores(df).where("invalid > 0").orderBy("dataset", "target").collect()]
    shared = shared_ids(df)
    for r in shared.groupBy("first", "second").agg(F.count("*").alias("n")).orderBy("first", "second").collect():
        ids = [x.id for x in shared.where((F.col("first") == r["first"]) & (F.col("second") == r["second"])).orderBy("id").limit(LISTED).collect()]
        problems.append(f"{r['first']} and {r['second']} share IDs: {ids}" + (f" and {r.n - LISTED} more" if r.n > LISTED else ""))
    if problems:
        raise ValueError("Validation failed:\n- " + "\n- ".join(problems))
    cast = df.withColumns({t: F.col(t).try_cast("double").cast("long") for t in TARGETS})
    return cast, summary, duplicate_report(df, "row_idx" if "row_idx" in df.columns else "position")
