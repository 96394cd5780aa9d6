"""Runs on storage: cleaned tables, reports, representations, row ids and a manifest that is written last."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as text_functions
from ..operators import validation
from ..schema import TARGETS
from ..sources import files
from . import build, catalog


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(path)
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def id_hashes(df: DataFrame) -> DataFrame:
    """split, count, sha256 of the ids joined in row order by a backslash and an n.

    A digest is sequential, so a split's ids stream through one task in order; it holds one batch at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        state: dict[str, list] = {}
        for batch in batches:
            for split, id_ in zip(batch.column("split").to_pylist(), batch.column("id").to_pylist()):
                held = state.setdefault(split, [0, hashlib.sha256()])
                held[1].update((r"\n" if held[0] else "").encode() + (id_ or "").encode())
                held[0] += 1
        rows = [(k, n, h.hexdigest()) for k, (n, h) in state.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], names=["split", "count", "sha256"])

    return df.select("split", "row_idx", "id").repartition("split").sortWithinPartitions("split", "row_idx", "id").mapInArrow(digest, "split string, count long, sha256 string")


def content_hash(df: DataFrame) -> str:
    """A hash of the rows that their order and partitions do not change."""
    total = df.select(F.xxhash64(*[F.to_json(F.struct(c)) for c in df.columns]).cast("decimal(38,0)").alias("h")).agg(F.sum("h"), F.count("*")).first()
    return f"{total[0]}:{total[1]}"


def new_run(root: str) -> str:
    return f"{root}/run-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}"


def preprocess(spark: SparkSession, data_dir: str, root: str, representation: str = "all", architecture: str = "cbow", expected_rows: dict[str, int] | None = None, config=None, encoder=None) -> str:
    """Validate, clean, fit, transform and store; returns the run's folder. ``config`` is a Word2VecConfig, ``encoder`` an Encoder."""
    hashes = files.file_hashes(spark, data_dir)
    raw, columns = files.load_collection(spark, data_dir)
    checked, summary, duplicates = validation.validate(raw, columns, expected_rows)
    cleaned = text_functions.add_clean_columns(checked)
    text_functions.check_idempotent(cleaned)
    run = new_run(root)
    cleaned.write.partitionBy("split").parquet(f"{run}/cleaned")
    stored = spark.read.parquet(f"{run}/cleaned").select(cleaned.columns)
    if stored.exceptAll(cleaned).take(1) or cleaned.exceptAll(stored).take(1):
        raise AssertionError("the stored table differs from the cleaned one")
    reports = {"validation_diagnostics": summary.orderBy("dataset"), "duplicate_essays": duplicates.orderBy("position").drop("position"), "marker_inventory": text_functions.marker_inventory(raw, "essay", "split").orderBy("dataset", "token")}
    for name, df in reports.items():
        df.coalesce(1).write.option("header", True).csv(f"{run}/reports/{name}")
    ids = {r["split"]: {"count": r["count"], "sha256": r.sha256} for r in id_hashes(stored).collect()}
    stored.select("split", "row_idx", "id").write.partitionBy("split").parquet(f"{run}/row_ids")
    names = catalog.DEFAULT_SET if representation == "all" else (catalog.canonical(representation, architecture),)
    made = {}
    for name in names:
        states, written = store_states(spark, run, name, build.fit(name, stored, config))
        build.transform(name, stored, states, encoder).write.partitionBy("split").parquet(f"{run}/representations/{name}")
        back = spark.read.parquet(f"{run}/representations/{name}")
        metadata = build.describe(name, back, states, config, encoder) | {"states": written}
        if "feature_names" in metadata:
            write_text(spark, f"{run}/states/{name}/feature_names.json", json.dumps(metadata["feature_names"], indent=1))
        shapes = {r["split"]: [r["count"], metadata["feature_dimension"]] for r in back.groupBy("split").count().collect()}
        if {k: v[0] for k, v in shapes.items()} != {k: v["count"] for k, v in ids.items()}:
            raise AssertionError(f"{name}: the stored rows differ from the collection's")
        made[name] = metadata | {"matrix_shapes": shapes, "content_hash": content_hash(back)}
    manifest = {
        "input_hashes": hashes, "row_counts": {k: v["count"] for k, v in ids.items()}, "markers": text_functions.MARKERS, "row_ids": ids,
        "alignment": "representations/<name> and cleaned share row_idx", "representations": made, "catalog": {k: vars(v) for k, v in catalog.CATALOG.items()}, "versions": {"spark": spark.version},
    }
    write_text(spark, f"{run}/manifest.json", json.dumps(manifest, default=str, indent=1))
    return run


def store_states(spark: SparkSession, run: str, name: str, states: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The fitted tables as the run stores them, and the hash of each."""
    held = {}
    for k, df in states.items():
        df.write.parquet(f"{run}/states/{name}/{k}")
        held[k] = spark.read.schema(df.schema).parquet(f"{run}/states/{name}/{k}")
    return held, {k: content_hash(df) for k, df in held.items()}


def load_states(spark: SparkSession, run: str, name: str) -> dict[str, DataFrame]:
    """The fitted tables of a run, after a check of their content."""
    metadata = manifest_of(spark, run)["representations"].get(name)
    if metadata is None:
        raise ValueError(f"{run} has no {name}")
    held = {}
    for k, want in metadata.get("states", {}).items():
        held[k] = spark.read.parquet(f"{run}/states/{name}/{k}")
        if content_hash(held[k]) != want:
            raise ValueError(f"{name}: the stored {k} differs from the manifest")
    return held


def transform(spark: SparkSession, run: str, name: str, raw: DataFrame, encoder=None) -> DataFrame:
    """split, row_idx, id, features of new rows (split, row_idx, id, essay, prompt) by what the run fitted; nothing is fitted anew."""
    states = load_states(spark, run, name)
    return build.transform(name, text_functions.add_clean_columns(raw), states, encoder).select("split", "row_idx", "id", "features")


def manifest_of(spark: SparkSession, run: str) -> dict:
    try:
        found = json.loads(read_text(spark, f"{run}/manifest.json"))
    except json.JSONDecodeError as e:
        raise ValueError(f"{run}: the manifest is no JSON") from e
    if not isinstance(found, dict) or not isinstance(found.get("representations"), dict):
        raise ValueError(f"{run}: the manifest has no representations")
    return found


def run_names(spark: SparkSession, root: str) -> list[str]:
    fs, target = _fs(spark, root)
    if not fs.exists(target):
        return []
    names = [str(s.getPath()) for s in fs.listStatus(target) if s.isDirectory() and s.getPath().getName().startswith("run-")]
    return sorted((n for n in names if _fs(spark, f"{n}/manifest.json")[0].exists(_fs(spark, f"{n}/manifest.json")[1])), reverse=True)


def resolve_run(spark: SparkSession, root: str, run: str = "latest") -> str:
    if run != "latest":
        return run
    names = run_names(spark, root)
    if not names:
        raise FileNotFoundError(f"{root} holds no run with a manifest")
    return names[0]


def resolve_representation(spark: SparkSession, root: str, name: str, run: str = "latest") -> str | None:
    """The newest run that holds the representation, or the named run if it does."""
    for folder in run_names(spark, root) if run == "latest" else [run]:
        try:
            if name in manifest_of(spark, folder)["representations"]:
                return folder
        except (ValueError, FileNotFoundError):
            if run != "latest":
                return None
            raise
    return None


def resolve_or_raise(spark: SparkSession, root: str, name: str, run: str = "latest") -> str:
    found = resolve_representation(spark, root, name, run)
    if found:
        return found
    if run == "latest":
        raise FileNotFoundError(f"no run in {root} has {name}; build it with the preprocess command")
    raise ValueError(f"{run} has no {name}; build it or name another run")


def misaligned(features: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of either side whose place or id the other side lacks."""
    a = features.select("split", "row_idx", F.col("id").alias("_a"))
    b = rows.select("split", "row_idx", F.col("id").alias("_b"))
    return a.join(b, ["split", "row_idx"], "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))


def load(spark: SparkSession, run: str, name: str) -> DataFrame:
    """split, row_idx, id, features and the targets, after checks of counts, dimension, alignment and content."""
    manifest = manifest_of(spark, run)
    if name not in manifest["representations"]:
        raise ValueError(f"{run} has no {name}")
    metadata = manifest["representations"][name]
    if (metadata.get("storage"), metadata.get("format")) != (catalog.CATALOG[name].storage, catalog.CATALOG[name].format):
        raise ValueError(f"{name}: storage or format differs from the catalog")
    df = spark.read.parquet(f"{run}/representations/{name}")
    rows = spark.read.parquet(f"{run}/cleaned")
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    if counts != {k: v[0] for k, v in metadata["matrix_shapes"].items()}:
        raise ValueError(f"{name}: row counts differ from the manifest")
    if metadata["storage"] == "dense" and df.where(F.size("features") != metadata["feature_dimension"]).take(1):
        raise ValueError(f"{name}: feature dimensions differ")
    if misaligned(df, rows).take(1):
        raise ValueError(f"{name}: rows are not aligned with the collection")
    ids = {r["split"]: r.sha256 for r in id_hashes(rows).collect()}
    if ids != {k: v["sha256"] for k, v in manifest["row_ids"].items()}:
        raise ValueError("the ids differ from those that the run recorded")
    if metadata.get("content_hash") and content_hash(df) != metadata["content_hash"]:
        raise ValueError(f"{name}: the content differs from the manifest")
    if missing := sorted(set(TARGETS) - set(rows.columns)):
        raise ValueError(f"missing targets: {missing}")
    return df.select("split", "row_idx", "id", "features").join(rows.select("split", "row_idx", *(F.col(t).cast("long") for t in TARGETS)), ["split", "row_idx"])
