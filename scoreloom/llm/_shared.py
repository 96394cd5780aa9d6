"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a Python worker keeps from task to task, by operator.
_kept: dict[str, object] = {}

SLICE_BYTES = 8 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors. Only a local master may go without one and gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir names no folder that driver and executors of {master} share")
        root = tempfile.mkdtemp(prefix="scoreloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    for made in _watched:
        made.append(path)
    return out


#: Lists of the tables that have been stored while they were watched.
_watched: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def dropped(df: DataFrame) -> None:
    """Delete the table of a frame that ``stored`` gave, once nothing reads it any more."""
    _delete(df.sparkSession, df._stored)


@contextmanager
def cleared() -> Iterator[list[str]]:
    """Delete the tables stored within, but those that are taken from the list, once what they lead to is stored itself."""
    made: list[str] = []
    _watched.append(made)
    try:
        yield made
    finally:
        _watched.remove(made)
    for path in made:
        _delete(SparkSession.active(), path)


#: Rows, and bytes of their text, that are broadcast at most; what is larger is joined by shuffles.
SMALL_ROWS, SMALL_BYTES = 500_000, 16 << 20


def bounded(frame: DataFrame, text: str | None = None, rows: int = SMALL_ROWS) -> DataFrame:
    """``frame`` (stored), to be broadcast if its rows and the bytes of ``text`` are few; as it is if not."""
    size = frame.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)) if text else F.lit(0), F.lit(0))).first()
    return F.broadcast(frame) if size[0] <= rows and size[1] <= SMALL_BYTES else frame


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def kept(operator: str, make: Callable[[], object]) -> object:
    """What ``operator`` keeps in this worker, made where it is missing."""
    if operator not in _kept:
        _kept[operator] = make()
    return _kept[operator]


# Functions of the module, since what ``lean`` returns is sent to workers with copies of the names it uses.
def _forget(but: str) -> None:
    for other in _kept.keys() - {but}:
        del _kept[other]


def _trim() -> None:
    """Give the memory that is free in this process back to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
        trim(0)


def lean(emit: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], operator: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``emit`` for ``mapInArrow``: before it, what others than ``operator`` keep goes, and after it, free memory.

    Workers live through all stages of a run, and several share an executor's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget(operator)
        try:
            yield from emit(batches)
        finally:
            _trim()

    return run


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each; every row stays whole."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
