"""Tables in the folder that driver and executors share, and frames that are small enough to broadcast."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes of their text, that are broadcast at most; what is larger is joined by shuffles.
SMALL_ROWS, SMALL_BYTES = 500_000, 16 << 20


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
    return out


def freed(spark: SparkSession) -> None:
    """Have the driver let go of frames that nothing holds any more, and with them of their shuffle files, which stay until then."""
    gc.collect()
    spark._jvm.System.gc()


def dropped(df: DataFrame) -> None:
    """Delete the table of a frame that ``stored`` gave, once nothing reads it any more."""
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored)
    target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def bounded(frame: DataFrame, text: str | None = None, rows: int = SMALL_ROWS) -> DataFrame:
    """``frame`` (stored), to be broadcast if its rows and the bytes of ``text`` are few; as it is if not."""
    size = frame.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text)) if text else F.lit(0), F.lit(0))).first()
    return F.broadcast(frame) if size[0] <= rows and size[1] <= SMALL_BYTES else frame
