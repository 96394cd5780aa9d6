"""Sorted runs of equal keys, and links within them, one batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared, components

#: Rows of one key that a task compares at once; larger buckets are compared block by block.
BLOCK = 4096


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, "np.ndarray"]]:
    """Batches of whole runs of equal ``key`` (not null), with the starts of the runs and the end.

    Only the last run of a batch waits for the next batch; once it has over BLOCK rows it goes on in parts.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []

    def cut(parts: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, np.ndarray]:
        whole = parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        keys = whole.column(key).to_numpy(zero_copy_only=False)
        return whole, np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole, at = cut(held)
        last = int(at[-2])
        if last:
            yield whole.slice(0, last), at[:-1]
            whole = whole.slice(last)
        held = [whole]
        if whole.num_rows > BLOCK:
            yield whole, np.array([0, whole.num_rows])
            held = []
    if held:
        yield cut(held)


#: Links of one group of a large bucket: the rows (key, x, y, ...) of two blocks to u, v.
Link = Callable[[pa.Table], pa.Table]


def blocked(late: DataFrame, item: str, block: int, least: Column | None = None) -> DataFrame:
    """``late`` with n, the blocks of about ``block`` items in the bucket ``key``, and own, the item's block.

    ``least`` is an aggregate of a bucket's rows that gives the blocks it has at least.
    """
    n = F.count("*") / block
    blocks = _shared.stored(late.groupBy("key").agg(F.ceil(n if least is None else F.greatest(n, least)).alias("n")), "blocks")
    return late.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64(item), F.col("n")))


def large_links(late: DataFrame, item: str, block: int, link: Link, least: Column | None = None) -> DataFrame:
    """u, v: a forest of the links in large buckets, the rows (key, ``item``, ...) of ``late`` (stored).

    A bucket's first block is held against all its blocks. Items that this connects with most others need not be held
    against each other again, so what follows are the blocks of the rest against all blocks: a bucket of n near copies
    takes rows in proportion to n, and one with a rest of r items n * r / block more. Groups are dealt to all tasks.
    """
    grouped = lambda rows: rows.repartition("key", "x", "y").groupBy("key", "x", "y").applyInArrow(link, "u long, v long")
    names = [c for c in late.columns if c != "key"]
    # Smaller blocks here: the rows are as many, and their comparisons fewer.
    dealt = blocked(late, item, max(1, block // 4), None if least is None else 4 * least)
    others = F.when(F.col("own") > 0, F.array("own")).when(F.col("n") > 1, F.sequence(F.lit(1).cast("long"), F.col("n") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    first = dealt.select("key", *names, F.lit(0).cast("long").alias("x"), F.explode(others).alias("y"))
    found = _shared.stored(grouped(first), "first")
    roots = components.components(found)
    several = dealt.where("n > 1").select("key", *names)
    named = several.join(roots, several[item] == roots["node"], "left").select("key", *names, F.coalesce("root", item).alias("root"))
    named = _shared.stored(named, "named")
    sizes = _shared.stored(named.groupBy("key", "root").agg(F.count("*").alias("k")), "sizes")
    most = _shared.stored(sizes.groupBy("key").agg(F.max(F.struct("k", "root"))["root"].alias("most")), "most")
    sided = _shared.stored(named.join(most, "key").select("key", *names, (F.col("root") == F.col("most")).alias("main")), "sided")
    rest = sided.where("not main").select("key", *names)
    if not rest.take(1):
        return found
    main = sided.where("main").join(rest.select("key").distinct(), "key", "left_semi").select("key", *names)
    rest, main = blocked(rest, item, block, least), blocked(main, item, block, least)
    n_rest, n_main = (_shared.stored(side.select("key", F.col("n").alias(name)).distinct(), name) for side, name in ((rest, "n_rest"), (main, "n_main")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("other")
    # Blocks of the rest have numbers from 0, those of the others negative ones.
    own = main.join(n_rest, "key").select("key", *names, "own", upto("n_rest")).select("key", *names, (-1 - F.col("own")).alias("x"), F.col("other").alias("y"))
    across = rest.join(n_main, "key").select("key", *names, "own", upto("n_main")).select("key", *names, (-1 - F.col("other")).alias("x"), F.col("own").alias("y"))
    within = rest.select("key", *names, "own", upto("n")).select("key", *names, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    return found.unionByName(grouped(own.unionByName(across).unionByName(within)))


def spread(n: int, linked: Callable[["np.ndarray", "np.ndarray"], "np.ndarray"]) -> "np.ndarray":
    """The component of each of n items, named by its first item.

    ``linked(a, b)`` tells for items a and b whether any a is linked with each b. Each item is held
    against those not yet reached, so nothing of size n * n is kept.
    """
    import numpy as np

    label = np.full(n, -1)
    rest = np.arange(n)
    while len(rest):
        front, root = rest[:1], int(rest[0])
        label[front] = root
        rest = rest[1:]
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for i in range(0, len(front), 64):
                hit |= linked(front[i : i + 64], rest)
            front, rest = rest[hit], rest[~hit]
            label[front] = root
    return label
