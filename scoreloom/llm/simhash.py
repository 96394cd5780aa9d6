"""SimHash fingerprints and their near-duplicate classes by pigeonring filtering.

The 64 bits are a ring of five segments. If two fingerprints differ in at most four bits, then from
some segment on every chain of l consecutive segments differs in at most 4 l / 5 bits: that
segment is equal, the next adds one bit at most, and so on. Fingerprints therefore meet under
keys made of a segment and the next one with one bit left out; in a bucket longer chains
prune pairs before the full Hamming check. Buckets give the edges of a forest, not pairs, so a group of
n near copies gives at most n - 1 edges for each key. Buckets of over BLOCK fingerprints
are compared block by block. Distinct fingerprints are linked, then documents take their class.

Cases: texts without words (null, empty) have fingerprint zero and link like others; repeated
rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared, buckets, components

WIDTHS = (13, 13, 13, 13, 12)
DISTANCE = 4
SHINGLE = 4
SEED = 42
FULL = (1 << 64) - 1


def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of UTF-8 bytes; only A-Z change case."""
    import numpy as np
    import xxhash

    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([hash_of(joined, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = len(words) - shingle + 1
        spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter((hash_of(joined[a:b], seed) for a, b in spans), np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in _shared.by_bytes(batches, "text"):
            fps = np.array([fingerprint((t or "").encode(), shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compute, "doc_id long, fp long")


def _segments() -> list[tuple[int, int]]:
    at, out = 0, []
    for w in WIDTHS:
        out.append((at, w))
        at += w
    return out


def keys(fps: DataFrame) -> DataFrame:
    """key, fp: for each segment, and each bit of the next one, the two segments without that bit.

    The key's low three bits name the segment. Two fingerprints that share none of a segment's
    keys differ in that segment or in two bits of the next.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        segments = _segments()
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (at, width) in enumerate(segments):
                own = (fp >> np.uint64(at)) & np.uint64((1 << width) - 1)
                to, wide = segments[(i + 1) % len(segments)]
                after = (fp >> np.uint64(to)) & np.uint64((1 << wide) - 1)
                for bit in range(wide):
                    key = own << np.uint64(32) | (after & ~np.uint64(1 << bit)) << np.uint64(8) | np.uint64(bit << 4) | np.uint64(i)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["key", "fp"])

    return fps.mapInArrow(emit, "key long, fp long")


def _chains() -> list[list[tuple[int, int]]]:
    """For each segment the masks and budgets of the chains that start there, of three segments up to all."""
    segments, out = _segments(), []
    for i in range(len(segments)):
        mask, chain = 0, []
        for n in range(1, len(segments) + 1):
            at, width = segments[(i + n - 1) % len(segments)]
            mask |= ((1 << width) - 1) << at
            if n >= 3:
                chain.append((mask, DISTANCE * n // len(segments)))
        out.append(chain)
    return out


def close(x: "np.ndarray", start: "np.ndarray", chains: list[list[tuple[int, int]]]) -> "np.ndarray":
    """Whether differences ``x`` of pairs that met under segment ``start`` pass the chains, the last of which is the full check."""
    import numpy as np

    masks = np.array([[m for m, _ in c] for c in chains], np.uint64)
    out = np.ones(x.shape, bool)
    for j, (_, budget) in enumerate(chains[0]):
        out &= np.bitwise_count(x & masks[start, j]) <= budget
    return out


def links(keyed: DataFrame) -> DataFrame:
    """u, v, late: forest edges of each bucket; rows of buckets over BLOCK go on as (key, fp, true)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        chains = _chains()

        def out(u: np.ndarray, v: np.ndarray, late: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(np.full(len(u), late))], names=["u", "v", "late"])

        going_on = None
        for whole, at in buckets.runs(batches, "key"):
            key = whole.column("key").to_numpy(zero_copy_only=False)
            fp = whole.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            size = np.diff(at)
            first = at[:-1]
            pair = first[(size == 2) & (key[first] != (going_on if going_on is not None else key[first] + 1))]
            x = fp[pair] ^ fp[pair + 1]
            ok = close(x, key[pair] & 7, chains)
            u, v = [fp[pair + 1][ok]], [fp[pair][ok]]
            for a, n in zip(first.tolist(), size.tolist()):
                if key[a] == going_on or n > buckets.BLOCK:
                    yield out(key[a : a + n], fp[a : a + n], True)
                    going_on = key[a]
                elif n > 2:
                    own, start = fp[a : a + n], int(key[a] & 7)
                    label = buckets.spread(n, lambda p, q: close(own[p][:, None] ^ own[q][None], start, chains).any(axis=0))
                    moved = label != np.arange(n)
                    u.append(own[moved])
                    v.append(own[label[moved]])
            yield out(np.concatenate(u), np.concatenate(v), False)

    return keyed.mapInArrow(link, "u long, v long, late boolean")


def late_links(late: DataFrame, block: int = buckets.BLOCK) -> DataFrame:
    """u, v for the rows (key, fp) of large buckets, block against block."""

    def link(table: pa.Table) -> pa.Table:
        import numpy as np

        own = np.unique(table.column("fp").to_numpy()).view(np.uint64)
        start = int(table.column("key")[0].as_py() & 7)
        chains = _chains()
        label = buckets.spread(len(own), lambda p, q: close(own[p][:, None] ^ own[q][None], start, chains).any(axis=0))
        moved = label != np.arange(len(own))
        return pa.table({"u": own[moved].view(np.int64), "v": own[label[moved]].view(np.int64)})

    return buckets.large_links(late, "fp", block, link)


def dealt(fps: DataFrame) -> DataFrame:
    """The distinct ``fp`` in as many partitions as shuffles have: 64 keys are made of each, and adaptive execution sees only the few bytes before that.

    By a hash of it, since the planner removes a repartition by the columns that distinct() has dealt by already.
    """
    return fps.select("fp").distinct().repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))


def near_classes(fps: DataFrame) -> DataFrame:
    """fp, root for each distinct fingerprint of ``fps`` (fp) that is linked with a lesser one."""
    keyed = keys(dealt(fps)).repartition("key").sortWithinPartitions("key")
    found = _shared.stored(links(keyed), "links")
    edges = found.where("not late").select("u", "v")
    late = found.where("late").select(F.col("u").alias("key"), F.col("v").alias("fp"))
    if late.take(1):
        edges = edges.unionByName(late_links(_shared.stored(late, "late")))
    return components.components(edges).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id of the class) for every document."""
    fps = _shared.stored(fingerprints(docs, shingle), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(near_classes(fps), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Stored, since adaptive execution splits a hot class only where both sides come straight from a shuffle.
    classes = _shared.stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "classes")
    return fps.join(rooted.join(classes, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_shared.documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
