"""Fuzzy line dedup: MinHash bands, exact Jaccard verification and union-find; one line per component stays.

Lines are compared by the set of their eight-character shingles, lower-cased and with white space
collapsed. One-permutation MinHash signatures (densified by rotation) in nine bands of four find candidates:
a pair at the threshold shares a band with probability 0.99. Lines that share a band are
verified by exact Jaccard similarity of at least 0.8; verified links form components, and of all
occurrences of a component's lines the first, by doc_id and line number, stays. Equal lines are
one node, so they never become pairs. Buckets of over BLOCK lines are compared block by block.
Line identity is a 64-bit hash of the normalised line: of 10 billion distinct lines about 3 pairs share one.

Cases: null text has no lines and stays null; blank lines and lines without a letter or digit stay; documents whose
every line goes lose their row only where ``drop_emptied``; of a row that repeats with its id and text one keeps
what is first there, and the others lose all their lines; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared, buckets, components

SHINGLE = 8
BANDS, ROWS = 9, 4
SIMILARITY = 0.8
BLOCK = 1024
#: Cells of the table of lines by shingles that a task may hold; beyond, lines are compared set by set.
DENSE_CELLS = 8_000_000
CHUNK = 1 << 20
#: Bytes of text that a task compares at once; larger buckets are compared block by block.
BUCKET_BYTES = 2 << 20
#: Characters that are hashed at once: the arrays made of them stay in the processor's cache.
PART = 1 << 15
#: Lines that a task remembers, so that it gives each once; beyond, it may give some again.
SEEN = 2_000_000

#: Texts to (text index, 64-bit hash) of every shingle.
Split = Callable[[list[str]], tuple["np.ndarray", "np.ndarray"]]


def normal(line: str) -> str:
    """The line as compared; empty if it has no letter or digit."""
    out = " ".join(line.lower().split())
    return out if any(c.isalnum() for c in out) else ""


def shingles(lines: list[str], size: int = SHINGLE) -> tuple["np.ndarray", "np.ndarray"]:
    """(line index, 64-bit hash) of every shingle; a shorter line is one shingle."""
    import numpy as np

    padded = [x if len(x) >= size else x + "\0" * (size - len(x)) for x in lines]
    data = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    h, k, n = (data + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15), 1
    while n < size:
        h = h[: len(h) - n] * k + h[n:]
        with np.errstate(over="ignore"):
            k = k * k
        n *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    line = np.repeat(np.arange(len(padded)), sizes)[: len(h)]
    ends = np.cumsum(sizes)
    good = np.arange(len(h)) + size <= ends[line] if len(h) else np.zeros(0, bool)
    return line[good], h[good]


def band_keys(lines: list[str], bands: int = BANDS, rows: int = ROWS) -> "np.ndarray":
    """The keys of each line's bands, one column per band."""
    import numpy as np

    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    cuts = np.flatnonzero(np.diff(ends // PART, prepend=0, append=-1)).tolist()
    return np.concatenate([_band_keys(lines[a:b], bands, rows) for a, b in zip([0, *cuts], cuts) if a < b] or [np.zeros((0, bands), np.uint64)])


def _band_keys(lines: list[str], bands: int, rows: int) -> "np.ndarray":
    import numpy as np

    bins = bands * rows
    line, h = shingles(lines)
    empty = np.uint64((1 << 64) - 1)
    low = np.full(len(lines) * bins, empty)
    np.minimum.at(low, line * bins + ((h >> np.uint64(40)) % np.uint64(bins)).astype(np.int64), h & np.uint64((1 << 40) - 1))
    low = low.reshape(len(lines), bins)
    filled, gap = low.copy(), low == empty
    step = 0
    while gap.any() and step < bins:
        step += 1
        other = np.roll(low, -step, axis=1)
        use = gap & (other != empty)
        filled[use] = other[use] + np.uint64(step << 40)
        gap &= ~use
    keys = np.zeros((len(lines), bands), np.uint64)
    for r in range(rows):
        keys = (keys ^ filled[:, r::rows]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    keys = (keys + np.arange(bands, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(31))


def _identify(lines: list[str]) -> "np.ndarray":
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in lines], np.uint64).view(np.int64)


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    """The normalised lines of each batch that this task has not had before."""
    seen: set[int] = set()
    for batch in _shared.by_bytes(batches, "text", CHUNK):
        new: dict[int, str] = {}
        for text in batch.column("text").to_pylist():
            for line in (text or "").split("\n"):
                line = normal(line)
                if line and (h := hash(line)) not in seen and h not in new:
                    new[h] = line
        if len(seen) > SEEN:
            seen.clear()
        seen.update(new)
        # A very long text comes in parts of about CHUNK characters, as the arrays made of them are many times their size.
        part, held = [], 0
        for line in new.values():
            if held and held + len(line) > CHUNK:
                yield part
                part, held = [], 0
            part.append(line)
            held += len(line)
        if part:
            yield part


def banded(rows: DataFrame) -> DataFrame:
    """key, lid: each distinct line's band keys; a line comes once from each task that has it."""
    return rows.select(F.explode("keys").alias("key"), "lid")


def candidates(keyed: DataFrame) -> DataFrame:
    """key, lid of the buckets with two lines or more; buckets with the same lines have the same key."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        going_on = None
        for whole, at in buckets.runs(batches, "key"):
            key = whole.column("key").to_numpy(zero_copy_only=False)
            lid = whole.column("lid").to_numpy(zero_copy_only=False)
            new = np.ones(len(lid), bool)
            new[1:] = (lid[1:] != lid[:-1]) | (key[1:] != key[:-1])
            key, lid = key[new], lid[new]
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            sizes = np.diff(edges)
            # Told by all rows: of a run that goes on, a batch may hold few lines, each from many tasks.
            large = np.diff(at) > buckets.BLOCK
            keys, lids = [], []
            pair = edges[:-1][(sizes == 2) & ~large & (key[edges[:-1]] != (going_on if going_on is not None else key[edges[:-1]] + 1))]
            a, b = lid[pair].view(np.uint64), lid[pair + 1].view(np.uint64)
            both = ((a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
            keys += [both, both]
            lids += [lid[pair], lid[pair + 1]]
            for i in np.flatnonzero((sizes > 2) | large | (key[edges[:-1]] == going_on)).tolist():
                own = lid[edges[i] : edges[i + 1]]
                if key[edges[i]] == going_on or large[i]:
                    going_on = key[edges[i]]
                    name = going_on  # a part of a bucket keeps the bucket's key
                else:
                    name = np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64)
                keys.append(np.full(len(own), name))
                lids.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(lids))], names=["key", "lid"])

    return keyed.repartition("key").sortWithinPartitions("key", "lid").mapInArrow(_shared.lean(emit, "near"), "key long, lid long").distinct()


def lines_of(docs: DataFrame) -> DataFrame:
    """lid, line: the distinct lines, once from each task that has them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _fresh(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_identify(lines)), pa.array(lines)], names=["lid", "line"])

    return docs.select("text").mapInArrow(_shared.lean(emit), "lid long, line string")


def _similar(lines: list[str], least: float, split: Split = shingles) -> Callable[["np.ndarray", "np.ndarray"], "np.ndarray"]:
    """Exact Jaccard of shingle sets, as ``buckets.spread`` asks for it."""
    import numpy as np

    line, h = split(lines)
    terms, column = np.unique(h, return_inverse=True)
    width, everywhere, size = len(terms), 0, None
    if len(lines) * width > DENSE_CELLS:
        cell = np.unique(line * width + column)
        line, column = cell // width, cell % width
        size = np.bincount(line, minlength=len(lines)).astype(np.float32)
        holders = np.bincount(column, minlength=width)
        # Terms of one line match nothing and terms of all lines match everywhere, so neither needs a column.
        told = (holders > 1) & (holders < len(lines))
        everywhere, width = int(np.count_nonzero(holders == len(lines))), int(np.count_nonzero(told))
    if len(lines) * width <= DENSE_CELLS:
        if size is not None:
            place, own = np.cumsum(told) - 1, told[column]
            line, column = line[own], place[column[own]]
        held = np.zeros((len(lines), width), np.float32)
        held[line, column] = 1
        size = held.sum(axis=1) if size is None else size

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            common = held[a] @ held[b].T + everywhere
            return (common >= least * (size[a][:, None] + size[b][None] - common) - 1e-4).any(axis=0)
    else:
        cuts = np.searchsorted(line, np.arange(len(lines) + 1))
        sets = [column[x:y] for x, y in zip(cuts[:-1], cuts[1:])]

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            def pair(x: int, y: int) -> bool:
                s, t = sets[x], sets[y]
                if min(len(s), len(t)) < least * max(len(s), len(t)):
                    return False
                common = len(np.intersect1d(s, t, assume_unique=True))
                return common >= least * (len(s) + len(t) - common) - 1e-9

            return np.array([any(pair(x, y) for x in a) for y in b])

    return linked


def _forest(lid: "np.ndarray", lines: list[str], least: float, split: Split = shingles) -> tuple["np.ndarray", "np.ndarray"]:
    import numpy as np

    label = buckets.spread(len(lid), _similar(lines, least, split))
    moved = label != np.arange(len(lid))
    return lid[moved], lid[label[moved]]


def verified(found: DataFrame, least: float = SIMILARITY, split: Split = shingles) -> DataFrame:
    """u, v, late, line: forest edges of each bucket (key, lid, line); buckets over BLOCK or BUCKET_BYTES go on as (key, lid, true, line)."""
    block = BLOCK

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        names, going_on = ["u", "v", "late", "line"], None
        for whole, at in buckets.runs(batches, "key"):
            key = whole.column("key").to_numpy(zero_copy_only=False)
            lid = whole.column("lid").to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(whole.column("line")).to_numpy(zero_copy_only=False), dtype=np.int64)])
            us, vs = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if key[a] == going_on or b - a > block or (b - a > 2 and ends[b] - ends[a] > BUCKET_BYTES):
                    going_on = key[a]
                    yield pa.RecordBatch.from_arrays([pa.array(key[a:b]), pa.array(lid[a:b]), pa.array([True] * (b - a)), whole.column("line").slice(a, b - a)], names=names)
                elif b - a > 1:
                    u, v = _forest(lid[a:b], whole.column("line").slice(a, b - a).to_pylist(), least, split)
                    us.append(u)
                    vs.append(v)
            if us:
                u, v = np.concatenate(us), np.concatenate(vs)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array([False] * len(u), pa.bool_()), pa.nulls(len(u), pa.string())], names=names)

    return found.repartition("key").sortWithinPartitions("key", "lid").mapInArrow(_shared.lean(emit, "near"), "u long, v long, late boolean, line string")


def late_links(late: DataFrame, least: float = SIMILARITY, block: int = BLOCK, split: Split = shingles) -> DataFrame:
    """u, v for the rows (key, lid, line) of large buckets, block against block."""

    def link(table: pa.Table) -> pa.Table:
        import numpy as np

        lid, first = np.unique(table.column("lid").to_numpy(), return_index=True)
        u, v = _forest(lid, table.column("line").take(pa.array(first)).to_pylist(), least, split)
        return pa.table({"u": u, "v": v})

    return buckets.large_links(late, "lid", block, link, F.sum(F.octet_length("line")) / BUCKET_BYTES)


def line_classes(docs: DataFrame, rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """lid, root for each line that is linked with a lesser one; ``rows`` are the occurrences in ``docs``."""
    found = _shared.stored(candidates(banded(rows)), "candidates")
    needed = found.select("lid").distinct()
    texts = lines_of(docs).join(needed, "lid", "left_semi").dropDuplicates(["lid"])
    links = _shared.stored(verified(found.join(texts, "lid"), least), "links")
    edges = links.where("not late").select("u", "v")
    late = links.where("late").select(F.col("u").alias("key"), F.col("v").alias("lid"), "line")
    if late.take(1):
        edges = edges.unionByName(late_links(_shared.stored(late, "late"), least))
    return components.components(edges).withColumnRenamed("node", "lid")


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, part, at, lid, head, keys: every line with its number in its document; a repeated row gives the same rows again.

    ``head`` marks a document's first line here. The line's band keys come with its first occurrence in a task; ``keys`` is empty at others.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        seen: set[int] = set()
        for batch in _shared.by_bytes(batches, "text", CHUNK):
            row, at, lines = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for j, line in enumerate((text or "").split("\n")):
                    if line := normal(line):
                        row.append(i)
                        at.append(j)
                        lines.append(line)
            if not lines:
                continue
            lid = _identify(lines)
            if len(seen) > SEEN:
                seen.clear()
            new = [k for k, x in enumerate(lid.tolist()) if not (x in seen or seen.add(x))]
            ends = np.zeros(len(lines) + 1, np.int32)
            ends[np.array(new, np.int64) + 1] = BANDS
            keys = band_keys([lines[k] for k in new]).ravel() if new else np.zeros(0, np.uint64)
            keys = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.view(np.int64)))
            rows = np.array(row, np.int64)
            head = np.concatenate([[True], rows[1:] != rows[:-1]])
            take = pa.array(rows)
            cells = [batch.column("doc_id").take(take), batch.column("part").take(take), pa.array(at, pa.int32()), pa.array(lid), pa.array(head), keys]
            yield pa.RecordBatch.from_arrays(cells, names=["doc_id", "part", "at", "lid", "head", "keys"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("part"), "text")
    return rows.mapInArrow(_shared.lean(emit), "doc_id long, part long, at int, lid long, head boolean, keys array<long>")


def removals(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(_id, _part, _gone: the numbers of the lines to remove from each document that loses lines; _id, _part, _all: the numbers of all lines of repeated rows)."""
    place = F.struct("doc_id", "part", "at")
    rows = _shared.stored(occurrences(docs), "lines")
    rooted = rows.drop("keys", "head").join(line_classes(docs, rows, least), "lid", "left").select("doc_id", "part", "at", F.coalesce("root", "lid").alias("root"))
    rooted = _shared.stored(rooted, "occurrences")
    # Stored, since adaptive execution splits a hot line only where both sides come straight from a shuffle.
    firsts = _shared.stored(rooted.groupBy("root").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"), "firsts")
    gone = rooted.join(firsts, "root").where(~place.eqNullSafe(F.col("first")))
    listed = lambda frame, name: frame.groupBy(F.col("doc_id").alias("_id"), F.col("part").alias("_part")).agg(F.collect_set("at").alias(name))
    again = _shared.stored(rows.where("head").groupBy("doc_id", "part").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_i"), F.col("part").alias("_p")), "again")
    every = rows.select("doc_id", "part", "at").join(again, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("part") == F.col("_p")), "left_semi")
    return listed(gone, "_gone"), _shared.stored(listed(every, "_all"), "every")


def _same(frame: DataFrame) -> Column:
    """Whether the row of documents (_key, _hash) is that of ``frame`` (_id, _part)."""
    return F.col("_key").eqNullSafe(frame["_id"]) & (F.col("_hash") == frame["_part"])


def _copies(joined: DataFrame, every: DataFrame) -> DataFrame:
    """``joined``, with all lines of a repeated row in _gone but in one of the copies."""
    if not every.take(1):
        return joined
    held = _shared.stored(joined.join(every, _same(every)).drop("_id", "_part").withColumn("_row", F.monotonically_increasing_id()), "copies")
    firsts = _shared.stored(held.groupBy(F.col("_key").alias("_id"), F.col("_hash").alias("_part")).agg(F.min("_row").alias("_first")), "first_copies")
    marked = held.join(firsts, _same(firsts)).withColumn("_gone", F.when(F.col("_row") == F.col("_first"), F.col("_gone")).otherwise(F.col("_all")))
    return joined.join(every, _same(every), "left_anti").unionByName(marked.select(*joined.columns))


def dedup_lines(docs: DataFrame, least: float = SIMILARITY, drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the lines removed from ``text``, and n_lines, n_removed."""
    gone, every = removals(docs, least)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = docs.select(*names, F.col("doc_id").cast("long").alias("_key"), F.xxhash64("text").alias("_hash"))
    joined = _copies(keyed.join(gone, _same(gone), "left").drop("_id", "_part"), every)
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(F.transform(lines, lambda line, i: F.when(~F.array_contains("_gone", i), line)), lambda x: x.isNotNull()), "\n")
    out = joined.withColumns({
        "_new": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept),
        "_n": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        "_r": F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long"),
    })
    if drop_emptied:
        out = out.where((F.col("_r") == 0) | F.col("_new").rlike(r"[\p{L}\p{N}]"))
    return out.select(*(F.col("_new").alias("text") if c == "text" else F.col(c) for c in names), F.col("_n").alias("n_lines"), F.col("_r").alias("n_removed"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_shared.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(_shared.whole_text(), 256).alias("kept_sha256"))
