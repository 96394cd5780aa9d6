"""Repeated substrings of LEAST bytes or more, found with suffix arrays and longest-previous-factor arrays.

A global suffix array does not distribute, so windows are first dealt by content: a window's
anchor is the least of the hashes of its 32-byte grams, and equal windows have equal anchors.
Consecutive windows with one anchor make a segment; anchors that occur once are dropped, segments
that occur whole more than once are settled by counting, and one copy of each distinct segment
goes to the bucket of its anchor. There the suffixes at window starts are sorted by their first LEAST
bytes; previous and next smaller positions in suffix order give each window's nearest earlier match, so
later copies can be removed and the first kept, or, as the registered query asks, all of them.
A bucket of over BLOCK distinct segments is settled by counting its single windows.

Texts are bytes in UTF-8 and matches lie within one document. Segments and windows that are settled by counting are
told apart by two independent 64-bit hashes, of the anchor and of the bytes: of 10^12 distinct ones a pair shares
both with a probability of 0.002. Cases: null text is empty; texts
shorter than LEAST lose nothing; repeated rows are documents of their own and so repeat each other;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared, buckets

LEAST = 200
GRAM = 32
CHUNK = 1 << 18
#: Windows of a text that are taken at once; a longer text is read in parts that overlap by a window.
PART = 1 << 22
POSITION = (1 << 24) - 1
SEGMENT = "core long, same long, doc_id long, part long, place long"


def grams(data: "np.ndarray", width: int = GRAM) -> "np.ndarray":
    """A 64-bit hash of each run of ``width`` (a power of two) bytes."""
    import numpy as np

    table = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
    h, k, n = table[data], np.uint64(0x9E3779B97F4A7C15), 1
    while n < width:
        h = h[: len(h) - n] * k + h[n:]
        with np.errstate(over="ignore"):
            k = k * k
        n *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def segments(data: "np.ndarray", ends: "np.ndarray", least: int = LEAST) -> tuple["np.ndarray", "np.ndarray", "np.ndarray"]:
    """(start, windows, anchor hash) of the segments of concatenated documents that end at ``ends``."""
    import numpy as np

    if len(data) < least:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    h = grams(data)
    span = least - GRAM + 1
    low = (h & ~np.uint64(POSITION)) | np.arange(len(h), dtype=np.uint64)
    n = 1
    while 2 * n <= span:
        low = np.minimum(low[: len(low) - n], low[n:])
        n *= 2
    low = np.minimum(low[: len(low) - (span - n)], low[span - n :])
    anchor = (low & np.uint64(POSITION)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    good = np.zeros(len(anchor) + 1, np.int64)
    real = ends - starts >= least
    np.add.at(good, starts[real], 1)
    np.add.at(good, ends[real] - least + 1, -1)
    good = np.cumsum(good[:-1]) > 0
    new = good.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~good[:-1]
    # Adjacent documents can't share an anchor: windows across their border are not good.
    first = np.flatnonzero(new)
    stop = np.flatnonzero(good & ~np.concatenate([good[1:] & ~new[1:], [False]])) + 1
    return first, stop - first, h[anchor[first]]


def split(docs: DataFrame, least: int = LEAST, part: int = PART) -> DataFrame:
    """A row per segment: core (anchor), same (hash of its bytes), doc_id, part, place (start * 256 + windows)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for batch in _shared.by_bytes(batches, "text", CHUNK):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            whole = [(k, a) for k, t in enumerate(texts) for a in range(0, max(1, len(t) - least + 1), part)]
            pieces = [texts[k][a : a + part + least - 1] for k, a in whole]
            owner, base = (np.array(x, np.int64) for x in zip(*whole))
            for i, j in _chunks(pieces):
                raw = b"".join(pieces[i:j])
                ends = np.cumsum([len(t) for t in pieces[i:j]])
                start, n, core = segments(np.frombuffer(raw, np.uint8), ends, least)
                same = np.array([digest(raw[a : a + k + least - 1]) for a, k in zip(start.tolist(), n.tolist())], np.uint64)
                row = np.searchsorted(ends, start, side="right")
                inner = start - np.concatenate([[0], ends[:-1]])[row] + base[i + row]
                take = pa.array(owner[i + row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core.view(np.int64)), pa.array(same.view(np.int64)), batch.column("doc_id").take(take), batch.column("part").take(take), pa.array(inner * 256 + n)],
                    names=["core", "same", "doc_id", "part", "place"],
                )

    return docs.mapInArrow(emit, SEGMENT)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts with together fewer bytes than places have bits for."""
    i, held = 0, 0
    for j, t in enumerate(texts):
        if j > i and held + len(t) > POSITION:
            yield i, j
            i, held = j, 0
        held += len(t)
    if i < len(texts):
        yield i, len(texts)


def dense(keys: "np.ndarray") -> "np.ndarray":
    import numpy as np

    order = np.argsort(keys, kind="stable")
    out = np.empty(len(keys), np.int64)
    sorted_ = keys[order]
    out[order] = np.cumsum(np.concatenate([[0], (sorted_[1:] != sorted_[:-1]).astype(np.int64)]))
    return out


def prefix_ranks(data: "np.ndarray", starts: "np.ndarray", depth: int) -> "np.ndarray":
    """The rank of each suffix at ``starts`` by its first ``depth`` bytes (all within data), by prefix doubling."""
    import numpy as np

    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    have = min(8, depth)
    for i in range(have):
        key |= padded[i : i + len(data)] << np.uint64(8 * (7 - i))
    rank = dense(key)
    while 2 * have <= depth:
        after = np.concatenate([rank[have:], np.zeros(have, np.int64)])
        rank = dense(rank * (len(data) + 1) + after)
        have *= 2
    return dense(rank[starts] * (len(data) + 1) + rank[starts + depth - have])


def nearest_smaller(values: "np.ndarray") -> "np.ndarray":
    """For each place the nearest place before it with a smaller value, or -1, by pointer jumping."""
    import numpy as np

    ext = np.concatenate([values, [values.min() - 1 if len(values) else 0]])
    at = np.arange(len(values)) - 1
    todo = np.flatnonzero(ext[at] >= values)
    while len(todo):
        at[todo] = at[at[todo]]
        todo = todo[ext[at[todo]] >= values[todo]]
    return at


def earlier_match(data: "np.ndarray", starts: "np.ndarray", depth: int) -> "np.ndarray":
    """For each of ``starts`` (ascending) an earlier one with the same first ``depth`` bytes, as an index into them, or -1.

    The longest previous factor at a suffix is its match with the previous or the next smaller position
    in suffix order, whichever is longer; cut off at ``depth``, a match is as long as asked iff ranks agree.
    """
    import numpy as np

    rank = prefix_ranks(data, starts, depth)
    order = np.argsort(rank, kind="stable")
    # Positions in suffix order; ranks are put in blocks so that no match leaves its block.
    before = nearest_smaller(order)
    back = nearest_smaller(order[::-1])[::-1]
    after = np.where(back >= 0, len(order) - 1 - back, -1)
    found = np.full(len(starts), -1)
    for side in (before, after):
        fit = (side >= 0) & (rank[order[side]] == rank[order])
        found[order[fit]] = np.maximum(found[order[fit]], order[side[fit]])
    return found


def matches(bytes_of: DataFrame, keep_first: bool, least: int = LEAST) -> DataFrame:
    """Repeated windows among the distinct segments of each anchor: core, same, doc_id, part, place, late.

    ``bytes_of``: core, doc_id, part, place, seg, sorted by core, doc_id, part and place in each
    partition. Buckets of over BLOCK segments go on as their single windows (late).
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        digest, names = xxhash.xxh3_64_intdigest, ["core", "same", "doc_id", "part", "place", "late"]
        going_on = None

        def rows(part: pa.RecordBatch, row: np.ndarray, first: np.ndarray, n: np.ndarray, same: np.ndarray, late: bool) -> pa.RecordBatch:
            take = pa.array(row)
            base = part.column("place").to_numpy(zero_copy_only=False)[row] // 256
            cells = [part.column("core").take(take), pa.array(same), part.column("doc_id").take(take), part.column("part").take(take), pa.array((base + first) * 256 + n)]
            return pa.RecordBatch.from_arrays([*cells, pa.array(np.full(len(row), late))], names=names)

        for whole, at in buckets.runs(batches, "core"):
            core = whole.column("core").to_numpy(zero_copy_only=False)
            a = 0
            while a < len(at) - 1:
                b = a + 1
                size = int(at[b] - at[a])
                if core[at[a]] == going_on or size > buckets.BLOCK:
                    going_on = core[at[a]]
                    part = whole.slice(int(at[a]), size)
                    for row, (seg, place) in enumerate(zip(part.column("seg").to_pylist(), part.column("place").to_pylist())):
                        n = place % 256
                        same = np.array([digest(seg[i : i + least]) for i in range(n)], np.uint64).view(np.int64)
                        yield rows(part, np.full(n, row), np.arange(n), np.ones(n, np.int64), same, True)
                    a = b
                    continue
                while b < len(at) - 1 and at[b + 1] - at[a] <= buckets.BLOCK:
                    b += 1
                part = whole.slice(int(at[a]), int(at[b] - at[a]))
                a = b
                segs = part.column("seg").to_pylist()
                raw = b"".join(segs)
                sizes = np.fromiter(map(len, segs), np.int64, len(segs))
                begin = np.cumsum(sizes) - sizes
                n = part.column("place").to_numpy(zero_copy_only=False) % 256
                row = np.repeat(np.arange(len(segs)), n)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                found = earlier_match(np.frombuffer(raw, np.uint8), begin[row] + inner, least)
                marked = found >= 0
                if not keep_first:
                    marked[found[marked]] = True
                new = marked.copy()
                new[1:] &= ~marked[:-1] | (row[1:] != row[:-1])
                last = marked.copy()
                last[:-1] &= ~marked[1:] | (row[1:] != row[:-1])
                first, stop = np.flatnonzero(new), np.flatnonzero(last)
                yield rows(part, row[first], inner[first], stop - first + 1, np.zeros(len(first), np.int64), False)

    return bytes_of.mapInArrow(find, f"{SEGMENT}, late boolean")


def _repeats(rows: DataFrame, keep_first: bool) -> tuple[DataFrame, DataFrame]:
    """(rows whose bytes occur more than once, a row per distinct bytes with n occurrences)."""
    place = F.struct("doc_id", "part", "place")
    distinct = _shared.stored(rows.groupBy("core", "same").agg(F.count("*").alias("n"), F.min(place).alias("first")), "distinct")
    many = distinct.where("n > 1")
    dups = rows.join(many, ["core", "same"])
    if keep_first:
        dups = dups.where(~place.eqNullSafe(F.col("first")))
    return dups.select("doc_id", "part", "place"), distinct


def repeated_windows(docs: DataFrame, small: DataFrame, keep_first: bool = False, least: int = LEAST) -> DataFrame:
    """doc_id, part, places (a list of start * 256 + windows) for each document with repeated windows.

    ``docs``: doc_id, part, text; ``small``: doc_id, part, packed, the text compressed for the shuffle.
    """
    all_rows = _shared.stored(split(docs, least), "segments")
    # Stored, since adaptive execution splits a hot key only where both sides come straight from a shuffle.
    again = _shared.stored(all_rows.groupBy("core").agg(F.count("*").alias("_n")).where("_n > 1").select("core"), "again")
    rows = _shared.stored(all_rows.join(again, "core", "left_semi"), "repeated")
    dups, distinct = _repeats(rows, keep_first)
    open_ = distinct.join(distinct.groupBy("core").agg(F.count("*").alias("_n")).where("_n > 1").select("core"), "core", "left_semi")
    wanted = open_.select("core", "first.*").groupBy("doc_id", "part").agg(F.collect_list(F.struct("core", "place")).alias("wanted"))
    carried = small.select(F.col("doc_id").alias("_id"), F.col("part").alias("_part"), "packed")
    held = wanted.join(carried, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part"))).dropDuplicates(["doc_id", "part"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.select(["doc_id", "part", "wanted", "packed"]).to_pylist():
                raw = unpack.decompress(row["packed"])
                places = [w["place"] for w in row["wanted"]]
                k = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["core"] for w in row["wanted"]], pa.int64()), pa.array([row["doc_id"]] * k, pa.int64()), pa.array([row["part"]] * k, pa.int64()), pa.array(places, pa.int64()), pa.array([raw[p // 256 : p // 256 + p % 256 + least - 1] for p in places], pa.binary())],
                    names=["core", "doc_id", "part", "place", "seg"],
                )

    segs = held.select("doc_id", "part", "wanted", "packed").mapInArrow(cut, "core long, doc_id long, part long, place long, seg binary")
    segs = segs.repartition("core").sortWithinPartitions("core", "doc_id", "part", "place")
    found = _shared.stored(matches(segs, keep_first, least), "matches")
    late, _ = _repeats(found.where("late"), keep_first)
    places = dups.unionByName(found.where("not late").select("doc_id", "part", "place")).unionByName(late)
    return places.groupBy("doc_id", "part").agg(F.collect_set("place").alias("places"))


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<first:long,stop:long>>, kept binary"


def packed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, part, packed) and (doc_id, part, text); part tells rows with one doc_id and several texts apart."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in _shared.by_bytes(batches, "text"):
            small = pa.array([pack.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), small], names=["doc_id", "part", "packed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("part"), "text")
    return rows.mapInArrow(emit, "doc_id long, part long, packed binary"), rows


def remove_repeats(docs: DataFrame, keep_first: bool = True, least: int = LEAST, with_kept: bool = True) -> DataFrame:
    """Every document without its repeated bytes: n_bytes, n_removed, n_spans, kept_sha256, spans, kept."""
    small, rows = packed(docs)
    places = repeated_windows(rows, small, keep_first, least)
    places = places.select(F.col("doc_id").alias("_id"), F.col("part").alias("_part"), "places")
    joined = small.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for row in batch.to_pylist():
                raw = unpack.decompress(row["packed"])
                spans: list[list[int]] = []
                for p in sorted(row["places"] or ()):
                    first, stop = p // 256, p // 256 + p % 256 + least - 1
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], stop)
                    else:
                        spans.append([first, stop])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                cells = (row["doc_id"], len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"first": a, "stop": b} for a, b in spans] if with_kept else None, kept if with_kept else None)
                for column, cell in zip(out, cells):
                    column.append(cell)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return joined.select("doc_id", "part", "packed", "places").mapInArrow(cut, OUT)


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_shared.documents(spark, sf_dir), keep_first=False, with_kept=False)
    return found.drop("spans", "kept")
