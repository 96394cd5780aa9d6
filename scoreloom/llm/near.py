"""Near-duplicate classes of documents by SimHash fingerprints and by exact Jaccard similarity of five-word shingles.

Texts are split at ASCII white space with A-Z lower-cased. Fingerprints that differ in at most four bits link their
texts, by pigeonring filtering as in ``simhash``. Most pairs at a similarity of 0.8 are further apart than that in
bits, so texts are also linked by the sets of their shingles: MinHash
signatures of independent permutations in sixteen bands of four find candidates: a pair at the threshold shares
a band with probability 0.9997. Texts that share a band are verified by exact similarity; verified links form
components. Equal word sequences are one node, so they never become pairs. Buckets with many or long texts
are compared block by block. Texts are told apart by a 64-bit hash of their words.

Cases: texts without words (null, empty) are equal to each other; a text of under five words is one shingle;
repeated rows each get a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared, components, lines, simhash

SHINGLE = 5
BANDS, ROWS = 16, 4
SIMILARITY = 0.8
SEED = 42
CHUNK = 1 << 20
#: Words whose hashes a task remembers.
KNOWN = 100_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


def words_of(text: str | None) -> list[bytes]:
    """The words as compared; only A-Z change case."""
    return (text or "").encode().lower().split()


def shingles(texts: list[str], size: int = SHINGLE) -> tuple["np.ndarray", "np.ndarray"]:
    """(text index, 64-bit hash) of every shingle of words; a shorter text is one shingle."""
    return _shingles([words_of(t) for t in texts], size)


def _shingles(texts: list[list[bytes]], size: int = SHINGLE) -> tuple["np.ndarray", "np.ndarray"]:
    import numpy as np

    lengths = np.fromiter((max(len(w), size) for w in texts), np.int64, len(texts))
    data = np.zeros(int(lengths.sum()), np.uint64)
    hashes = _shared.kept("near", _Hashes)
    at = 0
    for words, n in zip(texts, lengths.tolist()):
        data[at : at + len(words)] = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        at += n
    n = max(0, len(data) - size + 1)
    h = data[:n].copy()
    for j in range(1, size):
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h += data[j : j + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    text = np.repeat(np.arange(len(texts)), lengths)[:n]
    good = np.arange(n) + size <= np.cumsum(lengths)[text]
    return text[good], h[good]


def band_keys(texts: list[list[bytes]], bands: int = BANDS, rows: int = ROWS) -> "np.ndarray":
    """The keys of each text's bands, one column per band."""
    import numpy as np

    text, h = _shingles(texts)
    starts = np.searchsorted(text, np.arange(len(texts)))
    low, high = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    salts = np.random.default_rng(SEED).integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
    keys = np.zeros((len(texts), bands), np.uint64)
    for i, salt in enumerate(salts):
        least = np.minimum.reduceat(low * salt + high, starts).astype(np.uint64)
        own = (keys[:, i // rows] ^ (least + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        keys[:, i // rows] = own ^ (own >> np.uint64(29))
    keys = (keys + np.arange(bands, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(31))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, part, lid, keys, fp: the hash of the document's text, that of its words, their band keys and fingerprint.

    The keys and the fingerprint come with the first document of those words in a task; at others ``keys`` is empty and ``fp`` null.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        seen: set[int] = set()
        for batch in _shared.by_bytes(batches, "text", CHUNK):
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            lid = np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) for w in texts], np.uint64).view(np.int64)
            if len(seen) > lines.SEEN:
                seen.clear()
            new = [k for k, x in enumerate(lid.tolist()) if not (x in seen or seen.add(x))]
            ends = np.zeros(len(texts) + 1, np.int32)
            ends[np.array(new, np.int64) + 1] = BANDS
            keys = band_keys([texts[k] for k in new]).ravel() if new else np.zeros(0, np.uint64)
            keys = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.view(np.int64)))
            fps = np.zeros(len(texts), np.uint64)
            fps[new] = [simhash.fingerprint(b" ".join(texts[k])) for k in new]
            others = np.ones(len(texts), bool)
            others[new] = False
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(lid), keys, pa.array(fps.view(np.int64), mask=others)], names=["doc_id", "part", "lid", "keys", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_shared.whole_text()).alias("part"), "text")
    return rows.mapInArrow(_shared.lean(emit, "near"), "doc_id long, part long, lid long, keys array<long>, fp long")


def fingerprint_links(rows: DataFrame) -> DataFrame:
    """u, v: each text of a class of fingerprints with the least of them."""
    fps = _shared.stored(rows.where("fp is not null").select("lid", "fp").distinct(), "fingerprints")
    named = fps.join(simhash.near_classes(fps), "fp", "left").select("lid", F.coalesce("root", "fp").alias("root"))
    named = _shared.stored(named, "named")
    least = _shared.stored(named.groupBy("root").agg(F.min("lid").alias("v")), "least")
    return named.join(least, "root").select(F.col("lid").alias("u"), "v").where("u <> v")


def near_classes(docs: DataFrame, rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """lid, root for each text that is linked with a lesser one; ``rows`` are the signatures of ``docs``."""
    found = _shared.stored(lines.candidates(lines.banded(rows)), "candidates")
    needed = rows.join(found.select("lid").distinct(), "lid", "left_semi").groupBy("lid").agg(F.min("part").alias("part"))
    texts = docs.select(F.xxhash64(_shared.whole_text()).alias("part"), _shared.whole_text().alias("line")).join(needed, "part")
    links = _shared.stored(lines.verified(found.join(texts.dropDuplicates(["lid"]).drop("part"), "lid"), least, shingles), "links")
    edges = links.where("not late").select("u", "v").unionByName(fingerprint_links(rows))
    late = links.where("late").select(F.col("u").alias("key"), F.col("v").alias("lid"), "line")
    if late.take(1):
        edges = edges.unionByName(lines.late_links(_shared.stored(late, "late"), least, split=shingles))
    return components.components(edges).withColumnRenamed("node", "lid")


def _rooted(docs: DataFrame, rows: DataFrame, least: Column) -> DataFrame:
    """lid, least (over its documents), root."""
    first = rows.groupBy("lid").agg(F.min(least).alias("least"))
    return first.join(near_classes(docs, rows), "lid", "left").withColumn("root", F.coalesce("root", "lid"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id (the least doc_id of the class) for every document."""
    rows = _shared.stored(signatures(docs), "signatures")
    rooted = _shared.stored(_rooted(docs, rows, F.col("doc_id")), "rooted")
    # Stored, since adaptive execution splits a hot class only where both sides come straight from a shuffle.
    classes = _shared.stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "classes")
    named = _shared.stored(rooted.join(classes, "root").select("lid", "component_id"), "named")
    return rows.join(named, "lid").select("doc_id", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """_id, _part (the hash of its text) of one document of each class: the least by id, those without one last, then by ``_part``."""
    rows = _shared.stored(signatures(docs), "signatures")
    rooted = _rooted(docs, rows, F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.col("part")))
    return rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.doc_id").alias("_id"), F.col("least.part").alias("_part"))
