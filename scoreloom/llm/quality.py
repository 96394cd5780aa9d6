"""Ordinal cumulative-link regression on graded ratings, over hashed text.

Grades are 0 (toxic), 1 (poor) and 2 (good). One weight vector is shared by all grades and ordered
thresholds cut its score: P(grade <= k) = sigmoid(threshold_k - score), which gives the expected grade and
the tail probability P(grade >= 2) by which documents are selected. Features are the hashed
five-byte grams that a text has, in lower case, and a few bucketed shape statistics.

The model is fitted on at most SAMPLE labelled documents, the first by a hash of their ids; every
document is scored whole. Cases: null text is empty; documents without a label are scored like
others; several labels of one document take the least, several texts of one the least by a hash; labels without
a document are left out; without labels every document is kept; repeated rows each get a row; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared

BITS = 18
GRAM = 5
#: Bound on the labelled documents that the driver fits on; their features take some 8 KB each.
SAMPLE = 6000
#: Entries of the sparse table that the fit gathers at once.
STEP = 1 << 20
ROUNDS, RATE, L1 = 120, 0.15, 2e-4
TAIL = 0.5


def features(raw: bytes, bits: int = BITS) -> "np.ndarray":
    """The hashed features of a text, each once."""
    import numpy as np

    data = np.frombuffer(raw, np.uint8)
    n = len(data)
    low = np.frombuffer(raw.lower(), np.uint8).astype(np.uint64)
    seen = np.zeros(1 << bits, bool)
    grams = n - GRAM + 1
    distinct = 0
    if grams > 0:
        key = low[:grams].copy()
        for i in range(1, GRAM):
            key |= low[i : i + grams] << np.uint64(8 * i)
        seen[(key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).view(np.int64)] = True
        distinct = int(np.count_nonzero(seen))
    upper = int(np.count_nonzero((data >= 65) & (data <= 90)))
    lower = int(np.count_nonzero((data >= 97) & (data <= 122)))
    marks = int(np.count_nonzero((data > 32) & (data < 48) | (data > 57) & (data < 65) | (data > 90) & (data < 97) | (data > 122) & (data < 127)))
    scale = n.bit_length() // 2
    shape = (scale, 64 + 20 * upper // max(1, upper + lower), 128 + 40 * marks // max(1, n), 256 + 64 * scale + 20 * distinct // max(1, grams))
    for s in shape:
        seen[(s * 2654435761 + 97) % (1 << bits)] = True
    return np.flatnonzero(seen)


@dataclass
class Ordinal:
    """Weights and ascending thresholds; grades are 0 to len(thresholds)."""

    weights: "np.ndarray"
    thresholds: "np.ndarray"

    def probabilities(self, score: "np.ndarray") -> "np.ndarray":
        import numpy as np

        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None] - score[:, None], -40, 40)))
        return np.diff(np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1), axis=1)


def summed(index: "np.ndarray", values: "np.ndarray", at: "np.ndarray", n: int) -> "np.ndarray":
    """The sum of ``values[at]`` for each of n indices, STEP entries at a time."""
    import numpy as np

    out = np.zeros(n)
    for a in range(0, len(index), STEP):
        out += np.bincount(index[a : a + STEP], values[at[a : a + STEP]], minlength=n)
    return out


def slopes(score: "np.ndarray", cut: "np.ndarray", grades: "np.ndarray") -> tuple["np.ndarray", "np.ndarray"]:
    """The derivatives of the mean negative log-likelihood by each row's score and by each threshold."""
    import numpy as np

    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    edges = np.concatenate([[-np.inf], cut, [np.inf]])
    a, b = sigmoid(edges[grades + 1] - score), sigmoid(edges[grades] - score)
    p = np.maximum(a - b, 1e-9)
    by_cut = [np.sum((b * (1 - b) / p)[grades == k + 1]) - np.sum((a * (1 - a) / p)[grades == k]) for k in range(len(cut))]
    return (1 - a - b) / len(score), np.array(by_cut) / len(score)


def fit(rows: list["np.ndarray"], grades: "np.ndarray", n_grades: int = 3, bits: int = BITS, rounds: int = ROUNDS, rate: float = RATE, l1: float = L1) -> Ordinal:
    """Maximum likelihood with an L1 penalty, by full-batch proximal AdaGrad; the same rows give the same model."""
    import numpy as np

    weights = np.zeros(1 << bits)
    if not len(rows):
        return Ordinal(weights, np.full(n_grades - 1, -40.0) + np.arange(n_grades - 1))
    size = np.array([len(r) for r in rows])
    column = np.concatenate(rows)
    count = np.bincount(column, minlength=1 << bits)
    used = np.flatnonzero((count >= 3) & (count <= 0.9 * len(rows)))
    code = np.full(1 << bits, -1, np.int32)
    code[used] = np.arange(len(used))
    row, column = np.repeat(np.arange(len(rows), dtype=np.int32), size), code[column]
    row, column = row[column >= 0], column[column >= 0]
    w = np.zeros(len(used))
    share = np.clip(np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / len(grades), 1e-3, 1 - 1e-3)
    cut = np.log(share / (1 - share))
    cut += 1e-3 * np.arange(len(cut))
    held_w, held_cut = np.full(len(used), 1e-8), np.full(len(cut), 1e-8)
    for _ in range(rounds):
        pull, by_cut = slopes(summed(row, w, column, len(rows)), cut, grades)
        gradient = summed(column, pull, row, len(used))
        held_cut += by_cut * by_cut
        cut = cut - rate * by_cut / np.sqrt(held_cut)
        cut = np.maximum.accumulate(cut + 1e-6 * np.arange(len(cut)))
        held_w += gradient * gradient
        step = rate / np.sqrt(held_w)
        w -= step * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
    weights[used] = w
    return Ordinal(weights, cut)


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, grade, idx for at most ``sample`` labelled documents, a row for each."""
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    graded = labels.where("doc_id is not null and (toxic is not null or quality is not null)").groupBy("doc_id").agg(F.min(grade).alias("grade"))
    # Labels whose document is absent take no place in the sample.
    present = graded.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    graded = _shared.stored(present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "graded")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _shared.by_bytes(batches, "text"):
            idx = [features((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(idx, pa.list_(pa.int32()))], names=["doc_id", "grade", "idx"])

    # The sample is bounded by a parameter, so its ids can go to every task.
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _shared.whole_text().alias("text")).join(F.broadcast(graded), "doc_id")
    # Of several texts of one document the least by hash, then by itself.
    one = picked.groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    return one.select("doc_id", "grade", "text").mapInArrow(_shared.lean(emit), "doc_id long, grade int, idx array<int>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    import numpy as np

    table = sampled(docs, labels, sample).toArrow().sort_by([("doc_id", "ascending")])
    rows = [np.asarray(r.values) for r in table.column("idx")]
    return fit(rows, table.column("grade").to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Ordinal, tail: float = TAIL) -> DataFrame:
    """doc_id, part (a hash of the text), expected_grade, p_top, keep for every document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in _shared.by_bytes(batches, "text"):
            total = np.array([model.weights[features((t or "").encode())].sum() for t in batch.column("text").to_pylist()])
            p = model.probabilities(total)
            expected = p @ np.arange(p.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(expected), pa.array(p[:, -1]), pa.array(p[:, -1] >= tail)], names=["doc_id", "part", "expected_grade", "p_top", "keep"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("part"), "text")
    return rows.mapInArrow(_shared.lean(emit), "doc_id long, part long, expected_grade double, p_top double, keep boolean")


def select(docs: DataFrame, model: Ordinal, tail: float = TAIL) -> DataFrame:
    """The rows of ``docs`` whose tail probability reaches ``tail``, all columns kept."""
    names = docs.columns

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in _shared.by_bytes(batches, "text"):
            total = np.array([model.weights[features((t or "").encode())].sum() for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(model.probabilities(total)[:, -1] >= tail))

    return docs.select(*names).mapInArrow(_shared.lean(emit), docs.schema)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _shared.documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).drop("part")
