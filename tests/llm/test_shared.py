import os

import pyarrow as pa
import pytest
from pyspark import cloudpickle

from scoreloom.llm import _shared, lines, near, packing


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20


def sent(emit, operator):
    """As a worker gets it: with copies of what is not of a module."""
    return cloudpickle.loads(cloudpickle.dumps(_shared.lean(emit, operator)))


def test_lean_keeps_only_the_operators_own():
    near.shingles(["one two three four five six"])
    coder = packing.WordIds(packing.tokenizer_path())
    coder.encode(pa.array(["some words"]))
    assert set(_shared._kept) >= {"near", "packing"}
    held = _shared._kept["packing"]
    list(sent(lambda batches: batches, "packing")(iter([])))
    assert list(_shared._kept) == ["packing"] and _shared._kept["packing"] is held
    list(sent(lambda batches: batches, "")(iter([])))
    assert not _shared._kept


def test_stages_of_the_pipeline_are_lean(spark, monkeypatch):
    made = []
    monkeypatch.setattr(_shared, "lean", lambda emit, operator="": made.append((emit.__qualname__.split(".")[0], operator)) or emit)
    docs = spark.createDataFrame([(1, "a few words\nin two lines")], "doc_id long, text string")
    packing.tokenize(docs)
    near.signatures(docs)
    lines.occurrences(docs)
    lines.lines_of(docs)
    assert made == [("tokenize", "packing"), ("signatures", "near"), ("occurrences", ""), ("lines_of", "")]


@pytest.mark.skipif(not os.path.exists("/proc/self/statm"), reason="reads /proc")
def test_lean_gives_free_memory_back():
    last = []

    def emit(batches):
        held = [b"x" * 65536 for _ in range(3000)]
        last.append(held[-1])  # memory below it is not given back by itself
        yield from batches

    before = resident()
    list(_shared.lean(emit)(iter([])))
    assert resident() - before < 90
