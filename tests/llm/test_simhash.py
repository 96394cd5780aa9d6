import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from scoreloom.llm import buckets, components, simhash


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps, meet=lambda a, b: (a ^ b).bit_count() <= 4):
    """fps: {doc_id: fingerprint}"""
    left, out = set(fps), {}
    while left:
        root = min(left)
        left.discard(root)
        front, seen = [root], [root]
        while front:
            x = fps[front.pop()]
            new = [d for d in left if meet(fps[d], x)]
            left -= set(new)
            front += new
            seen += new
        out |= dict.fromkeys(seen, root)
    return out


def test_documents(spark, small_docs):
    got = {r.doc_id: (r.fp & simhash.FULL, r.component_id) for r in simhash.near_duplicates(small_docs).collect()}
    fps = {r.doc_id: slow_fingerprint(r.text) for r in small_docs.collect()}
    assert {k: v[0] for k, v in got.items()} == fps
    assert {k: v[1] for k, v in got.items()} == slow_classes(fps)


def test_odd(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted((r.fp & simhash.FULL for r in rows)) == sorted(slow_fingerprint(t) for _, t in texts)
    by_id = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(texts) and by_id[1] == by_id[2] == 1 and by_id[5] == 4 and by_id[None] is None
    assert simhash.near_duplicates(no_docs).collect() == []


def near(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n // 20):
        x = rng.getrandbits(64)
        for _ in range(20):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            out.append(x)
    return out


def test_no_link_is_lost(spark, monkeypatch):
    values = near(5, 600)
    rows = [(int(np.uint64(x).astype(np.int64)),) for x in values]
    fps = spark.createDataFrame(rows, "fp long")
    roots = {r.fp: r.root for r in simhash.near_classes(fps).collect()}
    expected = slow_classes(dict(zip((r[0] for r in rows), values)))
    assert {r[0]: roots.get(r[0], r[0]) for r in rows} == expected


def test_keys_are_made_in_all_partitions(spark):
    fps = spark.range(20000).select((F.col("id") % 5000).alias("fp"))
    tasks = simhash.keys(simhash.dealt(fps)).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 2 * 64 * 5000 / 8


def test_large_buckets(spark):
    values = near(6, 300)
    late = spark.createDataFrame([(0, int(np.uint64(x & ~((1 << 26) - 1)).astype(np.int64))) for x in values], "key long, fp long").distinct()
    edges = simhash.late_links(late, block=10)
    nodes = [r.fp for r in late.select("fp").collect()]
    roots = {r.node: r.root for r in components.components(edges).collect()}
    chains = simhash._chains()
    meet = lambda a, b: bool(simhash.close(np.array([(a ^ b) & simhash.FULL], np.uint64), 0, chains)[0])
    assert {x: roots.get(x, x) for x in nodes} == slow_classes(dict(zip(nodes, nodes)), meet)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(150)]
    table = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components.components(table).collect()}
    assert got == {r.node: r.root for r in components.components(table, few=0).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if find(x) != x}


def test_runs():
    import pyarrow as pa

    keys = np.sort(np.array([1] * 3 + [2] * 9000 + [3] + [4] * 2))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 1000])], names=["key"]) for i in range(0, len(keys), 1000)]
    seen = []
    for whole, at in buckets.runs(iter(batches), "key"):
        for a, b in zip(at[:-1], at[1:]):
            part = set(whole.column("key").slice(int(a), int(b - a)).to_pylist())
            assert len(part) == 1
            seen.append((part.pop(), int(b - a)))
    assert [s for s in seen if s[0] != 2] == [(1, 3), (3, 1), (4, 2)] and sum(n for k, n in seen if k == 2) == 9000
