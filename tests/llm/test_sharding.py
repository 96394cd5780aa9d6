import itertools
import zlib

from scoreloom.llm import sharding as S


def test_curve(spark):
    """Consecutive cells touch, and every cell has one index."""
    for dims, bits in ((2, 3), (3, 2), (3, 4)):
        names = [f"c{i}" for i in range(dims)]
        cells = list(itertools.product(range(1 << bits), repeat=dims))
        df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
        order = sorted((r.curve, tuple(r[n] for n in names)) for r in S.hilbert(df, names, bits).collect())
        assert [i for i, _ in order] == list(range(len(cells)))
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for (_, x), (_, y) in zip(order, order[1:]))


def law(docs, **more):
    rows = S.shard(docs, **more).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == sorted(((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts), key=str)
    by_shard = {k: sorted(r.slot for r in rows if r.shard == k) for k in range(8)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    return rows


def test_documents(spark, small_docs, odd_docs, no_docs):
    rows = law(small_docs)
    assert [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))] == sorted(r.curve for r in rows)
    law(odd_docs)
    assert S.shard(no_docs).collect() == []


def test_hot_texts_stand_together(spark):
    """Copies of several hot texts of one cell follow each other, whatever parts they are dealt to."""
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 < 2, concat('same', id % 2), concat('t', id % 1000)) as text", "'en' as lang", "'s' as source")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for more in ({}, {"hot": 50, "part_rows": 500}):
        order = [texts[r.doc_id] for r in sorted(law(docs, **more), key=lambda r: (r.shard, r.slot))]
        runs = [t for t, _ in itertools.groupby(order)]
        assert len(runs) == len(set(order))


def test_quantiles_against_brute_force(spark, small_docs):
    """Each quantised dimension splits the texts at its quantiles: cells keep their order."""
    rows = small_docs.selectExpr("doc_id", "length(text) as n")
    got = S.quantise(rows.withColumn("q", rows.n), ["q"], 3).collect()
    pairs = sorted((r.n, r.q) for r in got)
    assert [q for _, q in pairs] == sorted(q for _, q in pairs) and {q for _, q in pairs} <= set(range(8))
    share = [sum(q <= k for _, q in pairs) / len(pairs) for k in range(8)]
    assert all(abs(s - (k + 1) / 8) < 0.05 for k, s in enumerate(share))


def test_written(spark, small_docs, tmp_path):
    S.write_shards(small_docs, S.shard(small_docs), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == small_docs.count()
