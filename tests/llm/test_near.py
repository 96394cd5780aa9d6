import random

import corpus_pipeline as P
from scoreloom.llm import lines, near
from tests.llm.test_simhash import slow_classes


def sets(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def pair(rng, n, least):
    """Two texts of about n words whose similarity is just over ``least``."""
    a = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    b, at = list(a), rng.sample(range(n), n)
    for i in at:
        was, b[i] = b[i], f"x{i}"
        x, y = sets(" ".join(a)), sets(" ".join(b))
        if len(x & y) < least * len(x | y):
            b[i] = was
            return " ".join(a), " ".join(b)


def classes(df):
    return {r.doc_id: r.component_id for r in near.near_duplicates(df).collect()}


def test_pairs_far_apart_in_bits_are_linked(spark):
    rng = random.Random(3)
    texts = [t for n in (60, 200, 600) for least in (0.8, 0.9) for _ in range(40) for t in pair(rng, n, least)]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in P.near_dedup(spark, docs, "").collect()}
    assert kept == set(slow_classes(dict(enumerate(map(sets, texts))), similar).values()) == set(range(0, len(texts), 2))


def test_fingerprints_link_what_similarity_does_not(spark):
    """The stage takes the links of the fingerprints too: a much repeated passage outweighs different words beside it."""
    from scoreloom.llm import simhash

    same = "one two three four five six seven " * 60
    texts = [same + " ".join(f"{w}{i}" for i in range(12)) for w in "abc"] + [" ".join(f"d{i}" for i in range(80))]
    fps = [simhash.fingerprint(t.encode()) for t in texts]
    assert max((fps[0] ^ f).bit_count() for f in fps[1:3]) <= 4 and not similar(sets(texts[0]), sets(texts[1]))
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in P.near_dedup(spark, docs, "").collect()} == {0, 3}


def test_documents(spark, small_docs):
    assert classes(small_docs) == slow_classes({r.doc_id: sets(r.text) for r in small_docs.collect()}, similar)


def test_odd(spark, odd_docs, no_docs):
    rows = near.near_duplicates(odd_docs).collect()
    by_id = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == 8 and by_id[1] == by_id[2] == 1 and by_id[5] == 4 and by_id[3] == 3 and by_id[None] is None
    assert near.near_duplicates(no_docs).collect() == []


def test_long_texts_in_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(lines, "BUCKET_BYTES", 20_000)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = [(i, " ".join(base[: 4 * i] + [f"x{i}"] + base[4 * i :])) for i in range(60)]
    assert set(classes(spark.createDataFrame(rows, "doc_id long, text string")).values()) == {0}
