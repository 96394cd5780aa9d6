import hashlib
import re

from pyspark.sql import functions as F

from scoreloom.llm import decontaminate as D


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(docs, items):
    """A row per document from a comparison of every window with every place."""
    tests = set()
    for item_id, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            tests.add((item_id, tuple(w[i : i + 10])))
    out = []
    for doc_id, text in docs:
        w, hit, ids = split(text), set(), set()
        for item_id, test in tests:
            for i in range(len(w) - len(test) + 1):
                if tuple(w[i : i + len(test)]) == test:
                    hit |= set(range(i, i + len(test)))
                    ids.add(item_id)
        names = ",".join(sorted(str(x) for x in ids if x is not None))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def run(docs, items, **kw):
    return sorted((tuple(r) for r in D.decontaminate(docs, items, **kw).collect()), key=str)


#: Items with one id and several texts, null ids and texts, repeats, one common word, and windows of one and two words.
ITEMS = [
    (1, "plain WORDS twice"), (2, None), (3, "..."), (12, "x"), (4, " ".join(f"t{i}" for i in range(14))), (4, "no id"), (4, "no id"), (None, "Id at, ALL"), (None, "x"),
    (5, "word1 and1 word2 and2 word3 and3 word4 and4 word5 and5 word6"), (6, "t2 t3 t4"), (7, "never t2 t3"), (8, "and1 and1"), (9, "rep rep rep rep rep rep rep rep rep rep rep"),
]
MORE = [
    (20, "a " + " ".join(f"T{i}," for i in range(2, 13)) + " b x"), (21, " ".join(f"t{i}" for i in range(9))), (21, " ".join(f"t{i}" for i in range(9))), (22, "\t\n ,x"), (23, "and1 and1 and1"),
    (24, "rep " * 30), (25, "É no id Éx É x"), (26, " " * 5000 + "t2 t3 t4" + "," * 5000), (27, "x " * 20000),
]


def test_against_brute_force(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("row", F.lit(1))
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(MORE, "doc_id long, text string"))
    want = expected(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert run(docs, items) == want and sum(r[5] for r in want) > 10
    # Without broadcasts: what lies beyond their bound.
    assert run(docs.repartition(5), items, small=0) == want
    assert run(odd_docs, items) == expected(pairs(odd_docs, "doc_id"), pairs(items, "item_id"))
    assert run(no_docs, items) == []
    assert not any(r[5] for r in run(docs, items.limit(0)))
    assert run(docs, items, size=3) != want


def test_contaminated_rows(spark, odd_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r._id, r._text) for r in D.contaminated(odd_docs, items).collect()}
    want = {r[0] for r in expected(pairs(odd_docs, "doc_id"), pairs(items, "item_id")) if r[5]}
    assert {x for x, _ in got} == want and None in want


def test_proximity(spark):
    rows = [(1, "alpha x x beta"), (2, "beta x x x x x x alpha"), (3, "alpha alpha"), (4, "beta alpha beta " + "x " * 50 + "alpha x x x beta"), (4, None), (None, "beta alpha")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "alpha", "beta"), (2, "alpha", "alpha"), (3, "gone", "alpha"), (1, "alpha", "beta")], "pair_id long, left string, right string")
    for small in (0, 100):
        assert {tuple(r)[1:] for r in D.proximity_matches(docs, asked, 3, small).collect()} == {(1, 1, 1), (3, 2, 2), (4, 1, 1), (None, 1, 1)}
