import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreloom.llm import buckets, substrings


def expected(texts, keep_first=False, least=200):
    """{row: (n_bytes, n_removed, n_spans, sha256)} for raw texts in order."""
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + least] for r in raws for i in range(len(r) - least + 1))
    seen, out = set(), []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - least + 1):
            w = r[i : i + least]
            if count[w] > 1 and (not keep_first or w in seen):
                gone[i : i + least] = b"\1" * least
            seen.add(w)
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs, keep_first=False):
    rows = docs.select("doc_id", "text").collect()
    rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = sorted(((r.doc_id, *x) for r, x in zip(rows, expected([r.text for r in rows], keep_first))), key=str)
    got = sorted((tuple(r)[:5] for r in substrings.remove_repeats(docs, keep_first).collect()), key=str)
    assert got == want
    assert any(r[2] for r in got)


def mixed(spark, n=60):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 8))) for _ in range(400)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    shared = [prose(60) for _ in range(5)]
    rows = [(i, prose(rng.randint(0, 120)) + rng.choice(shared)[rng.randint(0, 60) :] + prose(rng.randint(0, 80))) for i in range(n)]
    rows += [(n, "ab" * 400), (n + 1, "x" * 1000), (n + 2, "x" * 199), (n + 3, shared[0] + shared[1]), (n + 4, rows[3][1])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_mixed(spark, monkeypatch):
    docs = mixed(spark)
    check(docs)
    check(docs, keep_first=True)


def test_documents(small_docs):
    check(small_docs)


def test_odd(spark, odd_docs, no_docs):
    check(odd_docs)
    assert substrings.remove_repeats(no_docs).collect() == []


def test_large_buckets(spark):
    """A line in over BLOCK different texts, in one of which it has more around it that repeats."""
    line = "the very common line that stands in all of these texts " * 2
    rng = random.Random(9)
    other = lambda: "".join(rng.choices("abcdefghijklmnop ", k=150))
    rows = [(i, other() + line + other()) for i in range(buckets.BLOCK + 200)]
    left = other()
    rows += [(10**6 + i, left + line + other()) for i in range(3)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60))
def test_nearest_smaller(values):
    got = substrings.nearest_smaller(np.array(values, np.int64)).tolist()
    assert got == [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(len(values))]


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=20, max_size=200), st.integers(1, 20))
def test_earlier_match(text, depth):
    data = np.frombuffer(text.encode(), np.uint8)
    starts = np.arange(len(text) - depth + 1)
    got = substrings.earlier_match(data, starts, depth)
    for i in starts:
        earlier = {j for j in range(i) if text[j : j + depth] == text[i : i + depth]}
        assert got[i] in earlier if earlier else got[i] == -1


def test_long_texts_in_parts(spark):
    """A text read in overlapping parts has the windows, and the anchors, that it has when read at once."""
    text = " ".join(str(i * i) for i in range(400)) + "ab" * 400
    docs = spark.createDataFrame([(1, 0, text), (2, 0, text[:500]), (3, 0, None)], "doc_id long, part long, text string")

    def windows(part):
        rows = substrings.split(docs, part=part).collect()
        return {(r.doc_id, r.place // 256 + i, r.core) for r in rows for i in range(r.place % 256)}

    assert windows(333) == windows(substrings.PART) and len(windows(333)) == len(text) - substrings.LEAST + 1 + 301
