import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoreloom.llm import packing


def expected(rows):
    coder = Tokenizer.from_file(packing.tokenizer_path())
    out = []
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            out.append((doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def best_fit(counts, capacity):
    """The sequences that best-fit decreasing opens, piece by piece."""
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((x for x in free if x >= length), default=None)
            if fit is None:
                free.append(capacity - length)
            else:
                free[free.index(fit)] -= length
    return len(free)


def check(docs, salt_rows=packing.SALT_ROWS):
    pieces = packing.tokenize(docs).cache()
    rows = [tuple(r) for r in packing.pack(pieces, salt_rows=salt_rows).collect()]
    assert sorted((r[:5] for r in rows), key=str) == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    held = defaultdict(list)
    for r in rows:
        held[r[5]].append((r[6], r[3]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r[3] for r in rows)
    assert len(held) <= -(-total // 2048) * 1.1 + 2
    assert len(held) == best_fit(Counter(r[3] for r in rows), 2048)
    pieces.unpersist()


def test_documents(small_docs):
    check(small_docs)


def test_many_salts(small_docs):
    """Copies of whole rows, of full pieces and of one short length, ranked a few at a time."""
    copies = small_docs.unionByName(small_docs.where("doc_id % 7 = 0")).unionByName(small_docs.limit(1).withColumn("text", F.lit("one two")).withColumn("doc_id", F.explode(F.sequence(F.lit(1), F.lit(300)))).withColumn("doc_id", F.lit(5).cast("long")))
    check(copies, 7)


def test_odd(odd_docs, no_docs):
    check(odd_docs)
    assert packing.pack(packing.tokenize(no_docs)).collect() == []


@settings(max_examples=1000, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=20))
def test_plan(counts):
    """Every rank has one slot, no sequence overflows, and best-fit decreasing over documents opens as many sequences."""
    slots = packing.plan(counts, 50)
    room, ranks = defaultdict(lambda: 50), defaultdict(list)
    for length, first, last, sequence, offset in slots:
        for i in range(last - first):
            assert room[sequence + i] == 50 - offset
            room[sequence + i] -= length
            assert room[sequence + i] >= 0
        ranks[length] += range(first, last)
    assert {k: len(v) for k, v in ranks.items()} == counts and all(v == list(range(len(v))) for v in ranks.values())
    assert len(room) == best_fit(counts, 50)
