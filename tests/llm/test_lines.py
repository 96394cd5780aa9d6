import random

from scoreloom.llm import lines as L


def sets(text):
    return {text[i : i + 8] for i in range(max(1, len(text) - 7))}


def jaccard(a, b):
    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b)


def expected(rows, least=0.8):
    """{(doc_id, line number)} to remove, by comparing all pairs of lines."""
    found = [(d, i, n) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for i, x in enumerate((t or "").split("\n")) if (n := L.normal(x))]
    texts = sorted({n for _, _, n in found})
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = sorted(((sets(t), t) for t in texts), key=lambda x: len(x[0]))
    for i, (a, s) in enumerate(held):
        for b, t in held[i + 1 :]:
            if least * len(b) > len(a):
                break
            if len(a & b) >= least * len(a | b):
                root[find(t)] = find(s)
    seen, gone = set(), set()
    for d, i, n in found:
        if find(n) in seen:
            gone.add((d, i))
        seen.add(find(n))
    return gone


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnoprstuvé", k=rng.randint(2, 9))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(15, 60))) for _ in range(20)]
    rows = []
    for d in range(n):
        lines = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choice(base).split()
            w[rng.randrange(len(w))] = rng.choice(words)
            lines.append(" ".join(w).title() if rng.random() < 0.2 else " ".join(w))
        lines.append(" ".join(rng.choices(words, k=8)))
        rows.append((d, "\n".join([*lines, "", "--"])))
    return rows


def removed(df, rows):
    got = {r._id: set(r._gone) for r in L.removals(df)[0].collect()}
    return {(d, i) for d, g in got.items() for i in g}


def test_against_all_pairs(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, got = expected(rows), removed(df, rows)
    assert len(want & got) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)
    by_id = {r.doc_id: r for r in L.dedup_lines(df).collect()}
    for d, t in rows:
        gone = {i for x, i in got if x == d}
        assert by_id[d].text == "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone) and by_id[d].n_removed == len(gone)


def test_large_buckets(spark):
    rng = random.Random(2)
    base = "".join(rng.choices("abcdefghij ", k=200))
    late = [(1, i, base[:i] + "#" + base[i:]) for i in range(60)] + [(1, 100 + i, "".join(rng.choices("klmnopq", k=100))) for i in range(20)]
    edges = L.late_links(spark.createDataFrame(late, "key long, lid long, line string"), block=10)
    roots = {r.node: r.root for r in L.components.components(edges).collect()}
    assert all(roots.get(i, i) == 0 for i in range(60)) and all(i not in roots for i in range(100, 120))


def test_large_buckets_against_all_pairs(spark):
    """Several buckets of many small classes, chains and lone lines give the classes that all pairs give."""
    rng = random.Random(8)
    late = []
    for key in range(3):
        lines = []
        for _ in range(12):
            line = "".join(rng.choices("abcdefghij ", k=120))
            for _ in range(rng.choice([1, 2, 9])):
                lines.append(line)
                i = rng.randrange(len(line))
                line = line[:i] + rng.choice("klm") + line[i + 1 :]
        late += [(key, 1000 * key + i, x) for i, x in enumerate(rng.sample(lines, len(lines)))]
    edges = L.late_links(spark.createDataFrame(late, "key long, lid long, line string"), block=7)
    got = {r.node: r.root for r in L.components.components(edges).collect()}
    root = {lid: lid for _, lid, _ in late}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (k, a, x) in enumerate(late):
        for q, b, y in late[i + 1 :]:
            if k == q and jaccard(x, y) >= 0.8:
                c, d = find(a), find(b)
                root[max(c, d)] = min(c, d)
    assert {lid: got.get(lid, lid) for _, lid, _ in late} == {lid: find(lid) for _, lid, _ in late}


def test_odd(odd_docs, no_docs):
    rows = L.dedup_lines(odd_docs).collect()
    assert len(rows) == 8 and set(odd_docs.columns) <= set(rows[0].asDict())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[4].n_removed == 0 and by_id[5].n_removed == 1 and by_id[None].n_removed == 0
    assert len(L.dedup_lines(odd_docs, drop_emptied=True).collect()) == 6
    assert L.dedup_lines(no_docs).collect() == []


def test_repeated_rows(spark):
    """Of rows with one id and text one keeps each line, whatever the id, and copies of a later document keep none."""
    text = "first line here of some words\n--\n\nsecond line of other words\nfirst line here of some words"
    rows = [(1, text), (1, text), (1, text), (None, "a third line of its own"), (None, "a third line of its own"), (2, text), (2, text), (1, "another text under id one"), (3, None), (3, None)]
    found = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    first, empty = "first line here of some words\n--\n\nsecond line of other words", "--\n"
    want = [(1, first, 1), (1, empty, 3), (1, empty, 3), (2, empty, 3), (2, empty, 3), (None, "a third line of its own", 0), (None, "", 1), (1, "another text under id one", 0), (3, None, 0), (3, None, 0)]
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in found.collect()), key=str) == sorted(want, key=str)
    assert L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), drop_emptied=True).count() == 5


def test_band_recall():
    """Pairs at 0.8 and more share a band with a probability of 0.99 or more, at all lengths."""
    rng = random.Random(3)
    for n in (12, 40, 100, 400):
        pairs = []
        while len(pairs) < 300:
            a = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=n))
            cut = rng.randint(0, max(1, n // 9))
            b = a[cut:] if rng.random() < 0.5 else a[: n - cut] + "".join(rng.choices("xyz", k=rng.randint(0, 2)))
            if a.strip() and b.strip() and 0.8 <= jaccard(a, b) < 0.9:
                pairs.append((a, b))
        keys = [L.band_keys([p[i] for p in pairs]) for i in (0, 1)]
        assert (keys[0] == keys[1]).any(axis=1).mean() >= 0.97


def test_bucket_of_few_lines_from_many_tasks(spark):
    for lines in (60, 2):
        keyed = spark.range(14400).selectExpr("7L AS key", f"id % {lines} AS lid")
        found = L.candidates(keyed).collect()
        assert len({r.key for r in found}) == 1 and {r.lid for r in found} == set(range(lines))


def test_band_keys_come_in_parts(monkeypatch):
    """Hashing part by part gives the keys that hashing all at once does, and takes a part's memory only."""
    import tracemalloc

    rng = random.Random(8)
    texts = ["x", "a" * 200_000, *("".join(rng.choices("abcdef ", k=rng.randrange(1, 400))) for _ in range(6000)), "y" * 70_000, "", "z"]
    whole = L._band_keys(texts, L.BANDS, L.ROWS)
    assert (L.band_keys(texts) == whole).all() and L.band_keys([]).shape == (0, L.BANDS)
    many = texts[2:6002]
    tracemalloc.start()
    L.band_keys(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 << 20
