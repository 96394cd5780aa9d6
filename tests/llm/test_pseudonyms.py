import hashlib
import re
import time
from datetime import date, timedelta

from scoreloom.llm import pseudonyms as P

KEY = "k"


def permute(left, right, ml, mr, tweak):
    for i in range(8):
        f = lambda half: int(hashlib.sha256(f"{KEY}|{tweak}:{ml}:{mr}|{i}|{half}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        if i % 2 == 0:
            left = (left + f(right)) % ml
        else:
            right = (right + f(left)) % mr
    return left, right


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def outcome(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in P.pseudonymise(df, KEY).collect()}


def test_values(spark):
    texts = [
        "card 4337166598464399 and 4337 1665 9846 4399.", "not 4337166598464398 valid", "ip 42.144.35.254, 300.1.1.1", "call +1 (807) 555-6237 now", "born 1987-02-28 or 1987-02-30",
        "ssn 123-45-6789 and 666-45-6789", "Mail A.b+c@mail8.example.com!", "nothing", "old 1899-12-31 new 2099-12-31", "4337166598464399",
    ]
    got = outcome(spark, texts)
    cards = re.findall(r"\d[\d ]{14,17}\d", got[0].text)
    plain = [c.replace(" ", "") for c in (cards[0].strip(), cards[1].strip())]
    assert plain[0] == plain[1] == got[9].text and luhn(plain[0]) and plain[0] != "4337166598464399"
    left, right = permute(4337166, 59846439, 10**7, 10**8, "card")
    assert plain[0][:15] == f"{left:07d}{right:08d}"
    assert got[1].text == texts[1] and got[7].text == texts[7] and got[1]["values"] == []
    a, b, c, d = (int(x) for x in re.search(r"ip (\S+),", got[2].text)[1].split("."))
    assert (a * 256 + b, c * 256 + d) == permute(42 * 256 + 144, 35 * 256 + 254, 65536, 65536, "ip") and "300.1.1.1" in got[2].text
    left, right = permute(607, 3556237, 800, 8000000, "phone")
    assert got[3].text == f"call +1 ({left + 200}) {str(right + 2000000)[:3]}-{str(right + 2000000)[3:]} now"
    day = (date(1987, 2, 28) - date(1900, 1, 1)).days
    left, right = permute(day // 229, day % 229, 319, 229, "date")
    assert got[4].text == f"born {date(1900, 1, 1) + timedelta(left * 229 + right)} or 1987-02-30"
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4} and 666-45-6789", got[5].text) and "123-45-6789" not in got[5].text
    assert re.fullmatch(r"Mail u[0-9a-f]{16}@example.invalid!", got[6].text)
    assert "1899-12-31" in got[8].text and "2099-12-31" not in got[8].text


def test_bijection(spark):
    """Distinct values of a whole small range stay distinct and valid."""
    days = [str(date(1990, 1, 1) + timedelta(i)) for i in range(1500)]
    ips = [f"10.0.{i}.{j}" for i in range(30) for j in range(50)]
    got = outcome(spark, days + ips)
    new = [got[i].text for i in range(len(got))]
    assert len(set(new)) == len(new)
    for text in new[: len(days)]:
        date.fromisoformat(text)
    assert all(int(x) < 256 for text in new[len(days) :] for x in text.split("."))


def test_odd(odd_docs, no_docs):
    rows = P.pseudonymise(odd_docs, KEY).collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert len(rows) == 8 and all(r.text == texts[r.doc_id] for r in rows)
    assert P.pseudonymise(no_docs, KEY).collect() == []


def test_documents(small_docs):
    for r in P.pseudonymise(small_docs, KEY).collect():
        assert not re.search(r"@mail\d+\.example\.com", r.text)
        for v in r["values"]:
            assert v.was not in r.text.split() or v.kind == "ip"


def test_phones_out_of_range(spark):
    texts = [f"+1 ({a}) {b}-7713" for a in ("017", "117", "217", "555") for b in ("055", "155", "255")] + ["(017) 555-7713", "017-555-7713"]
    got = outcome(spark, texts)
    new = [got[i].text for i in range(len(texts))]
    assert all(a != b for a, b in zip(texts[:-1], new)) and new[-1] == texts[-1] and len(set(new[:12])) == 12
    assert all(re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", x) for x in new[:12]) and new[12] == outcome(spark, ["+1 (017) 555-7713"])[0].text[3:]


def test_long_texts_end_soon(spark):
    """Hosts of very many labels, long words and very many values."""
    texts = ["a@" + "b." * 20_000 + "com", "x" * 1_000_000, "a@" + "b-" * 500_000, "a@" * 300_000, "1.2." * 200_000, "10.0.0.1 " * 2000, "5" * 900_000, "a@" + "b" * 500_000 + ".c"]
    began = time.monotonic()
    got = outcome(spark, texts)
    assert time.monotonic() - began < 90
    assert all(re.fullmatch(r"u[0-9a-f]{16}@example.invalid", got[i].text) for i in (0, 7)) and [got[i].text for i in (1, 2, 3, 4, 6)] == [texts[i] for i in (1, 2, 3, 4, 6)]
    new = set(got[5].text.split())
    assert len(got[5].text.split()) == 2000 and len(new) == 1 and "10.0.0.1" not in new
