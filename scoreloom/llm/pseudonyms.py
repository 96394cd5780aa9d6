"""Format-preserving pseudonyms for personal data, from DataFrame functions only.

Numbers and dates are validated (Luhn for cards, octets for addresses, ranges for phone and
social-security numbers, the calendar for dates) and permuted within their own format by a keyed
Feistel network over mixed radices, so that equal values stay linked across documents and every
pseudonym is again a valid value. E-mail addresses have no fixed format; they get a keyed hash.
What does not validate stays as it is, but phone numbers with a +1 or parentheses: those out of range are permuted among themselves.

Cases: null text is empty; repeated rows give equal rows; an empty table gives no rows; other
columns are ignored; the text is read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared
from ._shared import let

ROUNDS = 8
KINDS = ("email", "date", "ssn", "ip", "phone", "card")
#: Possessive, so that a host of very many labels takes neither depth of stack nor a second try.
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
DATE = r"\d{4}-\d{2}-\d{2}"
SSN = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}(?:\.\d{1,3}){3}"
PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
CARD = r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19}"
ANY = rf"(?<![A-Za-z0-9._%+-]){EMAIL}|(?<![A-Za-z0-9])(?<![0-9]\.)(?:{DATE}|{SSN}|{IP}|{PHONE}|{CARD})(?![A-Za-z0-9]|\.[0-9])"
#: Days from 1900-01-01 to 2099-12-31: 73,049 = 319 * 229.
DAYS = (319, 229)


def feistel(left: Column, right: Column, radix_left: Column, radix_right: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """(left, right) permuted within 0..radix-1 each: the halves take turns in adding a keyed hash of the other."""

    def keyed(i: Column, half: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, i, half), 256), 1, 15), 16, 10).cast("long")

    def turn(acc: Column, i: Column) -> Column:
        first = i % 2 == 0
        left = F.when(first, F.pmod(acc["left"] + keyed(i, acc["right"]), radix_left)).otherwise(acc["left"])
        right = F.when(first, acc["right"]).otherwise(F.pmod(acc["right"] + keyed(i, acc["left"]), radix_right))
        return F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn)


def kind_of(value: Column) -> Column:
    """The kind of a match of ANY."""
    full = lambda p: value.rlike(f"^(?:{p})$")
    out = F.when(value.contains("@"), "email")
    for kind, pattern in (("date", DATE), ("ssn", SSN), ("ip", IP), ("phone", PHONE)):
        out = out.when(full(pattern), kind)
    return out.otherwise("card")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _part(text: Column, start: int | Column, length: int | Column) -> Column:
    one = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.substr(text, one(start), one(length)).try_cast("long")


def _ten(exponent: Column) -> Column:
    return F.rpad(F.lit("1"), exponent + 1, F.lit("0")).try_cast("long")


def halves(kind: Column, value: Column) -> Column:
    """A valid value as struct(left, right, radix_left, radix_right); null for others."""

    def of(left: Column, right: Column, radix_left: Column | int, radix_right: Column | int, valid: Column) -> Column:
        cells = ((left, "left"), (right, "right"), (radix_left, "radix_left"), (radix_right, "radix_right"))
        return F.when(valid, F.struct(*((F.lit(c) if isinstance(c, int) else c).cast("long").alias(n) for c, n in cells)))

    d = _digits(value)
    octet = lambda i: F.get(F.split(value, r"\."), F.lit(i)).try_cast("long")
    day = F.datediff(value.try_cast("date"), F.lit("1900-01-01").cast("date"))
    phone = F.substr(d, F.length(d) - 9, F.lit(10))
    explicit = value.rlike(r"^\+|\(")
    area = _part(d, 1, 3)
    half = F.floor((F.length(d) - 1) / 2).cast("int")
    rest = F.length(d) - 1 - half
    return (
        F.when(kind == "date", of(F.floor(day / DAYS[1]), day % DAYS[1], *DAYS, (day >= 0) & (day < DAYS[0] * DAYS[1])))
        .when(
            kind == "ssn",
            of(F.when(area > 666, area - 2).otherwise(area - 1), (_part(d, 4, 2) - 1) * 9999 + _part(d, 6, 4) - 1, 898, 99 * 9999, (area > 0) & (area != 666) & (area < 900) & (_part(d, 4, 2) > 0) & (_part(d, 6, 4) > 0)),
        )
        .when(kind == "ip", of(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), 65536, 65536, F.greatest(*(octet(i) for i in range(4))) < 256))
        .when(
            (kind == "phone") & (_part(phone, 1, 1) >= 2) & (_part(phone, 4, 1) >= 2),
            of(_part(phone, 1, 3) - 200, _part(phone, 4, 7) - 2_000_000, 800, 8_000_000, F.lit(True)),
        )
        .when((kind == "phone") & (_part(phone, 1, 1) < 2), of(_part(phone, 1, 3), _part(phone, 4, 7), 200, 10_000_000, explicit))
        .when(kind == "phone", of(_part(phone, 1, 3) - 200, _part(phone, 4, 7), 800, 2_000_000, explicit))
        .when(kind == "card", of(_part(d, 1, half), _part(d, half + 1, rest), _ten(half), _ten(rest), F.call_function("luhn_check", d)))
    )


def _refill(value: Column, digits: Column) -> Column:
    """``value`` with its last digits replaced in order by ``digits``, its other characters kept."""
    skip = F.length(_digits(value)) - F.length(digits)
    at = lambda i: F.length(_digits(F.substr(value, F.lit(1), i))) - skip
    one = lambda i: F.substr(value, i, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.when(one(i).rlike(r"\d") & (at(i) > 0), F.substr(digits, at(i), F.lit(1))).otherwise(one(i))), "")


def _padded(number: Column, width: int | Column) -> Column:
    return F.lpad(number.cast("string"), F.lit(width) if isinstance(width, int) else width, F.lit("0"))


def written(kind: Column, value: Column, parts: Column, was: Column) -> Column:
    """The permuted halves in the format of ``value``, whose own halves are ``was``."""
    left, right = parts["left"], parts["right"]
    length = F.length(_digits(value))
    half = F.floor((length - 1) / 2).cast("int")
    area = F.when(left >= 665, left + 2).otherwise(left + 1)
    # The least area code and number of the value's class of phone numbers, as ``halves`` tells them.
    low = F.when(was["radix_left"] == 200, 0).otherwise(200), F.when(was["radix_right"] == 8_000_000, 2_000_000).otherwise(0)
    body = F.concat(_padded(left, half), _padded(right, length - 1 - half))
    checked = let(body, lambda b: F.concat(b, F.get(F.filter(F.sequence(F.lit(0), F.lit(9)), lambda c: F.call_function("luhn_check", F.concat(b, c.cast("string")))), F.lit(0)).cast("string")))
    return (
        F.when(kind == "date", F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (left * DAYS[1] + right).cast("int")), "yyyy-MM-dd"))
        .when(kind == "ssn", F.concat_ws("-", _padded(area, 3), _padded(F.floor(right / 9999) + 1, 2), _padded(right % 9999 + 1, 4)))
        .when(kind == "ip", F.concat_ws(".", F.floor(left / 256), left % 256, F.floor(right / 256), right % 256))
        .when(kind == "phone", _refill(value, F.concat(_padded(left + low[0], 3), _padded(right + low[1], 7))))
        .when(kind == "card", _refill(value, checked))
    )


def pseudonym(value: Column, key: str) -> Column:
    """struct(kind, out) for a match of ANY; ``out`` is null where the value isn't valid."""

    def of(kind: Column) -> Column:
        mail = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, 16), F.lit("@example.invalid"))
        number = let(halves(kind, value), lambda h: F.when(h.isNotNull(), written(kind, value, feistel(h["left"], h["right"], h["radix_left"], h["radix_right"], key, F.concat_ws(":", kind, h["radix_left"], h["radix_right"])), h)))
        return F.struct(kind.alias("kind"), F.when(kind == "email", mail).otherwise(number).alias("out"))

    return let(kind_of(value), of)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text (with pseudonyms) and ``values``: struct(kind, was, out) for each value replaced."""
    out = docs.select("doc_id", _shared.whole_text().alias("text"))
    go = F.col("text").rlike("[0-9@]")
    out = out.withColumn("_found", F.when(go, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))))
    out = out.withColumn("_new", F.transform("_found", lambda m: F.struct(m.alias("was"), pseudonym(m, key).alias("p"))))
    pieces = F.arrays_zip(F.split("text", ANY, -1).alias("a"), F.col("_new").alias("b"))
    joined = F.array_join(F.transform(pieces, lambda z: F.concat(z["a"], F.coalesce(z["b"]["p"]["out"], z["b"]["was"], F.lit("")))), "")
    kept = F.filter(F.coalesce("_new", F.array().cast("array<struct<was:string,p:struct<kind:string,out:string>>>")), lambda x: x["p"]["out"].isNotNull())
    values = F.transform(kept, lambda x: F.struct(x["p"]["kind"].alias("kind"), x["was"].alias("was"), x["p"]["out"].alias("out")))
    return out.select("doc_id", F.when(F.size("_found") > 0, joined).otherwise(F.col("text")).alias("text"), values.alias("values"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str, key: str = "an example key; pass your own") -> DataFrame:
    found = pseudonymise(_shared.documents(spark, sf_dir), key)
    count = lambda kind: F.size(F.filter("values", lambda v: v["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in KINDS), F.array_join(F.transform("values", lambda v: v["out"]), ",").alias("pseudonyms"), "text")
