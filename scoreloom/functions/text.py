"""Cleaning, marker and token functions on columns.

Character classes follow Python's: words are runs of letters, numbers and underscores; white space
has U+001C to U+001F. All but Unicode composition stays in the JVM.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The documented markers by group, in the order in which they are replaced.
MARKERS = {
    "paragraph": ["[P]", "[ P]", "[P}", "[p]", "{p}"],
    "title": ["[T]", "[t]", "{t}"],
    "erasure": ["[R]", "[X]", "[X~]", r"[X\~]", "[r]", "[x]", "{x}"],
    "symbol": ["[S]", "[s]"],
    "unknown": ["[?]", "{?}", "[?}", "{?]"],
    "out_of_line": ["[LC]", "[LT]", "[lt]"],
}
CANDIDATE = r"[\[{][^\[\]{}\n]{0,30}[\]}]|<[^<>\n]{1,30}>"
BETWEEN_WORDS = r"[^\p{L}\p{N}_]+"
SPACE = r"(?U)[\s\x1c-\x1f&&[^\n]]+"

#: How texts are cut up, for manifests.
TOKENS = "words are runs of Unicode letters, numbers and underscores; case and accents stay, no word is left out"
DOCUMENTED = [t for tokens in MARKERS.values() for t in tokens]


def marker_pattern(group: str) -> str:
    return "|".join(rf"\Q{t}\E" for t in sorted(MARKERS[group], key=len, reverse=True))


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def composed(text: Column) -> Column:
    """In normal form C. ASCII text is so already, and only other text goes to Python."""
    return F.coalesce(nfc(F.when(F.octet_length(text) != F.char_length(text), text)), text)


def _marked(group: str) -> str:
    """The group's pattern, tried only where a marker can begin."""
    return rf"(?=[\[{{])(?:{marker_pattern(group)})"


def clean(text: Column, compose: bool = True) -> Column:
    """Composed, with \\n line ends, markers replaced, white space collapsed and edges trimmed."""
    out = F.regexp_replace(composed(text) if compose else text, "\r\n?", "\n")
    for group in MARKERS:
        out = F.regexp_replace(out, _marked(group), "\n" if group == "paragraph" else " ")
    out = F.regexp_replace(F.regexp_replace(out, SPACE, " "), " *\n *", "\n")
    return F.regexp_replace(out, r"\A[ \n]+|[ \n]+\z", "")


def comparison_key(text: Column) -> Column:
    """Composed, white space collapsed and trimmed; markers and case stay."""
    return F.trim(F.regexp_replace(composed(text), r"(?U)[\s\x1c-\x1f]+", " "))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"\A(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+\z", "")


def count_of(text: Column, pattern: str) -> Column:
    """How often ``pattern``, which never matches nothing, matches: the pieces between matches are one more."""
    return (F.size(F.split(text, pattern, -1)) - 1).cast("long")


def count_chars(text: Column, others: str) -> Column:
    """How many characters are left without the runs of ``others``."""
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def marker_count(text: Column, group: str) -> Column:
    return count_of(text, _marked(group))


def candidates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def undocumented_count(text: Column) -> Column:
    return F.size(F.filter(candidates(text), lambda m: ~m.isin(DOCUMENTED))).cast("long")


def marker_columns(text: Column) -> dict[str, Column]:
    return {f"{g}_marker_count": marker_count(text, g) for g in MARKERS} | {"undocumented_marker_count": undocumented_count(text)}


def words(text: Column) -> Column:
    """Splitting at what stands between words takes a fraction of the time that collecting matches does."""
    return F.array_remove(F.split(text, BETWEEN_WORDS, -1), "")


def lexical_words(text: Column) -> Column:
    """The words of two characters or more."""
    return F.filter(F.split(text, BETWEEN_WORDS, -1), lambda w: F.char_length(w) > 1)


def bigrams(tokens: Column) -> Column:
    pair = lambda i: F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1))
    return F.when(F.size(tokens) > 1, F.transform(F.sequence(F.lit(0), F.size(tokens) - 2), pair)).otherwise(F.array().cast("array<string>"))


def lexical_terms(tokens: Column) -> Column:
    """The tokens, then their bigrams."""
    return F.concat(tokens, bigrams(tokens))


def add_clean_columns(df: DataFrame, essay: str = "essay", compose: bool = True) -> DataFrame:
    """Marker counts of the raw text, and essay_clean with its counts."""
    out = df.withColumns(marker_columns(F.col(essay))).withColumn("essay_clean", clean(F.col(essay), compose))
    c = F.col("essay_clean")
    return out.withColumns({"clean_text_empty": c == "", "character_count": F.char_length(c).cast("long"), "word_count": F.size(words(c)).cast("long")})


def not_idempotent(df: DataFrame, column: str = "essay_clean") -> DataFrame:
    """The rows that a second cleaning would change."""
    return df.where(~clean(F.col(column)).eqNullSafe(F.col(column)))


def check_idempotent(df: DataFrame) -> None:
    if not_idempotent(df).take(1):
        raise AssertionError("Cleaning is not idempotent")


def marker_dimension(spark: SparkSession) -> DataFrame:
    """token, group: the documented markers."""
    return spark.createDataFrame([(t, g) for g, tokens in MARKERS.items() for t in tokens], "token string, group string")


def marker_inventory(df: DataFrame, text: str, split: str) -> DataFrame:
    """dataset, token, occurrences, group of every marker candidate."""
    found = df.select(F.col(split).alias("dataset"), F.explode(candidates(F.col(text))).alias("token"))
    counts = found.groupBy("dataset", "token").agg(F.count("*").alias("occurrences"))
    named = counts.join(F.broadcast(marker_dimension(df.sparkSession)), "token", "left")  # 24 rows
    return named.select("dataset", "token", "occurrences", F.coalesce("group", F.lit("undocumented")).alias("group"))


def _ranges(points: list[int]) -> str:
    """A character class body of ascending code points, runs as ranges."""
    runs: list[list[int]] = []
    for p in points:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in runs)


#: isdigit also takes these, which are no decimal digits.
OTHER_DIGITS = _ranges([i for i in range(0x110000) if chr(i).isdigit() and unicodedata.category(chr(i)) != "Nd"])
NO_DIGITS = rf"[^\p{{Nd}}{OTHER_DIGITS}]+"
