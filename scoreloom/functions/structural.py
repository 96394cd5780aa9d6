"""The 21 structural features of a cleaned essay, each a column expression: no fit, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

# The features in their order.
NAMES = (
    "character_count", "word_count", "sentence_count", "paragraph_count", "unique_word_count", "lexical_diversity", "average_word_length", "average_sentence_length_words",
    "average_paragraph_length_words", "punctuation_count", "comma_count", "sentence_terminal_count", "uppercase_ratio", "digit_count", "paragraph_marker_count", "title_marker_count",
    "erasure_marker_count", "symbol_marker_count", "unknown_marker_count", "out_of_line_marker_count", "undocumented_marker_count",
)
#: What each counts, over the cleaned essay; ratios are zero where nothing stands below the line.
DEFINITIONS = {
    "character_count": "code points", "word_count": "words", "sentence_count": "runs of . ! or ?, and one at least in a text that is not empty", "paragraph_count": "lines that are not blank",
    "unique_word_count": "distinct words", "lexical_diversity": "distinct words for each word", "average_word_length": "code points of words for each word",
    "average_sentence_length_words": "words for each sentence", "average_paragraph_length_words": "words for each paragraph", "punctuation_count": "code points that are no letter, number or space",
    "comma_count": "commas", "sentence_terminal_count": "runs of . ! or ?", "uppercase_ratio": "uppercase code points for each letter", "digit_count": "digits of any script",
} | {n: f"markers in the raw essay: {n.removesuffix('_marker_count')}" for n in NAMES[14:]}
NEEDED = ("essay_clean", "character_count", "word_count", *NAMES[14:])


def ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def structural(df: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``keep`` and the features, as doubles, of a cleaned frame."""
    if missing := sorted(set(NEEDED) - set(df.columns)):
        raise ValueError(f"Missing structural columns: {missing}")
    c = F.col("essay_clean")
    own = df.withColumns({"_tokens": T.words(c), "_ends": T.count_of(c, r"[.!?]+")})
    own = own.withColumns({
        "_sentences": F.when(c == "", 0).otherwise(F.greatest(F.lit(1), F.col("_ends"))),
        "_paragraphs": F.size(F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")),
        "_unique": F.size(F.array_distinct("_tokens")),
        "_letters": F.aggregate("_tokens", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)),
    })
    n = F.col("word_count")
    values = {
        "sentence_count": F.col("_sentences"), "paragraph_count": F.col("_paragraphs"), "unique_word_count": F.col("_unique"), "lexical_diversity": ratio(F.col("_unique"), n),
        "average_word_length": ratio(F.col("_letters"), n), "average_sentence_length_words": ratio(n, F.col("_sentences")), "average_paragraph_length_words": ratio(n, F.col("_paragraphs")),
        "punctuation_count": T.count_chars(c, r"(?U)[\p{L}\p{N}\s\x1c-\x1f]+"), "comma_count": T.count_chars(c, "[^,]+"), "sentence_terminal_count": F.col("_ends"),
        "uppercase_ratio": ratio(T.count_chars(c, r"\P{IsUppercase}+"), T.count_chars(c, r"\P{L}+")), "digit_count": T.count_chars(c, T.NO_DIGITS),
    }
    return own.select(*keep, *(values.get(name, F.col(name)).cast("double").alias(name) for name in NAMES))
