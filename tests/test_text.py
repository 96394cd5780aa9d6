import pytest
from pyspark.sql import functions as F

from scoreloom.functions import structural, text


def cleaned(spark, *essays):
    df = spark.createDataFrame([(i, e) for i, e in enumerate(essays)], "id int, essay string")
    return text.add_clean_columns(df)


def test_goldens(spark):
    rows = cleaned(spark, "[T] Olá, mãe! [P] [X] texto <i>", "[P] oi", "[X]", "[T] Olá [P] mãe [X]!", "a\r\nb\rc").orderBy("id").collect()
    assert [r.essay_clean for r in rows] == ["Olá, mãe!\ntexto <i>", "oi", "", "Olá\nmãe !", "a\nb\nc"]
    assert rows[2].clean_text_empty and rows[0].undocumented_marker_count == 1
    assert (rows[3].title_marker_count, rows[3].paragraph_marker_count, rows[3].erasure_marker_count) == (1, 1, 1)


def test_composed(spark):
    (r,) = cleaned(spark, "café").collect()
    assert r.essay_clean == "café" and r.character_count == 4


def test_idempotence(spark):
    text.check_idempotent(cleaned(spark, "fine", "[T] too"))
    with pytest.raises(AssertionError):
        text.check_idempotent(cleaned(spark, "[[X]P]"))


def test_tokens(spark):
    df = spark.createDataFrame([("Olá, mãe, café, e-mail",)], "t string")
    assert df.select(text.words(F.col("t"))).first()[0] == ["Olá", "mãe", "café", "e", "mail"]
    assert df.select(text.lexical_terms(text.lexical_words(F.col("t")))).first()[0][-1] == "café mail"


def test_structural(spark):
    rows = structural.structural(cleaned(spark, "Olá, mãe! 2 cães.\nOutra frase?", "", "um", "A1, B2?!", "x² ①")).orderBy("id").collect()
    r = rows[0]
    assert (r.word_count, r.sentence_count, r.paragraph_count, r.unique_word_count, r.lexical_diversity) == (6, 3, 2, 6, 1)
    assert (r.average_word_length, r.average_sentence_length_words, r.average_paragraph_length_words) == (21 / 6, 2, 3)
    assert (r.punctuation_count, r.comma_count, r.sentence_terminal_count, r.uppercase_ratio, r.digit_count) == (4, 1, 3, 0.1, 1)
    assert all(v == 0 for v in rows[1][1:]) and rows[2].paragraph_count == 1 and rows[3].digit_count == 2 and rows[4].digit_count == 2
    with pytest.raises(ValueError, match="word_count"):
        structural.structural(cleaned(spark, "a").drop("word_count"))


def test_inventory(spark):
    df = spark.createDataFrame([("train", "[P] <b> [P]"), ("test", "{x}")], "split string, essay string")
    rows = {tuple(r) for r in text.marker_inventory(df, "essay", "split").collect()}
    assert rows == {("train", "[P]", 2, "paragraph"), ("train", "<b>", 1, "undocumented"), ("test", "{x}", 1, "erasure")}
