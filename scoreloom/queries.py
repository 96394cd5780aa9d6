"""The library's registered queries over the driver's tables, and their SQL.

Documents stand for essays: the split follows doc_id % 10, the prompt is a benchmark text, and
markers are put into the text (``marked``), as the tables hold none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import structural, text
from .operators import contextual, lexical, models, pairs, validation, word2vec
from .plans import runs

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(key: str = "doc_id") -> Column:
    return F.when(F.col(key) % 10 < 6, "train").when(F.col(key) % 10 == 6, "valid").otherwise("test")


def essays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, split, id, essay (marked), prompt."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    n = items.count()
    marked = F.concat(F.lit("[T] "), F.replace("text", F.lit(". "), F.lit(". [P] ")))
    own = docs.select("doc_id", split_of().alias("split"), F.concat(F.lit("d"), F.col("doc_id")).alias("id"), marked.alias("essay"), F.pmod("doc_id", F.lit(max(n, 1))).alias("item_id"))
    return own.join(items.select("item_id", F.col("text").alias("prompt")), "item_id", "left").drop("item_id")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.add_clean_columns(essays(spark, sf_dir))


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, split, text as it is."""
    return table(spark, sf_dir, "documents").select("doc_id", split_of().alias("split"), "text")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, DIGITS).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# SQL that several queries share.
SPLIT = "CASE WHEN doc_id % 10 < 6 THEN 'train' WHEN doc_id % 10 = 6 THEN 'valid' ELSE 'test' END"
SPACES = r"\x1c-\x1f \t\x0b\f\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Upper-case characters that are no letters: Roman numerals, circled, squared and negative letters.
UPPERCASE = r"\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
WORD, LEXICAL = r"[\p{L}\p{N}_]+", r"[\p{L}\p{N}_]{2,}"


def _sql_pattern(group: str) -> str:
    return text.marker_pattern(group)


def _sql_clean(column: str) -> str:
    out = f"regexp_replace(nfc_normalize({column}), '\\r\\n?', chr(10), 'g')"
    for g in text.MARKERS:
        out = f"regexp_replace({out}, '{_sql_pattern(g)}', {'chr(10)' if g == 'paragraph' else chr(39) + ' ' + chr(39)}, 'g')"
    out = f"regexp_replace(regexp_replace({out}, '[{SPACES}]+', ' ', 'g'), ' *\\n *', chr(10), 'g')"
    return f"regexp_replace({out}, '\\A[ \\n]+|[ \\n]+\\z', '', 'g')"


def _sql_count(column: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({column}, '{pattern}')) AS BIGINT)"


_DOCUMENTED = "[" + ", ".join(f"'{t}'" for t in text.DOCUMENTED) + "]"
_UNDOCUMENTED = f"CAST(len(list_filter(regexp_extract_all(essay, '{text.CANDIDATE}'), lambda m: NOT list_contains({_DOCUMENTED}, m))) AS BIGINT)"
ESSAYS = f"""essays AS (SELECT doc_id, {SPLIT} AS split, 'd' || doc_id AS id, '[T] ' || replace(d.text, '. ', '. [P] ') AS essay, b.text AS prompt
  FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"""
CLEANED = f"""{ESSAYS}, cleaned AS (SELECT *, {_sql_clean('essay')} AS essay_clean, {', '.join(f"{_sql_count('essay', _sql_pattern(g))} AS {g}_marker_count" for g in text.MARKERS)},
  {_UNDOCUMENTED} AS undocumented_marker_count FROM essays)"""
_MARKERS = ", ".join([*(f"{g}_marker_count" for g in text.MARKERS), "undocumented_marker_count"])


@query("clean_documents", f"WITH {CLEANED} SELECT doc_id, essay_clean, essay_clean = '' AS clean_text_empty FROM cleaned")
def clean_documents(spark, sf_dir):
    return cleaned(spark, sf_dir).select("doc_id", "essay_clean", "clean_text_empty")


@query("clean_pages", f"SELECT page_id, {_sql_clean('html')} AS html_clean FROM pages")
def clean_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean(F.col("html")).alias("html_clean"))


@query("marker_counts", f"WITH {CLEANED} SELECT doc_id, {_MARKERS} FROM cleaned")
def marker_counts(spark, sf_dir):
    return essays(spark, sf_dir).withColumns(text.marker_columns(F.col("essay"))).select("doc_id", *text.marker_columns(F.col("essay")))


_GROUPS = ", ".join(f"('{t}', '{g}')" for g, tokens in text.MARKERS.items() for t in tokens)


@query(
    "marker_inventory",
    f"""WITH t AS (SELECT page_id % 3 AS part, unnest(regexp_extract_all(html, '{text.CANDIDATE}')) AS token FROM pages), m(token, "group") AS (VALUES {_GROUPS})
SELECT 'part' || part AS dataset, t.token, count(*) AS occurrences, coalesce("group", 'undocumented') AS "group" FROM t LEFT JOIN m USING (token) GROUP BY ALL""",
)
def marker_inventory(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("html", F.concat(F.lit("part"), F.col("page_id") % 3).alias("split"))
    return text.marker_inventory(pages, "html", "split")


@query("undocumented_markers", f"SELECT page_id, {_UNDOCUMENTED.replace('essay', 'html')} AS undocumented_marker_count FROM pages")
def undocumented_markers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.undocumented_count(F.col("html")).alias("undocumented_marker_count"))


@query(
    "cleaning_summary",
    f"""WITH {CLEANED} SELECT split AS dataset, count(*) AS rows, count(*) FILTER (essay <> essay_clean) AS changed, count(*) FILTER (essay_clean = '') AS empty,
  CAST(sum(length(essay) - length(essay_clean)) AS BIGINT) AS characters_removed FROM cleaned GROUP BY split""",
)
def cleaning_summary(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return c.groupBy(F.col("split").alias("dataset")).agg(
        F.count("*").alias("rows"), F.sum((F.col("essay") != F.col("essay_clean")).cast("long")).alias("changed"), F.sum(F.col("clean_text_empty").cast("long")).alias("empty"),
        F.sum((F.char_length("essay") - F.col("character_count")).cast("long")).alias("characters_removed"),
    )


@query("cleaning_idempotence", f"WITH {CLEANED} SELECT count(*) AS rows, count(*) FILTER ({_sql_clean('essay_clean')} <> essay_clean) AS changed_again FROM cleaned")
def cleaning_idempotence(spark, sf_dir):
    again = text.clean(F.col("essay_clean")) != F.col("essay_clean")
    return cleaned(spark, sf_dir).agg(F.count("*").alias("rows"), F.coalesce(F.sum(again.cast("long")), F.lit(0)).alias("changed_again"))


@query("doc_counts", f"WITH {CLEANED} SELECT doc_id, length(essay_clean) AS character_count, {_sql_count('essay_clean', WORD)} AS word_count FROM cleaned")
def doc_counts(spark, sf_dir):
    return cleaned(spark, sf_dir).select("doc_id", "character_count", "word_count")


def _audited(spark, sf_dir):
    """Essays with faults: some ids repeat, some texts are blank."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        split_of().alias("split"), F.when(F.col("doc_id") % 97 == 0, "").otherwise(F.concat(F.lit("d"), F.floor(F.col("doc_id") / 10) * 10 + F.when(F.col("doc_id") % 50 == 1, 0).otherwise(F.col("doc_id") % 10))).alias("id"),
        F.when(F.col("doc_id") % 89 == 0, "  ").otherwise(F.col("text")).alias("essay"), F.col("lang").alias("prompt"), F.col("doc_id").alias("position"),
    )


_AUDITED = f"""a AS (SELECT {SPLIT} AS split, CASE WHEN doc_id % 97 = 0 THEN '' ELSE 'd' || (doc_id // 10 * 10 + CASE WHEN doc_id % 50 = 1 THEN 0 ELSE doc_id % 10 END) END AS id,
  CASE WHEN doc_id % 89 = 0 THEN '  ' ELSE text END AS essay, lang AS prompt, doc_id AS position FROM documents)"""


@query(
    "validation_diagnostics",
    f"""WITH {_AUDITED}, n AS (SELECT *, count(*) OVER (PARTITION BY split, id) AS same FROM a)
SELECT split AS dataset, count(*) AS rows, CAST(3 AS BIGINT) AS columns, count(*) FILTER (trim(id) = '') AS empty_ids, count(*) FILTER (same > 1) AS duplicate_id_rows,
  count(*) FILTER (trim(essay) = '') AS empty_essays, count(*) FILTER (trim(prompt) = '') AS empty_prompts,
  count(*) - count(DISTINCT (id, essay, prompt)) AS duplicate_rows, count(*) - count(DISTINCT essay) AS duplicate_essays FROM n GROUP BY split""",
)
def validation_diagnostics(spark, sf_dir):
    return validation.diagnostics(_audited(spark, sf_dir).drop("position"))


_SCORES = ["'1'", "'5.0'", "'3d'", "' 2 '", "'9'", "''", "'4e0'", "'nan'"]


@query(
    "score_domain_check",
    f"""WITH s AS (SELECT {SPLIT} AS split, list_extract([{', '.join(_SCORES)}], CAST((doc_id + quality) % 8 + 1 AS BIGINT)) AS a, CAST(quality + 1 + 4 * toxic AS VARCHAR) AS b FROM labels),
l AS (SELECT split, 'formal_register' AS target, a AS v FROM s UNION ALL SELECT split, 'cohesion', b FROM s)
SELECT split AS dataset, target, count(*) FILTER (NOT coalesce(TRY_CAST(trim(v) AS DOUBLE) IN (1, 2, 3, 4, 5), false)) AS invalid FROM l WHERE split <> 'test' GROUP BY ALL""",
)
def score_domain_check(spark, sf_dir):
    values = F.array(*(F.lit(s.strip("'")) for s in _SCORES))
    d = table(spark, sf_dir, "labels").select(split_of().alias("split"), F.get(values, ((F.col("doc_id") + F.col("quality")) % 8).cast("int")).alias("formal_register"), (F.col("quality") + 1 + 4 * F.col("toxic")).cast("string").alias("cohesion"))
    return validation.invalid_scores(d, ("formal_register", "cohesion"))


@query("shared_ids", f"WITH {_AUDITED}, u AS (SELECT DISTINCT split, id FROM a) SELECT x.split AS first, y.split AS second, x.id FROM u x JOIN u y ON x.id = y.id AND x.split < y.split")
def shared_ids(spark, sf_dir):
    return validation.shared_ids(_audited(spark, sf_dir))


@query(
    "duplicate_report",
    f"""WITH {_AUDITED}, k AS (SELECT *, trim(regexp_replace(nfc_normalize(essay), '[\\n{SPACES}]+', ' ', 'g')) AS key FROM a),
g AS (SELECT *, count(*) OVER (PARTITION BY key) AS n, min(position) OVER (PARTITION BY key) AS first, min(split) OVER (PARTITION BY key) <> max(split) OVER (PARTITION BY key) AS across_datasets FROM k WHERE key <> '')
SELECT dense_rank() OVER (ORDER BY first) AS "group", split AS dataset, id, across_datasets, position FROM g WHERE n > 1""",
)
def duplicate_report(spark, sf_dir):
    return validation.duplicate_report(_audited(spark, sf_dir))


@query("tokens_all", f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n, sha256(array_to_string(w, ' ')) AS tokens_sha256 FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS w FROM documents)")
def tokens_all(spark, sf_dir):
    w = plain(spark, sf_dir).select("doc_id", text.words(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("long").alias("n"), F.sha2(F.array_join("w", " "), 256).alias("tokens_sha256"))


@query("tokens_lexical", f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n, sha256(array_to_string(w, ' ')) AS tokens_sha256 FROM (SELECT doc_id, regexp_extract_all(text, '{LEXICAL}') AS w FROM documents)")
def tokens_lexical(spark, sf_dir):
    w = plain(spark, sf_dir).select("doc_id", text.lexical_words(F.col("text")).alias("w"))
    return w.select("doc_id", F.size("w").cast("long").alias("n"), F.sha2(F.array_join("w", " "), 256).alias("tokens_sha256"))


@query(
    "bigrams",
    f"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '{LEXICAL}') AS w FROM documents)
SELECT doc_id, CAST(greatest(len(w) - 1, 0) AS BIGINT) AS n, sha256(array_to_string(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), '|')) AS bigrams_sha256 FROM t""",
)
def bigrams(spark, sf_dir):
    w = plain(spark, sf_dir).select("doc_id", text.lexical_words(F.col("text")).alias("w")).select("doc_id", text.bigrams(F.col("w")).alias("b"))
    return w.select("doc_id", F.size("b").cast("long").alias("n"), F.sha2(F.array_join("b", "|"), 256).alias("bigrams_sha256"))


COUNTS = f"""tok AS (SELECT doc_id, {SPLIT} AS split, regexp_extract_all(text, '{LEXICAL}') AS w FROM documents),
term AS (SELECT doc_id, split, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM tok),
counts AS (SELECT doc_id, split, term, count(*) AS n FROM term GROUP BY ALL),
vocab AS (SELECT row_number() OVER (ORDER BY term) - 1 AS term_idx, term, df, ln((1.0 + (SELECT count(*) FROM tok WHERE split = 'train')) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT term, count(*) AS df FROM counts WHERE split = 'train' GROUP BY term) WHERE df >= 2),
bow AS (SELECT doc_id, split, term_idx, n, n * idf AS weight FROM counts JOIN vocab USING (term))"""


def _counts(spark, sf_dir) -> DataFrame:
    return lexical.term_counts(plain(spark, sf_dir), "doc_id", "text")


def _vocabulary(spark, sf_dir) -> DataFrame:
    return lexical.fit_vocabulary(plain(spark, sf_dir), "doc_id", "text")


@query("vocabulary", f"WITH {COUNTS} SELECT term_idx, term, df FROM vocab")
def vocabulary(spark, sf_dir):
    return _vocabulary(spark, sf_dir)


@query("document_frequency", f"WITH {COUNTS} SELECT df, count(*) AS terms, round(max(idf), {DIGITS}) AS idf FROM vocab GROUP BY df")
def document_frequency(spark, sf_dir):
    n = plain(spark, sf_dir).where("split = 'train'").count()
    return rounded(lexical.with_idf(_vocabulary(spark, sf_dir), n).groupBy("df").agg(F.count("*").alias("terms"), F.max("idf").alias("idf")))


@query("bow", f"WITH {COUNTS} SELECT doc_id, split, term_idx, n AS value FROM bow")
def bow(spark, sf_dir):
    return lexical.bow(_counts(spark, sf_dir), _vocabulary(spark, sf_dir), "doc_id")


@query("tf", f"WITH {COUNTS} SELECT doc_id, split, term_idx, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), {DIGITS}) AS value FROM bow")
def tf(spark, sf_dir):
    return rounded(lexical.tf(_counts(spark, sf_dir), _vocabulary(spark, sf_dir), "doc_id"))


def _tfidf(spark, sf_dir) -> DataFrame:
    n_train = plain(spark, sf_dir).where("split = 'train'").count()
    return rounded(lexical.tfidf(_counts(spark, sf_dir), _vocabulary(spark, sf_dir), "doc_id", n_train))


_TFIDF = f"SELECT doc_id, split, term_idx, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), {DIGITS}) AS value FROM bow"


@query("tfidf", f"WITH {COUNTS} {_TFIDF}")
def tfidf(spark, sf_dir):
    return _tfidf(spark, sf_dir)


@query("tfidf_transform_valid", f"WITH {COUNTS}, w AS ({_TFIDF}) SELECT tok.doc_id, count(term_idx) AS known_terms, round(coalesce(sum(value * value), 0), 6) AS squared_norm FROM tok LEFT JOIN w ON tok.doc_id = w.doc_id WHERE tok.split = 'valid' GROUP BY tok.doc_id")
def tfidf_transform_valid(spark, sf_dir):
    docs = plain(spark, sf_dir).where("split = 'valid'").select("doc_id")
    held = docs.join(_tfidf(spark, sf_dir).where("split = 'valid'"), "doc_id", "left")
    return held.groupBy("doc_id").agg(F.count("term_idx").alias("known_terms"), F.round(F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)), 6).alias("squared_norm"))


@query("lexical_shapes", f"WITH {COUNTS} SELECT split, count(*) AS rows, (SELECT count(*) FROM vocab) AS feature_dimension FROM tok GROUP BY split")
def lexical_shapes(spark, sf_dir):
    return lexical.shapes(plain(spark, sf_dir), _vocabulary(spark, sf_dir))


def _sql_ratio(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"


_F = {
    "character_count": "length(essay_clean)", "word_count": "len(w)", "sentence_count": "s", "paragraph_count": "p", "unique_word_count": "u", "lexical_diversity": _sql_ratio("u", "len(w)"),
    "average_word_length": _sql_ratio("length(array_to_string(w, ''))", "len(w)"), "average_sentence_length_words": _sql_ratio("len(w)", "s"), "average_paragraph_length_words": _sql_ratio("len(w)", "p"),
    "punctuation_count": _sql_count("essay_clean", rf"[^\p{{L}}\p{{N}}\n{SPACES}]"), "comma_count": _sql_count("essay_clean", ","), "sentence_terminal_count": "e",
    "uppercase_ratio": _sql_ratio(_sql_count("essay_clean", rf"[\p{{Lu}}{UPPERCASE}]"), _sql_count("essay_clean", r"\p{L}")), "digit_count": _sql_count("essay_clean", rf"[\p{{Nd}}{text.OTHER_DIGITS}]"),
}


@query(
    "structural_features",
    f"""WITH {CLEANED}, f AS (SELECT *, regexp_extract_all(essay_clean, '{WORD}') AS w, {_sql_count('essay_clean', '[.!?]+')} AS e FROM cleaned),
g AS (SELECT *, len(list_distinct(w)) AS u, CASE WHEN essay_clean = '' THEN 0 ELSE greatest(1, e) END AS s, len(list_filter(string_split(essay_clean, chr(10)), lambda x: trim(x) <> '')) AS p FROM f)
SELECT doc_id, {', '.join(f"round(CAST({_F.get(n, n)} AS DOUBLE), {DIGITS}) AS {n}" for n in structural.NAMES)} FROM g""",
)
def structural_features(spark, sf_dir):
    return rounded(structural.structural(cleaned(spark, sf_dir), ("doc_id",)))


@query(
    "pair_overlap",
    f"""WITH {CLEANED}, t AS (SELECT doc_id, list_distinct(regexp_extract_all(essay_clean, '{WORD}')) AS e, list_distinct(regexp_extract_all({_sql_clean('prompt')}, '{WORD}')) AS p FROM cleaned),
n AS (SELECT doc_id, len(e) AS e, len(p) AS p, CAST(len(list_intersect(e, p)) AS BIGINT) AS n FROM t)
SELECT doc_id, n AS shared_token_count, round({_sql_ratio('n', '(e + p - n)')}, {DIGITS}) AS essay_prompt_token_jaccard, round({_sql_ratio('n', 'p')}, {DIGITS}) AS prompt_token_coverage FROM n""",
)
def pair_overlap(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("prompt_clean", text.clean(F.col("prompt")))
    return rounded(pairs.overlap(df, "essay_clean", "prompt_clean", ("doc_id",)))


@query(
    "pair_tfidf_cosine",
    f"""WITH {COUNTS}, w AS (SELECT doc_id, term_idx, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS value FROM bow),
pt AS (SELECT item_id, regexp_extract_all(text, '{LEXICAL}') AS w FROM benchmark),
pc AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM pt) GROUP BY ALL),
pw AS (SELECT item_id, term_idx, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY item_id)) AS value FROM pc JOIN vocab USING (term)),
dots AS (SELECT w.doc_id, sum(w.value * pw.value) AS d FROM w JOIN pw ON pw.term_idx = w.term_idx AND pw.item_id = w.doc_id % (SELECT count(*) FROM benchmark) GROUP BY w.doc_id)
SELECT tok.doc_id, round(coalesce(d, 0.0), {DIGITS}) AS tfidf_cosine_similarity FROM tok LEFT JOIN dots ON tok.doc_id = dots.doc_id""",
)
def pair_tfidf_cosine(spark, sf_dir):
    own = essays(spark, sf_dir).select("doc_id", "prompt").join(plain(spark, sf_dir), "doc_id")
    return rounded(pairs.tfidf_cosine(own, "doc_id", "text", "prompt"))


@query(
    "embedding_mean_pool",
    f"""SELECT label, i, round(avg(CAST(x AS DOUBLE)), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL""",
)
def embedding_mean_pool(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    e = table(spark, sf_dir, "embeddings").select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    means = e.groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("m"))
    return means.select("label", F.posexplode("m").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("mean"))


@query(
    "embedding_cosine",
    """SELECT a.vec_id, round(coalesce(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / nullif(sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 0), 0), 6) AS cosine
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def embedding_cosine(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(other, "vec_id").select("vec_id", F.round(pairs.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


_KNOWN = f"""t AS (SELECT doc_id, {SPLIT} AS split, regexp_extract_all(text, '{WORD}') AS w FROM documents), v AS (SELECT DISTINCT unnest(w) AS word FROM t WHERE split = 'train'),
u AS (SELECT doc_id, split, unnest(w) AS word FROM t), k AS (SELECT u.doc_id, u.split, count(*) AS n, count(v.word) AS known FROM u LEFT JOIN v USING (word) GROUP BY ALL),
d AS (SELECT t.doc_id, t.split, coalesce(n, 0) AS n, coalesce(known, 0) AS known FROM t LEFT JOIN k ON t.doc_id = k.doc_id)"""


@query("coverage_stats", f"WITH {_KNOWN} SELECT split, CAST(sum(n) AS BIGINT) AS token_count, CAST(sum(known) AS BIGINT) AS known_token_count, count(*) FILTER (known = 0) AS zero_vector_documents, round({_sql_ratio('sum(known)', 'sum(n)')}, {DIGITS}) AS token_coverage FROM d GROUP BY split")
def coverage_stats(spark, sf_dir):
    own = plain(spark, sf_dir)
    known = own.where("split = 'train'").select(F.explode(text.words(F.col("text"))).alias("word")).distinct().withColumn("vector", F.array(F.lit(1.0).cast("float")))
    return rounded(word2vec.coverage(own.select("doc_id", "split").join(word2vec.pool(own, "doc_id", "text", known), "doc_id")))


@query("zero_comparisons", f"WITH {CLEANED}, t AS (SELECT split, regexp_extract_all(essay_clean, '{WORD}') AS e, regexp_extract_all({_sql_clean('prompt')}, '{WORD}') AS p FROM cleaned) SELECT split, CAST(count(*) FILTER (len(list_intersect(e, p)) = 0) AS BIGINT) AS shared_token_count_zero FROM t GROUP BY split")
def zero_comparisons(spark, sf_dir):
    df = cleaned(spark, sf_dir).withColumn("prompt_clean", text.clean(F.col("prompt")))
    return pairs.zero_comparisons(pairs.overlap(df, "essay_clean", "prompt_clean", ("split",)), ("shared_token_count",))


LIMIT = 512


@query(
    "token_length_stats",
    f"""WITH t AS (SELECT {SPLIT} AS split, len(regexp_extract_all(text, '{WORD}')) AS n FROM documents)
SELECT split, CAST(min(n) AS BIGINT) AS min, quantile_cont(n, 0.5) AS median, round(avg(n), {DIGITS}) AS mean, round(quantile_cont(n, 0.9), {DIGITS}) AS p90, round(quantile_cont(n, 0.95), {DIGITS}) AS p95, round(quantile_cont(n, 0.99), {DIGITS}) AS p99,
  CAST(max(n) AS BIGINT) AS max, round(avg(CASE WHEN n > {LIMIT} THEN 100.0 ELSE 0.0 END), {DIGITS}) AS over_max FROM t GROUP BY split""",
)
def token_length_stats(spark, sf_dir):
    own = plain(spark, sf_dir).select("split", F.size(text.words(F.col("text"))).alias("n"))
    return rounded(contextual.length_statistics(own, "n", LIMIT))


@query(
    "chunk_counts",
    f"""WITH t AS (SELECT doc_id, len(regexp_extract_all(text, '{WORD}')) AS n FROM documents)
SELECT doc_id, CAST(greatest(1, ceil(n / {LIMIT - 2}.0)) AS BIGINT) AS n_chunks, CAST(CASE WHEN n = 0 THEN 0 ELSE (n - 1) % {LIMIT - 2} + 1 END AS BIGINT) AS last_length FROM t""",
)
def chunk_counts(spark, sf_dir):
    c = plain(spark, sf_dir).select("doc_id", contextual.chunks(text.words(F.col("text")), LIMIT - 2).alias("c"))
    return c.select("doc_id", F.size("c").cast("long").alias("n_chunks"), F.size(F.element_at("c", -1)).cast("long").alias("last_length"))


@query("row_alignment_hash", f"SELECT split, count(*) AS count, sha256(string_agg('d' || doc_id, '\\n' ORDER BY doc_id)) AS sha256 FROM (SELECT *, {SPLIT} AS split FROM documents) GROUP BY split")
def row_alignment_hash(spark, sf_dir):
    return runs.id_hashes(plain(spark, sf_dir).select("split", F.col("doc_id").alias("row_idx"), F.concat(F.lit("d"), F.col("doc_id")).alias("id")))


@query(
    "alignment_check",
    f"""WITH a AS (SELECT {SPLIT} AS split, doc_id AS row_idx, 'd' || doc_id AS id FROM documents WHERE doc_id % 17 <> 0), b AS (SELECT {SPLIT} AS split, doc_id AS row_idx, 'd' || (doc_id - CASE WHEN doc_id % 23 = 0 THEN 1 ELSE 0 END) AS id FROM documents WHERE doc_id % 19 <> 0)
SELECT split, row_idx, a.id AS left_id, b.id AS right_id FROM a FULL JOIN b USING (split, row_idx) WHERE a.id IS DISTINCT FROM b.id""",
)
def alignment_check(spark, sf_dir):
    d = plain(spark, sf_dir)
    a = d.where("doc_id % 17 <> 0").select("split", F.col("doc_id").alias("row_idx"), F.concat(F.lit("d"), F.col("doc_id")).alias("id"))
    b = d.where("doc_id % 19 <> 0").select("split", F.col("doc_id").alias("row_idx"), F.concat(F.lit("d"), F.col("doc_id") - (F.col("doc_id") % 23 == 0).cast("int")).alias("id"))
    return runs.misaligned(a, b).select("split", "row_idx", F.col("_a").alias("left_id"), F.col("_b").alias("right_id"))


_PREDICTED = "p AS (SELECT 't' || k AS target, 1 + doc_id % 5 AS y, n_chars / 700.0 + k AS prediction FROM documents, (SELECT unnest(range(4)) AS k))"
_METRICS = "m AS (SELECT target, sqrt(avg(pow(y - greatest(least(prediction, 5.0), 1.0), 2))) AS rmse, avg(abs(y - greatest(least(prediction, 5.0), 1.0))) AS mae FROM p GROUP BY target)"


def _predicted(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select((1 + F.col("doc_id") % 5).alias("y"), (F.col("n_chars") / F.lit(700.0)).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    return d.select(F.concat(F.lit("t"), F.col("k")).alias("target"), "y", (F.col("x") + F.col("k")).alias("prediction"))


@query("regression_metrics", f"WITH {_PREDICTED}, {_METRICS} SELECT target, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM m")
def regression_metrics(spark, sf_dir):
    return models.metrics(_predicted(spark, sf_dir), "target").select("target", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query("overall_metrics", f"WITH {_PREDICTED}, {_METRICS} SELECT round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae FROM m")
def overall_metrics(spark, sf_dir):
    return models.overall(models.metrics(_predicted(spark, sf_dir), "target")).select(F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def _scored(spark, sf_dir) -> DataFrame:
    f = structural.structural(cleaned(spark, sf_dir), ("doc_id", "split"))
    return f.withColumn("y", 1 + F.col("doc_id") % 5)


@query(
    "ridge_fit",
    f"""WITH t AS (SELECT len(string_split(text, chr(10))) AS x, 1 + doc_id % 5 AS y FROM documents WHERE doc_id % 10 < 6),
s AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n, sum(x * y) AS xy, sum(x * x) AS xx FROM t)
SELECT round((xy - n * mx * my) / (xx - n * mx * mx + 1.0), 6) AS weight, round(my - mx * (xy - n * mx * my) / (xx - n * mx * mx + 1.0), 6) AS intercept FROM s""",
)
def ridge_fit(spark, sf_dir):
    d = plain(spark, sf_dir).where("split = 'train'").select(F.size(F.split("text", "\n")).alias("x"), (1 + F.col("doc_id") % 5).alias("y"))
    found = models.ridge_gram(d, ["x"], "y")
    return spark.createDataFrame([(round(found["x"], 6), round(found["intercept"], 6))], "weight double, intercept double")


def _rated(spark, sf_dir) -> DataFrame:
    """A collection of the size that the models are meant for: the labelled documents, structural features, four ratings."""
    names = structural.NAMES
    labels = table(spark, sf_dir, "labels")
    f = structural.structural(cleaned(spark, sf_dir).join(labels, "doc_id"), ("doc_id", "split", "quality"))
    rated = {t: (1 + F.pmod(F.col("doc_id") + i, F.lit(3)) + 2 * F.col("quality")).cast("long") for i, t in enumerate(models.TARGETS)}
    return f.select("split", F.col("doc_id").alias("row_idx"), F.array(*(F.log1p(n) for n in names)).alias("features"), *(c.alias(t) for t, c in rated.items()))


@query("grid_results")
def grid_results(spark, sf_dir):
    return rounded(models.metrics(models.fit_and_predict(_rated(spark, sf_dir), "ridge", models.grid("ridge")), "point", "target"))


@query("svr_fit")
def svr_fit(spark, sf_dir):
    params = models.parameters("linear_svr")[0]
    return rounded(models.metrics(models.fit_and_predict(_rated(spark, sf_dir), "linear_svr", [params]), "target"))


@query("svr_grid_results")
def svr_grid_results(spark, sf_dir):
    return rounded(models.metrics(models.fit_and_predict(_rated(spark, sf_dir), "linear_svr", models.grid("linear_svr")), "point", "target"))


@query("word2vec_docs")
def word2vec_docs(spark, sf_dir):
    own = plain(spark, sf_dir)
    vectors = word2vec.fit(own.where("split = 'train'"), "text", word2vec.Word2VecConfig(architecture="skipgram", workers=8), "doc_id")
    return word2vec.pool(own, "doc_id", "text", vectors)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
