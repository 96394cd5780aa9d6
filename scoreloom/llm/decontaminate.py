"""Benchmark decontamination by a distributed positional inverted index.

One pass over the training texts stores the postings (row, position, term) of every word that a test text has.
Test texts are cut into windows of consecutive words; a window's terms are put in order of their postings'
number, the rarest first. The postings of the rarest term, moved by the term's place in the window, give the
candidate places; the moved list of the next term is intersected with them, then those of all others. What is
left are the exact occurrences. Proximity matches come from the same postings. Everything is built from DataFrame functions.

Cases: null or wordless texts have no words and are never contaminated; a repeated row of ``docs`` gives a row
for each; test rows with one item_id are one item; items whose id is null count as one item, which the list of
ids leaves out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared
from ._shared import SMALL_ROWS, bounded

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, of lower-cased text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words in order; only A-Z change case. Plain ASCII takes the faster function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, words: each run of ``size`` words; shorter items whole."""
    held = items.select("item_id", words(_shared.whole_text()).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    return held.select("item_id", "w", F.explode(starts).alias("start")).select("item_id", F.slice("w", F.col("start") + 1, F.lit(size)).alias("words"))


@dataclass
class Index:
    """``table``: row, the kept columns, n_words, pos, code, a row for each posting and for each document's first word or none.

    ``terms``: term, code. ``small``: the rows that a join may broadcast.
    """

    table: DataFrame
    terms: DataFrame
    small: int = SMALL_ROWS

    @property
    def postings(self) -> DataFrame:
        return self.table.where("code is not null").select("row", "pos", "code")

    def documents(self, *keep: str) -> DataFrame:
        """row, ``keep`` and n_words, a row for each document."""
        return self.table.where("pos is null or pos = 0").select("row", *keep, "n_words")


def index(docs: DataFrame, terms: DataFrame, keep: tuple[str, ...] = ("doc_id",), small: int = SMALL_ROWS) -> Index:
    """The stored postings of ``terms`` (term) in ``docs``: each text is read and split once."""
    terms = _shared.stored(terms.select("term").distinct(), "vocabulary")
    terms = _shared.stored(terms.withColumn("code", F.monotonically_increasing_id()), "terms")
    own = docs.select(F.monotonically_increasing_id().alias("row"), *keep, words(_shared.whole_text()).alias("w"))
    # The count comes first, so that the words themselves aren't carried along with each posting.
    own = own.select("row", *keep, F.size("w").cast("long").alias("n_words"), "w")
    own = own.select("row", *keep, "n_words", F.posexplode_outer("w").alias("pos", "term"))
    coded = own.join(bounded(terms, "term", small), "term", "left").where("code is not null or pos is null or pos = 0")
    return Index(_shared.stored(coded.select("row", *keep, "n_words", "pos", "code"), "postings"), terms, small)


def phrases(tests: DataFrame, held: Index) -> tuple[DataFrame, DataFrame]:
    """(phrase, size, terms: its (n, place, code), rarest first; phrase, item_id) of the windows ``tests`` whose terms all occur."""
    named = _shared.stored(tests.select("words").distinct(), "windows")
    named = _shared.stored(named.withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    counts = held.postings.groupBy("code").agg(F.count("*").alias("n")).join(held.terms, "code")
    at = named.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("place", "term")).join(counts, "term")
    told = at.groupBy("phrase", "size").agg(F.array_sort(F.collect_list(F.struct("n", "place", "code"))).alias("terms"))
    # An array of as many terms as the window has words; others lack a term in the corpus.
    told = _shared.stored(told.where(F.size("terms") == F.col("size")), "rarest")
    owners = _shared.stored(tests.distinct().join(named, "words").select("phrase", "item_id").distinct(), "owners")
    return told, owners


def phrase_matches(held: Index, told: DataFrame) -> DataFrame:
    """row, phrase, begin, size: every occurrence of the phrases ``told``, stored."""
    term = lambda i: [F.get("terms", F.lit(i))["code"].alias("code"), F.get("terms", F.lit(i))["place"].alias("place")]
    post = held.postings
    first = bounded(told.select("phrase", "size", *term(0)), rows=held.small)
    found = post.join(first, "code").where("pos >= place").select("row", "phrase", "size", (F.col("pos") - F.col("place")).alias("begin"))
    second = told.where("size > 1").select("phrase", *term(1))
    needed = bounded(_shared.stored(second.select("code").distinct(), "codes"), rows=held.small)
    cells = ("row", "phrase", "begin", "size")
    moved = found.join(bounded(second, rows=held.small), "phrase").select(*cells, "code", (F.col("begin") + F.col("place")).alias("pos"))
    left = _shared.stored(moved.join(post.join(needed, "code", "left_semi"), ["row", "pos", "code"], "left_semi").select(*cells), "candidates")
    rest = told.where("size > 2").select("phrase", F.explode(F.slice("terms", 3, F.col("size"))).alias("t")).select("phrase", "t.code", "t.place")
    wanted = left.join(bounded(rest, rows=held.small), "phrase").select(*cells, "code", (F.col("begin") + F.col("place")).alias("pos"))
    # Lists of frequent terms are read only in documents with a candidate, where those are few.
    rows = _shared.stored(left.where("size > 2").select("row").distinct(), "rows")
    near = bounded(rows, rows=held.small)
    lists = post if near is rows else post.join(near, "row", "left_semi")
    met = wanted.join(lists, ["row", "pos", "code"]).groupBy(*cells).agg(F.count("*").alias("n")).where("n = size - 2").select(*cells)
    return _shared.stored(met.unionByName(left.where("size = 2")).unionByName(found.where("size = 1").select(*cells)), "occurrences")


def hit_words(spans: Column) -> Column:
    """How many places the spans (begin, stop) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))

    def add(held: Column, s: Column) -> Column:
        new = F.greatest(s["stop"] - F.greatest(s["begin"], held["stop"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(held["stop"], s["stop"]).alias("stop"), (held["n"] + new).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def report(held: Index, found: DataFrame, owners: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document from the occurrences ``found`` of the phrases that ``owners`` have."""
    span = F.struct(F.col("begin").cast("long").alias("begin"), (F.col("begin") + F.col("size")).cast("long").alias("stop"))
    hits = found.groupBy("row").agg(hit_words(F.collect_set(span)).alias("n_hit"))
    items = found.select("row", "phrase").distinct().join(bounded(owners, rows=held.small), "phrase").groupBy("row").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"), F.max(F.col("item_id").isNull().cast("long")).alias("unnamed")
    )
    told = held.documents(*keep).join(hits, "row", "left").join(items, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return told.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items").cast("long") + F.col("unnamed"), F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def proximity_matches(docs: DataFrame, pairs: DataFrame, within: int = 5, small: int = SMALL_ROWS) -> DataFrame:
    """Documents where the words ``left`` and ``right`` of a row of ``pairs`` (pair_id, left, right) stand at most ``within`` places apart.

    A row per document and pair: row, doc_id, pair_id, n (postings of left with right in reach).
    """
    asked = _shared.stored(pairs.select("pair_id", "left", "right").distinct(), "pairs")
    held = index(docs, asked.select(F.explode(F.array("left", "right")).alias("term")), small=small)
    cell = F.floor(F.col("pos") / within)

    def side(name: str) -> DataFrame:
        codes = _shared.stored(asked.join(held.terms.withColumnRenamed("term", name), name).select("pair_id", "code"), name)
        return held.postings.join(bounded(codes, rows=small), "code").select("row", "pair_id", "pos")

    left = side("left").withColumn("cell", cell)
    right = side("right").select("row", "pair_id", F.col("pos").alias("other"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    near = left.join(right, ["row", "pair_id", "cell"]).where((F.col("pos") != F.col("other")) & (F.abs(F.col("pos") - F.col("other")) <= within))
    counts = near.select("row", "pair_id", "pos").distinct().groupBy("row", "pair_id").agg(F.count("*").alias("n"))
    return held.documents("doc_id").join(counts, "row").select("row", "doc_id", "pair_id", "n")


def occurrences(docs: DataFrame, items: DataFrame, size: int = WINDOW, keep: tuple[str, ...] = ("doc_id",), small: int = SMALL_ROWS) -> tuple[Index, DataFrame, DataFrame]:
    """(index of ``docs``, occurrences of the items' windows, phrase and item_id)."""
    tests = _shared.stored(windows(items, size), "tests")
    held = index(docs, tests.select(F.explode("words").alias("term")), keep, small)
    told, owners = phrases(tests, held)
    return held, phrase_matches(held, told), owners


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, small: int = SMALL_ROWS) -> DataFrame:
    return report(*occurrences(docs, items, size, small=small))


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """_id, _text (the hash of its text) of the documents that hold a window of ``items``."""
    keyed = docs.select("text", F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
    held, found, _ = occurrences(keyed, items, size, ("_id", "_text"))
    return held.documents("_id", "_text").join(found, "row", "left_semi").select("_id", "_text").distinct()


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_shared.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP7_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
test AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM test),
run AS (
  SELECT id, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT id, w, size.n, unnest(range(1, len(w) - size.n + 2)) AS s FROM d, size WHERE len(w) >= size.n)),
hit AS (SELECT id, item_id, s, run.n FROM run JOIN test USING (phrase, n)),
place AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY id),
item AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN place USING (id) LEFT JOIN item USING (id)
"""
