"""Secret scans over every historical version of a corpus, kept incremental by a blob ledger.

A version's text is content-addressed by its SHA-256. The ledger, a Parquet table, holds what has
been scanned: a row per blob with the rule versions applied and their findings. A scan applies to
each distinct blob only the rule versions that the ledger lacks for it, appends the outcome, and
joins findings back to every path that holds the blob. All of it is DataFrame functions.

Cases: null text is the empty blob; repeated rows each get their blob's findings; an empty table
gives no rows; other columns are ignored. A blob that was appended twice, as after a retried
run, is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``hints`` are strings of which each match holds one, in lower case where ``any_case``; a
    text without them isn't searched. ``linear`` finds the same in linear time, as group 1 at the end of its matches,
    where ``pattern`` would start anew at each place of a long run.
    """

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    hints: tuple[str, ...] = ()
    any_case: bool = False
    version: int = 1
    linear: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", ASSIGN, 12, 2, ("passw", "secret", "token", "apikey", "api_key"), any_case=True),
    # A run that is too short holds no longer run, so the length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{14,}", hints=("AKIA",)),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule(
        "jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hints=("eyJ",),
        linear=r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++)",
    ),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("PRIVATE KEY",)),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/@]{1,64}@", hints=("://",)),
)
RULES = BASE + MORE
#: Pieces of a text that are taken into one list.
PIECES = 512
SPAN = "struct<start:bigint,rank:int,kind:string,stop:bigint>"


def _hinted(rule: Rule, text: Column, low: Column) -> Column:
    if not rule.hints:
        return text.rlike(rule.pattern)
    where = low if rule.any_case else text
    out = where.contains(rule.hints[0])
    for hint in rule.hints[1:]:
        out = out | where.contains(hint)
    return out


def _step(i: int, rule: Rule):
    """Take a piece and the match behind it (null behind the last piece) into (place reached, spans)."""

    def step(acc: Column, z: Column) -> Column:
        start = acc["at"] + F.char_length(z["0"])
        stop = start + F.char_length(z["1"])
        begin = stop - F.char_length(z["2"]) if rule.linear else start
        span = F.struct(begin.alias("start"), F.lit(i).alias("rank"), F.lit(rule.kind).alias("kind"), stop.alias("stop"))
        kept = z["1"].isNotNull() & (F.char_length(z["2" if rule.group or rule.linear else "1"]) >= rule.least)
        spans = F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.coalesce(stop, start).cast("long").alias("at"), spans.cast(f"array<{SPAN}>").alias("spans"))

    return step


def _spans(i: int, rule: Rule, parts: Column) -> Column:
    """The spans of all pieces and matches. Lists grow within chunks only, so that a text with very many matches takes no quadratic time."""
    none = F.array().cast(f"array<{SPAN}>")
    chunk = lambda c: F.slice(parts, c * PIECES + 1, F.lit(PIECES))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / PIECES).cast("int")), chunk)
    width = lambda ch: F.aggregate(ch, F.lit(0).cast("long"), lambda n, z: n + F.char_length(z["0"]) + F.coalesce(F.char_length(z["1"]), F.lit(0)))
    bases = lambda chs: F.aggregate(chs, F.array(F.lit(0).cast("long")), lambda acc, ch: F.concat(acc, F.array(F.element_at(acc, -1) + width(ch))))
    within = lambda ch, at: F.aggregate(ch, F.struct(at.alias("at"), none.alias("spans")), _step(i, rule))["spans"]
    return _shared.let(chunks, lambda chs: _shared.let(bases(chs), lambda at: F.flatten(F.transform(chs, lambda ch, j: within(ch, F.get(at, j))))))


def find(blobs: DataFrame, rules: tuple[Rule, ...], text: str = "text", missing: str = "missing") -> DataFrame:
    """``blobs`` with ``spans``: what the rules named in ``missing`` find, in code points, ends exclusive.

    The text is split at the matches; summing the lengths of the pieces and matches gives the places.
    """
    out = blobs.withColumn("_low", F.lower(text))
    t = F.col(text)
    for i, r in enumerate(rules):
        out = out.withColumn(f"_go{i}", F.array_contains(missing, r.key) & _hinted(r, t, F.col("_low")))
    for i, r in enumerate(rules):
        go, pattern, group = F.col(f"_go{i}"), r.linear or r.pattern, 1 if r.linear else r.group
        pieces = [F.split(t, pattern, -1).alias("a"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m")]
        if group:
            pieces.append(F.regexp_extract_all(t, F.lit(pattern), F.lit(group)).alias("v"))
        out = out.withColumn(f"_parts{i}", F.when(go, F.arrays_zip(*pieces)))
    each = []
    for i, r in enumerate(rules):
        names = ["0", "1", "2"][: 3 if r.group or r.linear else 2]
        zipped = F.col(f"_parts{i}").cast("array<struct<" + ",".join(f"`{n}`:string" for n in names) + ">>")
        each.append(F.coalesce(F.when(F.col(f"_go{i}"), _spans(i, r, zipped)), F.array().cast(f"array<{SPAN}>")))
    spans = F.array_sort(F.flatten(F.array(*each)))
    extra = ["_low", *(f"_{n}{i}" for i in range(len(rules)) for n in ("go", "parts"))]
    return out.withColumn("spans", spans).drop(*extra)


LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"


def scan_history(versions: DataFrame, ledger_dir: str, rules: tuple[Rule, ...] = RULES, rows: int = _shared.SMALL_ROWS) -> DataFrame:
    """``versions`` (path, text; a row for each path and version) with ``blob`` and its ``spans``.

    Scans the blob and rule-version pairs that the ledger in ``ledger_dir`` lacks, and appends them to it.
    ``rows``: the new digests that are broadcast at most.
    """
    spark = versions.sparkSession
    keys = F.array(*(F.lit(r.key) for r in rules))
    addressed = versions.select("path", _shared.whole_text().alias("text")).withColumn("blob", F.sha2("text", 256))
    if _shared.path_exists(spark, ledger_dir):
        seen = spark.read.schema(LEDGER).parquet(ledger_dir)
        done = seen.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("_done"))
        missing = F.array_except(keys, F.coalesce("_done", F.array().cast("array<string>")))
        # Digests are compared first; where few are new, no other text is shuffled.
        new = addressed.select("blob").distinct().join(done, "blob", "left").select("blob", missing.alias("missing")).where(F.size("missing") > 0)
        new = _shared.bounded(_shared.stored(new, "unseen"), "blob", rows)
        texts = addressed.select("blob", "text").join(new.select("blob"), "blob", "left_semi").groupBy("blob").agg(F.first("text").alias("text"))
        blobs = texts.join(new, "blob")
    else:
        blobs = addressed.select("blob", "text").groupBy("blob").agg(F.first("text").alias("text")).withColumn("missing", keys)
    scanned = find(blobs, rules).select("blob", F.col("missing").alias("rules"), "spans")
    scanned.write.mode("append").parquet(ledger_dir)
    of_kind = F.create_map(*(F.lit(x) for r in rules for x in (r.kind, r.key)))
    ranks = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    current = spark.read.schema(LEDGER).parquet(ledger_dir).where(F.size("spans") > 0).select("blob", "rules", F.explode("spans").alias("s"))
    # A row's findings are those of its rule versions; what an older version of a rule found is left out.
    current = current.where(F.array_contains("rules", of_kind[F.col("s.kind")]))
    span = F.struct(F.col("s.start").alias("start"), ranks[F.col("s.kind")].alias("rank"), F.col("s.kind").alias("kind"), F.col("s.stop").alias("stop"))
    # Stored, since adaptive execution splits a hot blob's paths only where both sides come straight from a shuffle.
    findings = _shared.stored(current.groupBy("blob").agg(F.array_sort(F.collect_set(span)).alias("spans")), "findings")
    return addressed.select("path", "blob").join(findings, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    docs = _shared.documents(spark, sf_dir)
    ledger = f"{_shared.scratch_dir(spark)}/ledger-{uuid.uuid4().hex}"
    found = scan_history(docs.select(F.col("doc_id").alias("path"), "text"), ledger)
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        F.col("path").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(
            f"""SELECT id, start, {i} AS rank, '{r.kind}' AS kind, start + length(m) AS stop FROM (
  SELECT id, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(range(1, len(m) + 1), lambda i:
    CAST(list_sum(list_transform(a[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT))) AS start
  FROM (SELECT id, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {r.group}) AS v, regexp_split_to_array(text, '{pattern}') AS a FROM d))
WHERE length(v) >= {r.least}"""
        )
    return (
        "WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents), s AS (\n" + "\nUNION ALL ".join(parts) + "),\n"
        "t AS (SELECT id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,\n"
        "  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base,\n"
        "  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans FROM s GROUP BY id)\n"
        "SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,\n"
        "  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN t USING (id)"
    )


OP1_SQL = _sql()
