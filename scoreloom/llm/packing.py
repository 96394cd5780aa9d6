"""Best-fit packing of token pieces, planned on a histogram of lengths.

``tokenize`` cuts documents into pieces of at most ``capacity`` ids. ``plan`` runs best-fit
decreasing over the counts of each length, never over documents: the driver sees ``capacity``
numbers whatever the size of the corpus. ``pack`` gives each piece its rank among the pieces of its
length and joins the rank with the planned slots.

Cases: null text is an empty document, which still has its closing id; repeated rows are packed
each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared

CAPACITY = 2048
#: Pieces of one length that a task ranks at once.
SALT_ROWS = 1_000_000
#: Parts of words in each of the two generations that a Python worker keeps with their ids.
CACHE_WORDS = 150_000
#: Bytes of text encoded at once.
ENCODE_BYTES = 4 << 20
#: The vocabulary's own pattern for parts of words.
PART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = frozenset(".,;:!?")
#: In these characters lower-casing, composition and white space mean the same to all libraries.
PLAIN = r"[^\t\n\r -~¡-¬®-įıĴ-ňŊ-ſ‐-‧…€]"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds:
    """Ids of whole texts, encoding each distinct part of a word once.

    The vocabulary's splitter never joins characters across white space, so the ids of a text
    are those of its words in turn, and a word's are those of its parts. Texts with characters outside
    ``PLAIN``, or with a special token's string, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts = regex.compile(PART).findall
        self.letters = byte_letters()
        # Shared by the tasks of a worker, by path: the parts met lately, those met before them, and one object for each id, so that the parts share them.
        self.seen, numbers = _shared.kept("packing", dict).setdefault(path, ([{}, {}], {}))
        self.number = numbers.setdefault

    def part(self, part: str) -> tuple[int, ...]:
        ids = self.seen[0].get(part)
        if ids is None:
            ids = self.seen[1].get(part)
            if ids is None:
                coded = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
                ids = tuple([self.number(t.id, t.id) for t in self.model.tokenize(coded)])
            if len(self.seen[0]) >= CACHE_WORDS:
                self.seen[:] = {}, self.seen[0]
            self.seen[0][part] = ids
        return ids

    def word(self, word: str) -> tuple[int, ...]:
        if word.isalpha():
            return self.part(word)
        if word[-1:] in MARKS and word[:-1].isalpha():
            return self.part(word[:-1]) + self.part(word[-1])
        return tuple([i for part in self.parts(word) for i in self.part(part)])

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple["np.ndarray", "np.ndarray"]:
        """All ids in one array, and the number of ids of each text; each text ends with id 0."""
        import numpy as np
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring_regex(texts, PLAIN), pc.match_substring(texts, "<|"))
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        words = pc.list_flatten(lists)
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        table = [self.word(w) for w in distinct]
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        flat = np.fromiter((x for ids in table for x in ids), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy(zero_copy_only=False)
        n = sizes[which] if len(which) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        at = np.arange(int(n.sum()), dtype=np.int64) + np.repeat((starts[which] if len(which) else n) - (ends - n), n)
        ids = flat[at]
        n_words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        word_ends = np.cumsum(n_words)
        total = np.concatenate([[0], ends])
        stops = total[word_ends]
        begins = total[word_ends - n_words]
        whole = dict(zip(odd.tolist(), self.encode_whole([texts[i].as_py() for i in odd.tolist()]))) if len(odd) else {}
        zero = np.zeros(1, np.uint32)
        parts: list = []
        counts = stops - begins + 1
        for i, (a, b) in enumerate(zip(begins.tolist(), stops.tolist())):
            if i in whole:
                parts.append(np.asarray(whole[i], np.uint32))
                counts[i] = len(whole[i]) + 1
            else:
                parts.append(ids[a:b])
            parts.append(zero)
        return (np.concatenate(parts) if parts else ids), counts


def tokenize(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np

        coder = WordIds(path)
        for batch in _shared.by_bytes(batches, "text", ENCODE_BYTES):
            ids, counts = coder.encode(batch.column("text"))
            raw = ids.astype("<u4").tobytes()
            pieces = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            at = (np.cumsum(counts) - counts)[row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_shared.lean(cut, "packing"), PIECES)


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, last rank + 1, first sequence, offset, pieces in each sequence) by best-fit decreasing.

    Best fit puts a piece into the sequence with the least room that holds it, so pieces of one length fill a
    sequence before they go to the next. Sequences with the same room are runs of consecutive numbers, and one step
    fills such a run.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []
    slots, following = [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if not room[left]:
                bisect.insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                left = rooms[i]
                first, n = room[left].pop()
                if not room[left]:
                    rooms.pop(i)
            else:
                left, first, n = capacity, following, -(-rest // (capacity // length))
                following += n
            each = left // length
            full = min(n, rest // each)
            part = min(rest - full * each, each) if full < n else 0
            if full:
                slots.append((length, rank, rank + full * each, first, capacity - left, each))
                put(left - each * length, first, full)
            if part:
                slots.append((length, rank + full * each, rank + full * each + part, first + full, capacity - left, part))
                put(left - part * length, first + full, 1)
            held = full + (part > 0)
            put(left, first + held, n - held)
            rank, rest = rank + full * each + part, rest - full * each - part
    return slots


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, last rank + 1, first sequence, offset), each of one piece in every sequence of a run."""
    out = []
    for length, first, last, sequence, offset, each in plan_runs(counts, capacity):
        n = (last - first) // each
        out += [(length, first + j * n, first + (j + 1) * n, sequence, offset + j * length) for j in range(each)]
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``pieces`` with sequence_id and offset. They are stored first, with the numbers that deal each length out to tasks."""
    spark = pieces.sparkSession
    pieces = _shared.stored(pieces.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    # At most capacity rows reach the driver: one for each length.
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # A full piece is a sequence of its own and needs no place in the plan.
    full = counts.pop(capacity, 0)
    slots = plan_runs(counts, capacity)
    planned = max((s[3] + (s[2] - s[1]) // s[5] for s in slots), default=0)
    cells = ("doc_id", "piece", "start", "length", "ids_crc32")
    whole = pieces.where(F.col("length") == capacity).select(*cells, (F.col("_at") + planned).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not counts:
        return whole
    salts = spark.createDataFrame([(n, -(-k // salt_rows)) for n, k in counts.items()], "length long, _salts long")
    # At most capacity rows.
    salted = pieces.where(F.col("length") < capacity).join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("_at"), F.col("_salts")))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    by_salt = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    bases = by_salt.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_salt").orderBy("_at")
    # A row for each length, and one for every SALT_ROWS pieces: 50,000 at 50 billion pieces.
    ranked = salted.withColumn("_row", F.row_number().over(within) - 1).join(F.broadcast(bases), ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_row"))
    # A few slots for each length, whatever the corpus: as many as there are different rooms.
    table = spark.createDataFrame(slots, "length long, _first long, _last long, _sequence long, _offset long, _each long")
    fits = (ranked["length"] == table["length"]) & (ranked["_rank"] >= table["_first"]) & (ranked["_rank"] < table["_last"])
    nth = F.col("_rank") - F.col("_first")
    # Ranks run along the sequences first, as in ``plan``.
    run = F.floor((F.col("_last") - F.col("_first")) / F.col("_each"))
    placed = ranked.join(F.broadcast(table), fits).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("_sequence") + nth % run).alias("sequence_id"), (F.col("_offset") + F.floor(nth / run) * ranked["length"]).alias("offset")
    )
    return placed.unionByName(whole) if full else placed


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(tokenize(_shared.documents(spark, sf_dir)))
