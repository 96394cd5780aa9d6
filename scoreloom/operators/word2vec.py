"""Word vectors fitted on training rows, and pooled document vectors."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.structural import ratio
from ..functions.text import words
from ..storage import dropped, freed, stored


ARCHITECTURES = ("cbow", "skipgram")
#: Tokens of a skip-gram shard on average at most; a larger corpus has more shards than ``workers``.
SHARD_TOKENS = 1_000_000
#: Tokens of a step of skip-gram, and the negative samples that they share.
STEP, NOISE = 512, 64
#: Tokens of a step whose pairs are one product of matrices.
BLOCK = 16
#: Tokens, on average, of a part of the words whose means one call takes; it has no more rows than that.
PART_TOKENS = 16_384


@dataclass(frozen=True)
class Word2VecConfig:
    vector_size: int = 100
    window: int = 5
    min_count: int = 1
    architecture: str = "cbow"
    epochs: int = 20
    workers: int = 1
    seed: int = 42

    def __post_init__(self) -> None:
        for name in ("vector_size", "window", "min_count", "epochs", "workers"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        object.__setattr__(self, "architecture", self.architecture.lower())
        if self.architecture not in ARCHITECTURES:
            raise ValueError(f"{self.architecture!r} is none of {', '.join(ARCHITECTURES)}")

    def parameters(self) -> dict:
        return asdict(self)


def fit(train: DataFrame, text: str, config: Word2VecConfig = Word2VecConfig(), key: str | None = None) -> DataFrame:
    """word, vector. Skip-gram shards are averaged by count after each epoch; CBOW trains per partition and averages the vectors by count."""
    tokens = train.select(*([key] if key else []), words(F.col(text)).alias("tokens")).where(F.size("tokens") > 0)
    if not tokens.take(1):
        raise ValueError("the training essays have no token")
    if config.architecture == "skipgram":
        return _skipgrams(tokens, config, key)
    counts = tokens.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= config.min_count)
    dealt = tokens.withColumn("shard", F.pmod(F.xxhash64(*([key] if key else ["tokens"])), F.lit(config.workers)))
    parts = dealt.groupBy("shard").applyInPandas(lambda pdf: _cbow(pdf, config), "word string, n long, vector array<float>")
    sums = parts.select("word", "n", F.posexplode("vector").alias("i", "x")).groupBy("word", "i").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).cast("float").alias("x"))
    vectors = sums.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector"))
    return vectors.join(counts.select("word"), "word", "left_semi")


def _skipgrams(tokens: DataFrame, config: Word2VecConfig, key: str | None) -> DataFrame:
    """word, vector, stored. No process holds the vocabulary: a task has the words of its shard, which all start from the same vectors."""
    dealt = stored(tokens.select(F.xxhash64(key or "tokens").alias("_hash"), F.xxhash64("tokens").alias("order"), "tokens"), "tokens")
    total = dealt.agg(F.sum(F.size("tokens"))).first()[0]
    shards, parts = max(config.workers, -(-total // SHARD_TOKENS)), -(-total // PART_TOKENS)
    own = dealt.select(F.pmod("_hash", F.lit(shards)).cast("int").alias("shard"), "order", "tokens").repartitionById(shards, "shard")
    given = None
    if config.min_count > 1:
        each = own.select("shard", F.explode("tokens").alias("word"))
        common = each.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= config.min_count).select("word")
        empty = F.lit("").cast("binary")
        given = stored(each.distinct().join(common, "word").select("shard", "word", empty.alias("vector"), empty.alias("outer")), "given")
    # A shard without others needs no means between its epochs.
    span = config.epochs if shards == 1 else 1
    for first in range(0, config.epochs, span):
        epochs, last, earlier = range(first, first + span), first + span == config.epochs, given
        schema = "shard int, word string, k long, vector binary, outer binary"
        if given is None:
            made = own.groupBy("shard").applyInArrow(lambda rows: _skipgram(rows, None, config, epochs), schema)
        else:
            made = own.groupBy("shard").cogroup(given.repartitionById(shards, "shard").groupBy("shard")).applyInArrow(lambda rows, known: _skipgram(rows, known, config, epochs), schema)
        part = made.groupBy(F.pmod(F.xxhash64("word"), F.lit(parts)))
        if last:
            given = stored(part.applyInArrow(_final, "word string, vector array<float>"), "vectors")
        else:
            given = stored(part.applyInArrow(_averaged, "shard int, word string, vector binary, outer binary"), "words")
        if earlier is not None:
            dropped(earlier)
        del made, part
        freed(tokens.sparkSession)
    dropped(dealt)
    return given


def _floats(column: pa.ChunkedArray, place: "np.ndarray", rows: int) -> "np.ndarray":
    """``rows`` rows of numbers, of which the binary values, all of one length, give those at ``place``."""
    import numpy as np

    out, at = None, 0
    for c in column.chunks:
        if len(c):
            ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
            numbers = np.frombuffer(c.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(len(c), -1)
            out = np.zeros((rows, numbers.shape[1]), np.float32) if out is None else out
            out[place[at : at + len(c)]] = numbers
            at += len(c)
    return out


def _binary(rows: "np.ndarray") -> pa.Array:
    import numpy as np

    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1] * 4
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows, np.float32))])


def _means(made: pa.Table, column: str) -> tuple[pa.Array, "np.ndarray", "np.ndarray"]:
    """The words, their means over the shards weighted by their count ``k`` in each, and each row's place among the words."""
    import numpy as np

    coded = made.column("word").combine_chunks().dictionary_encode()
    place = coded.indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((made.column("shard").to_numpy(), place))
    first = np.searchsorted(place[order], np.arange(len(coded.dictionary)))
    k = made.column("k").to_numpy().astype(np.float64)[order, None]
    rows = np.empty_like(order)
    rows[order] = np.arange(len(order))
    sums = np.add.reduceat(_floats(made.column(column), rows, len(rows)) * k, first, axis=0) / np.add.reduceat(k, first, axis=0)
    return coded.dictionary, sums.astype(np.float32), place


def _averaged(made: pa.Table) -> pa.Table:
    """Each shard's words with what all shards have made of them."""
    found = {c: _means(made, c) for c in ("vector", "outer")}
    return pa.table({"shard": made.column("shard"), "word": made.column("word"), **{c: _binary(means[place]) for c, (_, means, place) in found.items()}})


def _final(made: pa.Table) -> pa.Table:
    import numpy as np

    names, means, _ = _means(made, "vector")
    ends = pa.array(np.arange(len(names) + 1, dtype=np.int32) * means.shape[1])
    return pa.table({"word": names, "vector": pa.ListArray.from_arrays(ends, pa.array(means.ravel()))})


def _start(names: pa.Array, config: Word2VecConfig) -> "np.ndarray":
    """The first vector of each word, which the word and the seed decide."""
    import numpy as np

    h = pd.util.hash_array(names.to_numpy(zero_copy_only=False), hash_key=f"{config.seed:016d}"[-16:], categorize=False)
    out = np.empty((len(names), config.vector_size), np.float32)
    for j in range(config.vector_size):
        x = h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, j] = ((x >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / config.vector_size
    return out


def _skipgram(rows: pa.Table, given: pa.Table | None, config: Word2VecConfig, epochs: range) -> pa.Table:
    """Epochs of skip-gram with five negative samples on one shard; same rows, same vectors. ``given``: the words to learn and their vectors, if any.

    In a step a word moves by its summed gradients; where their factors sum to over 1, as for a word repeated hundreds of times, by their mean.
    """
    import numpy as np
    import pyarrow.compute as pc

    schema = pa.schema({"shard": pa.int32(), "word": pa.string(), "k": pa.int64(), "vector": pa.binary(), "outer": pa.binary()})
    if not rows.num_rows or (given is not None and not given.num_rows):
        return schema.empty_table()
    shard = rows.column("shard")[0].as_py()
    lists = pa.concat_arrays(rows.sort_by("order").column("tokens").chunks)
    coded = lists.flatten().dictionary_encode()
    names, found = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    home = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    inner = None
    if given is not None:
        kept = pc.is_in(names, given.column("word").combine_chunks()).to_numpy(zero_copy_only=False)
        told = kept[found]
        found, home = (np.cumsum(kept) - 1)[found[told]], home[told]
        names = names.filter(pa.array(kept))
        place = pc.index_in(given.column("word").combine_chunks(), names).to_numpy()
        inner, outer = (_floats(given.column(c), place, len(names)) for c in ("vector", "outer"))
    if inner is None or not inner.size:
        inner = _start(names, config)
        outer = np.zeros_like(inner)
    n = np.bincount(found, minlength=len(names))
    noise = np.cumsum(n**0.75)
    # The words between as many empty places as a window has, up to whole steps.
    size, reach, steps = config.vector_size, config.window, -(-len(found) // STEP)
    ids, doc = np.zeros(steps * STEP + 2 * reach, np.int64), np.full(steps * STEP + 2 * reach, -1)
    ids[reach : reach + len(found)], doc[reach : reach + len(found)] = found, home
    wide, blocks = BLOCK + 2 * reach, STEP // BLOCK
    away = np.abs(np.arange(wide) - reach - np.arange(BLOCK)[:, None])
    away[away == 0] = reach + 1
    view = np.lib.stride_tricks.sliding_window_view

    def pull(score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(score, -20, 20)))

    def add(to: np.ndarray, at: np.ndarray, what: np.ndarray, factor: np.ndarray) -> None:
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        to[at[first]] += np.add.reduceat(what[order], first, axis=0) / np.maximum(np.add.reduceat(factor[order], first), 1)[:, None]

    for epoch in epochs:
        rng = np.random.default_rng([config.seed, epoch])
        for step in range(steps):
            # A step's words, each with those around it as far as it reaches; blocks of them against all words near the block.
            span = slice(step * STEP, (step + 1) * STEP + 2 * reach)
            near, of = ids[span], doc[span]
            own, home = near[reach : reach + STEP], of[reach : reach + STEP].reshape(blocks, BLOCK, 1)
            rate = np.float32(max(0.025 * (1 - (epoch + step / steps) / config.epochs), 1e-4))
            far = rng.integers(1, reach + 1, (blocks, BLOCK, 1))
            held = ((away <= far) & (home >= 0) & (view(of, wide)[::BLOCK, None] == home)).astype(np.float32)
            x, y = inner[own], outer[near]
            parts, around = x.reshape(blocks, BLOCK, size), view(y, wide, axis=0)[::BLOCK]
            g = pull(-(parts @ around)) * held * rate
            dx, fx = (g @ around.transpose(0, 2, 1)).reshape(STEP, size), g.sum(axis=2).ravel()
            dy, fy = np.zeros_like(y), np.zeros(len(y), np.float32)
            for b, (moved, factor) in enumerate(zip(g.transpose(0, 2, 1) @ parts, g.sum(axis=1))):
                dy[b * BLOCK : b * BLOCK + wide] += moved
                fy[b * BLOCK : b * BLOCK + wide] += factor
            drawn = np.minimum(np.searchsorted(noise, rng.random(NOISE) * noise[-1], side="right"), len(names) - 1)
            z = outer[drawn]
            g = pull(x @ z.T) * (held.sum(axis=2).reshape(STEP, 1) * (5 * rate / NOISE))
            add(inner, own, dx - g @ z, fx + g.sum(axis=1))
            add(outer, np.concatenate([near, drawn]), np.concatenate([dy, -(g.T @ x)]), np.concatenate([fy, g.sum(axis=0)]))
    made = pa.Table.from_arrays([pa.array(np.full(len(names), shard, np.int32)), names, pa.array(n), _binary(inner), _binary(outer)], schema=schema)
    return pa.Table.from_batches(made.to_batches(max_chunksize=10_000), schema)


def _cbow(pdf: pd.DataFrame, config: Word2VecConfig) -> pd.DataFrame:
    """CBOW with five negative samples on one shard; same rows, same vectors."""
    import numpy as np

    rows = sorted(list(t) for t in pdf["tokens"])
    names = sorted({w for r in rows for w in r})
    code = {w: i for i, w in enumerate(names)}
    ids = [np.array([code[w] for w in r]) for r in rows]
    n = np.bincount(np.concatenate(ids), minlength=len(names))
    noise = np.cumsum(n**0.75)
    rng = np.random.default_rng(config.seed)
    inner = (rng.random((len(names), config.vector_size)) - 0.5).astype(np.float32) / config.vector_size
    outer = np.zeros_like(inner)
    for epoch in range(config.epochs):
        rate = np.float32(max(0.025 * (1 - epoch / config.epochs), 1e-4))
        for doc in ids:
            if len(doc) < 2:
                continue
            at = np.arange(len(doc))
            offsets = np.array([o for o in range(-config.window, config.window + 1) if o])
            place = at[:, None] + offsets[None]
            inside = (place >= 0) & (place < len(doc))
            near = doc[np.clip(place, 0, len(doc) - 1)]
            size = inside.sum(axis=1, keepdims=True)
            hidden = (inner[near] * inside[..., None]).sum(axis=1) / size
            negative = np.searchsorted(noise, rng.random((len(doc), 5)) * noise[-1])
            target = np.concatenate([doc[:, None], negative], axis=1)
            label = np.zeros(target.shape, np.float32)
            label[:, 0] = 1
            score = 1 / (1 + np.exp(-np.clip(np.einsum("dv,dkv->dk", hidden, outer[target]), -20, 20)))
            pull = ((label - score) * rate).astype(np.float32)
            move = np.einsum("dk,dkv->dv", pull, outer[target]) / size
            np.add.at(outer, target.ravel(), (pull[..., None] * hidden[:, None]).reshape(-1, config.vector_size))
            np.add.at(inner, near[inside], np.broadcast_to(move[:, None], (*near.shape, config.vector_size))[inside])
    return pd.DataFrame({"word": names, "n": n, "vector": list(inner)})


def pool(df: DataFrame, key: str, text: str, vectors: DataFrame) -> DataFrame:
    """key, vector (the mean over known words, repeats counted; zeros if none), token_count, known_token_count."""
    tokens = df.select(key, words(F.col(text)).alias("_t"))
    counted = tokens.select(key, F.explode("_t").alias("word")).groupBy(key, "word").agg(F.count("*").alias("_n"))
    first = vectors.select(F.size("vector").alias("n")).first()
    size = first.n if first else 0
    sums = counted.join(vectors, "word").groupBy(key).agg(F.sum("_n").alias("_k"), *(F.sum(F.col("vector")[i].cast("double") * F.col("_n")).alias(f"_m{i}") for i in range(size)))
    means = sums.select(key, F.array(*((F.col(f"_m{i}") / F.col("_k")).cast("float") for i in range(size))).cast("array<float>").alias("_m"), "_k")
    zero = F.array_repeat(F.lit(0.0).cast("float"), size)
    out = tokens.select(key, F.size("_t").cast("long").alias("token_count")).join(means, key, "left")
    return out.select(key, F.coalesce("_m", zero).alias("vector"), "token_count", F.coalesce("_k", F.lit(0)).alias("known_token_count"))


def coverage(pooled: DataFrame) -> DataFrame:
    """split, token_count, known_token_count, token_coverage, zero_vector_documents."""
    sums = pooled.groupBy("split").agg(F.sum("token_count").alias("token_count"), F.sum("known_token_count").alias("known_token_count"), F.sum((F.col("known_token_count") == 0).cast("long")).alias("zero_vector_documents"))
    return sums.withColumn("token_coverage", ratio(F.col("known_token_count"), F.col("token_count")))
