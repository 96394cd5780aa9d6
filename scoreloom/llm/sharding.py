"""Shards cut from a Hilbert-curve order over quantised metadata.

Each metadata dimension is quantised at its quantiles, a cell of the grid gets its index on the
Hilbert curve, and the rows in curve order are cut into runs, so a shard covers a compact region
and files can be pruned on any of the dimensions. Equal texts share one cell and stand together. All of
it is DataFrame functions.

The law is ``rows``: shards differ by one row at most. Ranks come from counts of cells and of
parts of cells, never from one sorted partition. A cell has as many parts as its rows ask for, and a text with
more than HOT copies has parts of its own, so that its copies stand together too.

Cases: null text is empty and null metadata the lowest value; repeated rows each get a place; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared

SHARDS = 8
BITS = 4
#: Rows that a task ranks at once, about.
PART_ROWS = 50_000
HOT = 1000


def number(column: Column, kind: str) -> Column:
    """A dimension as an integer in the same order: strings by their first seven bytes."""
    if kind != "string":
        return F.coalesce(column.cast("long"), F.lit(-(1 << 62)))
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(-1))


def _below(name: str):
    return lambda bound: bound < F.col(name)


def quantise(df: DataFrame, names: list[str], bits: int = BITS) -> DataFrame:
    """Each named integer column as its quantile, 0 to 2**bits - 1. The driver gets 2**bits - 1 cuts for each."""
    n = 1 << bits
    shares = [i / n for i in range(1, n)]
    cuts = df.agg(*(F.percentile_approx(c, shares, 1000).alias(c) for c in names)).first()
    for c in names:
        bounds = F.array(*(F.lit(x).cast("long") for x in cuts[c] or []))
        df = df.withColumn(c, F.size(F.filter(bounds, _below(c))).cast("int"))
    return df


def hilbert(df: DataFrame, names: list[str], bits: int = BITS, out: str = "curve") -> DataFrame:
    """``df`` with the Hilbert index of the named columns, each below 2**bits, by Skilling's transform on an array of coordinates."""
    n, let = len(names), _shared.let
    tops = [1 << k for k in range(bits - 1, 0, -1)]
    steps = F.array(*(F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q in tops for i in range(n)))

    def turn(x: Column, step: Column) -> Column:
        own, p = F.get(x, step["i"]), step["q"] - 1
        set_ = own.bitwiseAND(step["q"]) != 0
        low = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(p)
        each = lambda v, j: F.when((j == 0) & set_, v.bitwiseXOR(p)).when(~set_ & ((j == 0) | (j == step["i"])), v.bitwiseXOR(low)).otherwise(v)
        return F.transform(x, each)

    xor = lambda a, b: a.bitwiseXOR(b)
    turned = F.aggregate(steps, F.array(*(F.col(c).cast("int") for c in names)), turn)
    gray = let(turned, lambda x: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(F.slice(x, 1, i + 1), F.lit(0), xor)))
    last = lambda x: F.get(x, F.lit(n - 1))
    shift = lambda x: F.aggregate(F.array(*map(F.lit, tops)) if tops else F.array().cast("array<int>"), F.lit(0), lambda t, q: F.when(last(x).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
    axes = let(gray, lambda x: let(shift(x), lambda t: F.transform(x, lambda v: v.bitwiseXOR(t))))
    places = F.array(*(F.struct(F.lit(1 << k).alias("q"), F.lit(i).alias("i")) for k in range(bits - 1, -1, -1) for i in range(n)))
    index = let(axes, lambda x: F.aggregate(places, F.lit(0).cast("long"), lambda acc, s: acc * 2 + F.when(F.get(x, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0)))
    return df.withColumn(out, index)


def ranked(df: DataFrame, curve: str, group: str, copies: str, key: str, hot: int = HOT, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` (stored) with ``rank`` (gapless from 0, by curve, then by group within parts of a cell) and ``total``."""
    # As many rows as the grid has cells, at most 2**(bits * dimensions).
    cells = _shared.stored(df.groupBy(curve).agg(F.count("*").alias("_cell")), "cells")
    everything = Window.orderBy(curve).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns({"_cell_base": F.coalesce(F.sum("_cell").over(everything), F.lit(0)), "total": F.sum("_cell").over(Window.partitionBy(F.lit(0)))})
    cells = _shared.stored(cells, "cell_bases")
    many = F.col(copies) > hot
    df = df.join(F.broadcast(cells), curve).withColumns({
        "_part": F.pmod(F.col(group), F.ceil(F.col("_cell") / part_rows)),
        "_own": F.when(many, F.col(group)),
        "_spread": F.when(many, F.pmod(F.xxhash64(key), F.ceil(F.col(copies) / hot))).otherwise(F.lit(0)),
    })
    place = ["_part", "_own", "_spread"]
    parts = df.groupBy(curve, *place).agg(F.count("*").alias("_n"))
    inside = Window.partitionBy(curve).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(F.col(curve).alias("_c"), *(F.col(p).alias(f"_b{p}") for p in place), F.coalesce(F.sum("_n").over(inside), F.lit(0)).alias("_base"))
    bases = _shared.stored(bases, "bases")
    same = F.lit(True)
    for p in place:
        same = same & F.col(p).eqNullSafe(F.col(f"_b{p}"))
    own = Window.partitionBy(curve, *place).orderBy(group, key)
    out = df.withColumn("_row", F.row_number().over(own) - 1).join(bases, (F.col(curve) == F.col("_c")) & same)
    out = out.withColumn("rank", F.col("_cell_base") + F.col("_base") + F.col("_row"))
    return out.drop(*place, "_row", "_base", "_cell", "_cell_base", "_c", *(f"_b{p}" for p in place))


def shard(docs: DataFrame, dimensions: tuple[str, ...] = ("lang", "source"), shards: int = SHARDS, bits: int = BITS, hot: int = HOT, part_rows: int = PART_ROWS) -> DataFrame:
    """Every document's size, text_crc32, curve, shard and slot. The size is a dimension too."""
    kinds = dict(docs.dtypes)
    text = _shared.whole_text()
    rows = docs.select(
        "doc_id", F.xxhash64(text).alias("_group"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *(number(F.col(d), kinds[d]).alias(f"_d{i}") for i, d in enumerate(dimensions)),
    )
    names = ["_d_size", *(f"_d{i}" for i in range(len(dimensions)))]
    firsts = [F.min("size").alias("_d_size"), *(F.min(f"_d{i}").alias(f"_d{i}") for i in range(len(dimensions)))]
    groups = _shared.stored(rows.groupBy("_group").agg(F.count("*").alias("_copies"), *firsts), "groups")
    groups = hilbert(quantise(groups, names, bits), names, bits).drop(*names)
    placed = ranked(_shared.stored(rows.drop(*names).join(groups, "_group"), "placed"), "curve", "_group", "_copies", "doc_id", hot, part_rows)
    k = F.floor((F.col("rank") * shards - F.pmod(F.col("rank") * shards, F.col("total"))) / F.col("total")).cast("int")
    placed = placed.withColumn("shard", k)
    slot = F.col("rank") - F.ceil((F.col("shard") * F.col("total")) / shards)
    return placed.select("doc_id", "size", "text_crc32", "curve", "shard", slot.cast("long").alias("slot"))


def write_shards(docs: DataFrame, places: DataFrame, path: str, files: int = 1) -> None:
    """Write ``docs`` by shard, each file in curve order, so that readers prune on the dimensions."""
    held = docs.join(places.select("doc_id", "shard", "slot", "curve"), "doc_id")
    held.repartitionByRange(SHARDS * files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(_shared.documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
