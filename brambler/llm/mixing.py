"""Mixing sources to target weights by Sainte-Laguë apportionment (operator 4).

A document's size is its number of words. Sources, by code point and null last, weigh 5, 2, 1, repeating; they share
SHARE of all words, but none gets more than TWICE its own words. A source's documents are dealt to shards by a hash of
their id, a shard's documents are lined up in seeded order and cut into blocks of BLOCK
words (fewer in sources under BLOCK * LEAST_BLOCKS words, which is the grain of what is taken). Blocks are what is
apportioned, by highest quotients weight / (2 q + 1), twice: all blocks of the mix among the sources, with their targets
as weights and twice their own blocks as limits, then a source's blocks among its shards by their words. A quota beyond
a shard's own blocks takes all of them as often as it goes and the rest by seeded choice, so a document is taken by
whole rounds plus the words of chosen blocks that lie in it. Choice is by a seeded permutation of block numbers that is
worked out number by number, so no task holds a shard's blocks.

Odd input: null, empty and blank texts have size 0 and are never taken; null is a source like any other; null ids are
lined up like the rest, by their text; very long texts are cut like any other; rows that share an id are lined up side by side, by size and text, each taken
for itself; other columns stay; a table without rows gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import own_names, read, saved, small_batches, texts, tidy
from .words import mix as spread

WEIGHTS, SHARE, TWICE = (5.0, 2.0, 1.0), 1.5, 2.0
#: Words of a block at most and blocks that a source has at least if it has as many words; words of a shard on average; a
#: source has MAX_SHARDS at most.
BLOCK, LEAST_BLOCKS, SHARD, MAX_SHARDS = 64, 64, 65_536, 4096
#: Sources that a mix may have: their totals come to the driver.
MAX_SOURCES = 100_000
SEED = 20


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int]) -> list[float]:
    """Words for each source, in order: shares by weight, what is above the limit shared again among the others."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    limit, out = [TWICE * s for s in sizes], [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), SHARE * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > limit[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = limit[i]
        left -= sum(limit[i] for i in over)
        full = set(over)
        open_ = [i for i in open_ if i not in full]
    return out


def sainte_lague(weights: np.ndarray, limits: np.ndarray, seats: int) -> np.ndarray:
    """Seats for each weight by highest quotients weight / (2 q + 1); none beyond its limit, ties to the first.

    All seats whose quotient is above some bound go first, at once; the bound is halved in on so that few seats are
    left to be handed out one after another.
    """
    weights, limits = np.asarray(weights, float), np.asarray(limits, np.int64)
    seats = int(min(seats, limits[weights > 0].sum()))
    # a weight has q seats above the bound if weight / (2 q - 1) >= bound
    above = lambda bound: np.minimum(limits, np.floor((weights / bound + 1) / 2).astype(np.int64)) * (weights >= bound)
    q = np.zeros(len(weights), np.int64)
    if seats:
        low, high = weights[weights > 0].min() / (4 * seats + 4), weights.max() * 2
        for _ in range(100):
            bound = math.sqrt(low * high)
            if above(bound).sum() > seats:
                low = bound
            else:
                high = bound
        q = above(high)
    for _ in range(seats - int(q.sum())):
        q[int(np.argmax(np.where((q < limits) & (weights > 0), weights / (2 * q + 1), -1.0)))] += 1
    return q


def block_of(size: int) -> int:
    """Words of a source's blocks: BLOCK, or fewer where these would be under LEAST_BLOCKS, so that the words taken come
    within a 64th of the source of its target (within a word if it has no more than 64)."""
    return max(1, min(BLOCK, size // LEAST_BLOCKS))


def plan(docs: DataFrame, sources: dict) -> DataFrame:
    """docs with size, source_size, target, taken, and the rounds and pieces of it: whole copies, then [start, end) words."""
    spark = docs.sparkSession
    names = sorted((s for s in sources if s is not None)) + [None] * (None in sources)  # of str: by code point
    goal = targets([sources[s] for s in names])
    shards = [max(1, min(MAX_SHARDS, -(-sources[s] // SHARD))) for s in names]
    info = spark.createDataFrame([(i, s, int(sources[s]), float(t), int(k), block_of(int(sources[s]))) for i, (s, t, k) in enumerate(zip(names, goal, shards, strict=True))], "__s long, __name string, source_size long, target double, __shards int, __block int")
    # a row for each source, MAX_SOURCES at most, so this side may be broadcast
    rows = docs.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED), F.when(F.col("doc_id").isNull(), F.col("text")))
    rows = rows.withColumn("__order", order).withColumn("__shard", F.pmod(F.xxhash64("__order", F.lit(SEED + 1)), F.col("__shards")).cast("int"))
    small = saved(rows.select("__row", "doc_id", "__s", "__shard", "__order", "__tie", "size", "target", "source_size", "__block"), "mix-rows")

    held = saved(small.groupBy("__s", "__shard").agg(F.sum("size").alias("words"), F.max("__block").alias("__block")), "mix-shards")
    blocks = dict(held.groupBy("__s").agg(F.sum(F.ceil(F.col("words") / F.col("__block"))).cast("long").alias("blocks")).collect())  # MAX_SOURCES rows at most
    own = np.array([blocks.get(i, 0) for i in range(len(names))], np.int64)
    # a source's blocks hold fewer words than they might on average, as a shard's last one does: targets count in its own blocks
    goals = np.array(goal) * own / np.maximum([sources[s] for s in names], 1)
    seats = sainte_lague(goals, 2 * own, round(float(goals.sum()))) if names else own
    given = spark.createDataFrame([(i, int(n)) for i, n in enumerate(seats)], "__s long, seats long")
    quota = held.join(F.broadcast(given), "__s").groupBy("__s").applyInArrow(_quota, "__s long, __shard int, words long, quota long")
    line = Window.partitionBy("__s", "__shard").orderBy("__order", "doc_id", "size", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = small.withColumn("end", F.sum("size").over(line)).withColumn("start", F.col("end") - F.col("size"))
    blocks = F.ceil(F.col("words") / F.col("__block")).cast("long")
    lined = lined.join(quota, ["__s", "__shard"]).withColumn("rounds", F.when(F.col("words") > 0, F.floor(F.col("quota") / blocks)).otherwise(0).cast("long"))
    # the blocks that are chosen once more: those that a seeded permutation puts before `rest`
    return lined.withColumn("rest", F.when(F.col("words") > 0, F.col("quota") % blocks).otherwise(0).cast("long")).withColumn("blocks", blocks)


QUOTA = pa.schema([("__s", pa.int64()), ("__shard", pa.int32()), ("words", pa.int64()), ("quota", pa.int64())])


@tidy
def _quota(group: pa.Table) -> pa.Table:
    """A source's blocks, by highest quotients among its shards (MAX_SHARDS rows at most)."""
    group = group.sort_by("__shard")
    words = group["words"].to_numpy()
    quota = sainte_lague(words, 2 * -(-words // group["__block"][0].as_py()), group["seats"][0].as_py())
    return pa.Table.from_arrays([group["__s"].combine_chunks(), group["__shard"].combine_chunks(), pa.array(words, pa.int64()), pa.array(quota, pa.int64())], schema=QUOTA)


def permuted(s: int, shard: int, blocks: int, x: np.ndarray) -> np.ndarray:
    """Where a seeded permutation of the numbers below `blocks` puts each of x: steps that are one to one on the next power
    of two, gone on with until the number is below `blocks`."""
    bits = max(1, int(blocks - 1).bit_length())
    mask, half = np.uint64(2**bits - 1), np.uint64((bits + 1) // 2)
    keys = [spread(np.array([SEED * 1_000_003 + k, s, shard], np.uint64)) for k in range(6)]
    x = x.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        y = x[todo]
        for k in keys:
            y = (y ^ k[0] ^ k[1]) * (k[2] | np.uint64(1)) + k[1] & mask
            y ^= y >> half
        x[todo] = y
        todo = todo[y >= np.uint64(blocks)]
    return x.astype(np.int64)


def _pieces(s: int, shard: int, block: int, blocks: int, rest: int, start: int, end: int) -> list[tuple[int, int]]:
    """Runs of words [from, to) of a document at [start, end) of its shard that chosen blocks cover."""
    if end <= start or not rest:
        return []
    first, last = start // block, (end - 1) // block
    own = np.concatenate([[False], permuted(s, shard, blocks, np.arange(first, last + 1)) < rest, [False]])
    edges = np.flatnonzero(np.diff(own.astype(np.int8)))
    return [(max(start, (first + a) * block) - start, min(end, (first + b) * block) - start) for a, b in edges.reshape(-1, 2).tolist()]


TAKEN = "doc_id long, size long, source_size long, target double, taken long, rounds long, pieces array<struct<from:long,to:long>>, __row long"


@tidy
def _take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {n: batch[n].to_pylist() for n in ("__s", "__shard", "__block", "blocks", "rest", "start", "end", "rounds", "size")}
        pieces = [_pieces(*r) for r in zip(*(col[n] for n in ("__s", "__shard", "__block", "blocks", "rest", "start", "end")), strict=True)]
        taken = [k * n + sum(b - a for a, b in p) for k, n, p in zip(col["rounds"], col["size"], pieces, strict=True)]
        kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["size"], batch["source_size"], batch["target"], pa.array(taken, pa.int64()), batch["rounds"], pa.array([[{"from": a, "to": b} for a, b in p] for p in pieces], kind), batch["__row"]],
            names=["doc_id", "size", "source_size", "target", "taken", "rounds", "pieces", "__row"],
        )


def _sized(docs: DataFrame, row: Column) -> DataFrame:
    return docs.select(row.alias("__row"), F.xxhash64(F.col("text").cast("string")).alias("__tie"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), F.col("text").cast("string").alias("text"))


def source_sizes(docs: DataFrame) -> dict:
    """Words of each source, on the driver: a mix of more than MAX_SOURCES sources is refused."""
    found = docs.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"a mix of over {MAX_SOURCES} sources")
    return {r.source: r.size for r in found}


def mix(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row, with its whole rounds and further pieces of words."""
    small_batches(docs.sparkSession)
    # sizes are counted once; a null id's text goes into the order, by hash
    sized = _sized(docs, F.lit(0).cast("long") if row is None else row).withColumn("text", F.when(F.col("doc_id").isNull(), F.col("text")))
    sized = saved(sized, "mix-sizes")
    return plan(sized, source_sizes(sized)).mapInArrow(_take, TAKEN)


def op4_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of docs: a row for each whole round of a document and one for its further pieces."""
    small_batches(docs.sparkSession)
    # rows get numbers in a written table, so that each meets its own part of the plan, whatever its id
    docs, back = own_names(docs)
    rows = saved(docs.withColumn("text", F.col("text").cast("string")).withColumn("__row", F.monotonically_increasing_id()), "mix-docs")
    found = mix(rows, F.col("__row")).filter("taken > 0").select("__row", F.col("rounds").alias("__rounds"), F.col("pieces").alias("__pieces"))
    rows = rows.join(found, "__row")

    names = docs.columns

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, (text, rounds, pieces) in enumerate(zip(texts(batch["text"]), batch["__rounds"].to_pylist(), batch["__pieces"].to_pylist(), strict=True)):
                whole = [text] * rounds
                if pieces:
                    words = text.split()  # of bytes: [^\x20\x09-\x0D]+
                    whole.append(b" ".join(w for p in pieces for w in words[p["from"] : p["to"]]))
                at += [i] * len(whole)
                out += whole
            own = batch.select(names).take(pa.array(at, pa.int64()))
            own = own.set_column(names.index("text"), "text", pa.array(out, pa.binary()).cast(pa.string()))
            if "n_chars" in names:
                own = own.set_column(names.index("n_chars"), batch.schema.field("n_chars"), pa.array([len(t.decode()) for t in out], batch.schema.field("n_chars").type))
            yield own

    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(cut, schema).withColumnsRenamed(back)
