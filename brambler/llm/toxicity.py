"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 2).

A text's features are its distinct words, words cut to their first STEM bytes, pairs and triples of neighbours, and
pairs with one word between them, each hashed to one of DIMENSIONS coordinates. Training takes labelled documents whose
crc32(doc_id) isn't 0 by 5, at most MAX_ROWS of them (by a hash of the id, so always the same). Their coordinates, not
their texts, are dealt to SHARDS; in each round every shard passes several times over its rows from the common state,
one row after another with a rate per coordinate, and the states' changes are averaged by coordinate. The L1 term leaves few weights other than zero, and those alone are broadcast for scoring.

Odd input: a null or empty text has no feature and gets the score of the intercept; several labels of a document
count as toxic if one is; of rows that share a labelled id the one whose coordinates come first is learned from; without
labelled rows all scores are 0.5; repeated rows are scored each on their own; very long texts are read whole; other
columns stay, one named like the score is replaced; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read, saved, small_batches, texts, tidy
from .words import WordHashes, mix

DIMENSIONS = 1 << 21
#: Labelled rows to learn from at most, the shards that learn side by side and the rounds after which they meet.
MAX_ROWS, SHARDS, ROUNDS = 12_000, 4, 3
#: Times a shard passes over its rows in a round.
PASSES = 3
#: Per-coordinate rate, its smoothing, and the L1 and L2 terms.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1
STEM = 5
#: Marks at words' ends are no part of them.
MARKS = bytes.maketrans(b".,;:!?\"()[]{}*", b" " * 14)
INTERCEPT = DIMENSIONS


class StemHashes(WordHashes):
    """word -> hash of its first STEM bytes."""

    def hash(self, word: bytes) -> int:
        return super().hash(b"^" + word[:STEM])


def caches() -> tuple[WordHashes, WordHashes]:
    return WordHashes(), StemHashes()


def features(text: bytes, cache: tuple[WordHashes, WordHashes]) -> np.ndarray:
    """Coordinates of a text's features, with repeats."""
    words = text.lower().translate(MARKS).split()
    w, stems = (np.fromiter(map(c.__getitem__, words), np.uint64, len(words)) for c in cache)
    two = w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:]
    three = two[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[2:]
    skip = w[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
    return (mix(np.concatenate([w, stems, two, three, skip])) % np.uint64(DIMENSIONS)).astype(np.int64)


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that FTRL-proximal's sums stand for; zero where |z| is at most L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def learn(rows: list[np.ndarray], labels: list[int], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over rows (distinct coordinates each); z and n change in place. The intercept has no L1 term."""
    for x, y in zip(rows, labels, strict=True):
        w = weights_of(z[x], n[x])
        b = -z[INTERCEPT] / ((BETA + np.sqrt(n[INTERCEPT])) / ALPHA + L2)
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
        for at, own in ((x, w), (INTERCEPT, b)):
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * own
            n[at] += g * g


STATE = pa.schema([("at", pa.int64()), ("shard", pa.int32()), ("z", pa.float64()), ("n", pa.float64())])


def _round(state):
    @tidy
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc")
        at, z0, n0 = state.value
        z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
        z[at], n[at] = z0, n0
        rows = [np.frombuffer(x, np.int32) for x in group["x"].to_pylist()]
        for _ in range(PASSES):
            learn(rows, group["toxic"].to_pylist(), z, n)
        told = np.union1d(np.flatnonzero(np.abs(z) > L1 / 2), at)  # the rest is far from having a weight
        return pa.Table.from_arrays([pa.array(told), pa.array(np.full(len(told), group["shard"][0].as_py()), pa.int32()), pa.array(z[told]), pa.array(n[told])], schema=STATE)

    return run


@tidy
def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = caches()
    for batch in batches:
        found = [np.unique(features(t, cache)).astype(np.int32).tobytes() for t in texts(batch["text"])]
        yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(found, pa.binary()), batch["toxic"]], names=["doc", "x", "toxic"])


def sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """doc, x (distinct coordinates), toxic and shard of the documents to learn from."""
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    n = known.count()
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, max_rows / max(n, 1))))).select(F.col("doc_id").cast("long").alias("doc"), "toxic")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    # at most about max_rows rows of two numbers, so this side may be broadcast
    rows = docs.join(F.broadcast(chosen), "doc").mapInArrow(_featured, "doc long, x binary, toxic int")
    return rows.groupBy("doc").agg(F.min("x").alias("x"), F.first("toxic").alias("toxic")).withColumn("shard", F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(SHARDS)).cast("int"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates and values of all weights other than zero, and the intercept."""
    spark = docs.sparkSession
    rows = saved(sample(docs, labels, max_rows), "toxicity-sample")
    state = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast(state)
        states = rows.groupBy("shard").applyInArrow(_round(sent), "at long, shard int, z double, n double")
        # the mean over the shards that tell of a coordinate, summed in their order so that reruns agree to the bit;
        # at most DIMENSIONS coordinates, and only those near a weight
        states = states.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("shard", "z", "n"))).alias("all"))
        mean = lambda c: F.aggregate("all", F.lit(0.0), lambda s, x: s + x[c]) / F.size("all")
        got = states.select("at", mean("z").alias("z"), mean("n").alias("n")).filter((F.abs("z") > L1 / 2) | (F.col("at") == INTERCEPT)).toArrow().sort_by("at")
        state = tuple(got[c].to_numpy() for c in ("at", "z", "n"))
        sent.unpersist()
    at, z, n = state
    own = at == INTERCEPT
    w = weights_of(z[~own], n[~own])
    bias = float((-z[own] / ((BETA + np.sqrt(n[own])) / ALPHA + L2)).sum())
    return at[~own][w != 0], w[w != 0], bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], column: str = "score") -> DataFrame:
    """docs with the probability that each row's text is toxic, in place of a column of that name."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(column)

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = sent.value
        dense = np.zeros(DIMENSIONS, np.float32)
        dense[at] = w
        cache = caches()
        for batch in batches:
            scores = []
            for text in texts(batch["text"]):
                x = features(text, cache)
                x = np.unique(x[dense[x] != 0])
                scores.append(1 / (1 + np.exp(-np.clip(float(dense[x].sum()) + bias, -35, 35))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{column} double"])
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"))
    found = score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
