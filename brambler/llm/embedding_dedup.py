"""Near-duplicate vectors by Euclidean p-stable hashing (operator 3).

Vectors of one label are scaled to length 1; a cosine of at least MIN_COSINE is then a distance of at most 0.2. Each
of TABLES tables quantises PROJECTIONS random projections in cells of WIDTH. At that distance one projection falls into
one cell in 88.6 of 100 cases, so a pair is missed by all tables with probability (1 - 0.886^12)^44, about 1 in 120,000
at the threshold itself and far less above it. What shares a cell is compared by exact cosine in double precision.

Cells with more than BLOCK members are cut by a hash into parts and compared part by part, so no task holds a large
cell. A pair is counted in the first table that brings it together; tasks give counts and the links that connect, not
pairs. Equal vectors are one class with a weight.

Odd input: vectors that are null, zero or hold null or non-finite components, or whose label is null, link with
nothing; so do vectors of different lengths with each other; rows with equal or null vec_id are vectors of their own,
linked each by its components; a null vec_id counts as the largest id, so a component's id is null only if no row in it
has one; extra columns are not looked at; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, read, saved, small_batches, tidy
from .graph import components
from .words import mix

TABLES, PROJECTIONS, WIDTH = 44, 12, 1.4
MIN_COSINE = 0.98
BLOCK = 1024
#: Members of a cell up to which its pairs are looked at together with those of other cells.
FEW = 32
SEED = 3

CLASSED = pa.schema([("id", pa.int64()), ("label", pa.string()), ("key", pa.binary()), ("vector", pa.binary())])


@tidy
def _classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key of each usable vector (label and components), and the vector in double precision where it is new to the task."""
    seen: set[bytes] = set()
    for batch in batches:
        keys, vectors = [], []
        for label, v in zip(batch["label"].to_pylist(), batch["embedding"], strict=True):
            key = vector = None
            if label is not None and v.is_valid and len(v) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any():
                    vector = (x + 0.0).tobytes()  # -0 and 0 are one
                    key = xxhash.xxh3_128_digest(vector + str(label).encode())
            keys.append(key)
            vectors.append(vector if key and key not in seen else None)
            if key:
                seen.add(key)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], schema=CLASSED)


def cells(vectors: np.ndarray) -> np.ndarray:
    """Hashes (a row of TABLES for each) of the cells of vectors of length 1."""
    rng = np.random.default_rng([SEED, vectors.shape[1]])
    axes = rng.standard_normal((vectors.shape[1], TABLES * PROJECTIONS))
    cell = np.floor(vectors @ axes / WIDTH + rng.random(TABLES * PROJECTIONS)).astype(np.int64).astype(np.uint64).reshape(len(vectors), TABLES, PROJECTIONS)
    out = mix(np.arange(TABLES, dtype=np.uint64) + np.uint64(vectors.shape[1] * 1000)) + np.zeros((len(vectors), 1), np.uint64)
    for j in range(PROJECTIONS):
        out = mix(out * np.uint64(31) + cell[:, :, j])
    return out


def units(vectors: list[bytes]) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square overflows or vanishes."""
    x = np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@tidy
def _celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors, labels = batch["vector"].to_pylist(), batch["label"].to_pylist()
        hashes = np.zeros((len(vectors), TABLES), np.uint64)
        sizes = np.array([len(v) for v in vectors])
        for n in np.unique(sizes):
            own = np.flatnonzero(sizes == n)
            hashes[own] = cells(units([vectors[i] for i in own]))
        tags = np.array([xxhash.xxh3_64_intdigest(str(x).encode()) for x in labels], np.uint64)
        hashes = mix(hashes ^ tags[:, None]) if len(vectors) else hashes
        yield pa.RecordBatch.from_arrays([batch["rep"], batch["vector"], pa.array([h.tobytes() for h in hashes], pa.binary()), pa.array(hashes.view(np.int64).tolist(), pa.list_(pa.int64())), batch["weight"]], names=["rep", "vector", "hashes", "cells", "weight"])


FOUND = pa.schema([("a", pa.int64()), ("n", pa.int64()), ("b", pa.int64())])


def _large(ids: np.ndarray, side: np.ndarray, both: bool, weight: np.ndarray, x: np.ndarray, hashes: np.ndarray, table: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each member of one cell that are counted here, and links that join what is linked."""
    count, edges, own = np.zeros(len(ids), np.int64), [], np.arange(len(ids))
    for i in range(len(ids)):
        js = np.arange(i + 1, len(ids))
        js = js[side[js] != side[i]] if both else js
        js = js[~(hashes[js, :table] == hashes[i, :table]).any(1)]  # the others were counted in an earlier table
        js = js[x[js] @ x[i] >= MIN_COSINE]
        count[i] += weight[js].sum()
        count[js] += weight[i]
        for j in js[own[js] != own[i]]:
            if own[j] != own[i]:
                edges.append((int(ids[i]), int(ids[j])))
                own[own == own[j]] = own[i]
    return count, edges


def _compare(rows: pa.Table) -> pa.RecordBatch:
    """For whole cells, sorted: links counted here for each id (b null), and links (a, b) that connect."""
    ids, side, weight, cell, p, q = (rows[c].to_numpy() for c in ("rep", "side", "weight", "cell", "p", "q"))
    x = units(rows["vector"].to_pylist())
    hashes = np.frombuffer(b"".join(rows["hashes"].to_pylist()), np.int64).reshape(-1, TABLES)
    new = np.concatenate([[True], (cell[1:] != cell[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
    group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(ids)))
    table = (hashes == cell[:, None]).argmax(1)
    count, a, b = np.zeros(len(ids), np.int64), [], []
    for g in np.flatnonzero(sizes > FEW):
        at = slice(starts[g], starts[g] + sizes[g])
        own, edges = _large(ids[at], side[at], p[at][0] != q[at][0], weight[at], x[at], hashes[at], table[starts[g]])
        count[at] += own
        a += [e[0] for e in edges]
        b += [e[1] for e in edges]
    small = np.flatnonzero(sizes[group] <= FEW)
    for d in range(1, min(FEW, int(sizes.max()))):
        i = small[small + d < len(ids)]
        j = i + d
        ok = (group[i] == group[j]) & ((p[i] == q[i]) | (side[i] != side[j]))
        i, j = i[ok], j[ok]
        # counted in the first table that has both in one cell
        ok = (hashes[i] == hashes[j]).argmax(1) == table[i]
        i, j = i[ok], j[ok]
        ok = np.einsum("ij,ij->i", x[i], x[j]) >= MIN_COSINE
        i, j = i[ok], j[ok]
        np.add.at(count, i, weight[j])
        np.add.at(count, j, weight[i])
        a += ids[i].tolist()
        b += ids[j].tolist()
    names, own = np.unique(ids, return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, own, count)
    told = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array([*names[told].tolist(), *a], pa.int64()), pa.array([*total[told].tolist(), *[0] * len(a)], pa.int64()), pa.array([None] * len(told) + b, pa.int64())], schema=FOUND)


@tidy
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (size, cell, p, q); the last cell of a batch waits for the next one."""
    left = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
        rows = rows.combine_chunks()
        keys = [rows[c].to_numpy() for c in ("size", "cell", "p", "q")]
        if not rows.num_rows:
            continue
        last = np.all([k == k[-1] for k in keys], 0)
        cut = rows.num_rows - int(last.sum()) if not last.all() else 0
        left = rows.slice(cut)
        yield from _by_size(rows.slice(0, cut))
    if left is not None:
        yield from _by_size(left)


def _by_size(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows:
        size = rows["size"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(size)]
        for a, b in zip(edges, edges[1:]):  # noqa: B905
            yield _compare(rows.slice(a, b - a))


def near_vectors(rows: DataFrame) -> DataFrame:
    """id, n_links and component_id of each row of (vec_id, embedding, label); id is NO_ID for a null vec_id."""
    small_batches(rows.sparkSession)
    rows = rows.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    classed = saved(rows.mapInArrow(_classed, "id long, label string, key binary, vector binary"), "vectors")
    # a class is a label and a vector: rep is its number, written once, and id the smallest one of its rows
    classes = classed.filter("key is not null").groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("weight"), F.max("vector").alias("vector"), F.min("label").alias("label"))
    classes = saved(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    placed = saved(classes.mapInArrow(_celled, "rep long, vector binary, hashes binary, cells array<long>, weight long"), "vector-cells")
    members = placed.select("rep", F.explode("cells").alias("cell"))
    held = saved(members.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1").select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "cell-sizes")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    shared = members.join(held, "cell").withColumn("part", part)
    spread = shared.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("rep", "cell", F.least("part", "k").alias("p"), F.greatest("part", "k").alias("q"), (F.col("part") > F.col("k")).cast("int").alias("side"))
    # a cell has 2 * BLOCK rows at most here, so cells are what is dealt out and kept together
    rows = spread.join(placed.drop("cells"), "rep").withColumn("size", F.length("vector")).repartition("cell", "p", "q").sortWithinPartitions("size", "cell", "p", "q", "rep")
    found = rows.mapInArrow(_compared, "a long, n long, b long")
    found = saved(found, "vector-links")
    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
    groups = components(found.filter("b is not null")).withColumnRenamed("node", "rep")
    named = classes.select("key", "rep", "id", "weight").join(counts, "rep", "left").join(groups, "rep", "left")
    least = groups.join(classes.select("rep", "id"), "rep").groupBy("component").agg(F.min("id").alias("least"))
    named = named.join(least, "component", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "id").alias("component_id"))
    return classed.select("id", "key").join(named, "key", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_vectors(read(spark, sf_dir, "embeddings"))
    ids = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("id", "vec_id"), ("component_id", "component_id"))]
    return found.select(ids[0], "n_links", ids[1], (F.col("id") == F.col("component_id")).alias("kept"))


#: Whole-table SQL for the same rows.
OP3_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(v, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a),
least_of AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least_of ON v = vec_id LEFT JOIN counted ON a = vec_id
"""
