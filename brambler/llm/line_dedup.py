"""Line dedup by a sharded minimal perfect hash (operator 7).

Keys found in two documents or more are indexed: a shard is a minimal perfect hash with compact arrays beside it
(fingerprint, count, smallest doc_id). Documents look their lines up in those arrays; lines are never joined. Keys of one
document only can't lose a line, so they are counted but not indexed.

Results for odd input: a null or empty text is one empty line and stays as it is (null becomes empty); a null
doc_id counts as the largest id; rows that share a doc_id (or have none) are one document for the question of who owns a
line, so all of them keep the lines that this document owns; very long texts and lines go like any other; other columns
stay; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, doc_key, new_path, open_fs, own_names, read, saved, small_batches, texts, tidy

MIN_CHARS = 10
SPACE = b" \t\n\v\f\r"
#: Keys a shard holds on average, so that a task has one small shard in hand.
SHARD_KEYS = 50_000
#: Beyond this many keys in all shards, lines travel to the shards instead of every task reading all shards.
RESIDENT_KEYS = 2_000_000
#: Tasks among which the lines of one shard are spread on that way.
SALTS = 32


def line_key(line: bytes) -> tuple[int, int] | None:
    """128 bits of a line's key as two signed longs; None if the key has under MIN_CHARS code points."""
    key = line.strip(SPACE).lower()  # bytes.lower() changes A-Z only
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and len(key.decode("utf-8", "replace")) < MIN_CHARS):
        return None
    bits = xxhash.xxh3_128_intdigest(key)
    h, f = bits & (2**64 - 1), bits >> 64
    return h - 2**64 if h >= 2**63 else h, f - 2**64 if f >= 2**63 else f


KEYS = pa.schema([("h", pa.int64()), ("f", pa.int64()), ("doc", pa.int64()), ("row", pa.int64())])
KEYS_SQL = "h long, f long, doc long, row long"


@tidy
def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct keys of each row; row is a hash of its text, which with the id stands for what the row loses."""
    for batch in batches:
        h, f, doc, row = [], [], [], []
        for d, text in zip(batch["doc"].to_pylist(), texts(batch["text"]), strict=True):
            own = {k for k in map(line_key, set(text.split(b"\n"))) if k}
            h += [k[0] for k in own]
            f += [k[1] for k in own]
            doc += [d] * len(own)
            row += [row_of(text)] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (h, f, doc, row)], schema=KEYS)


def row_of(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


# ---- a minimal perfect hash: in each level, keys alone in their cell set its bit; the rest go on to the next level


def _cell(h: np.ndarray, level: int, size: int) -> np.ndarray:
    x = h.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_mphf(h: np.ndarray, gamma: float = 1.5) -> tuple[list[int], np.ndarray]:
    """Level sizes and the levels' bits, one after another. h: distinct longs."""
    sizes, bits = [], []
    while len(h):
        size = max(8, int(gamma * len(h)))
        cell = _cell(h, len(sizes), size)
        count = np.bincount(cell, minlength=size)
        sizes.append(size)
        bits.append(count == 1)
        h = h[count[cell] != 1]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slot(sizes: list[int], bits: np.ndarray, rank: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index of each key from 0 to n - 1 (any index, or -1, for what isn't a key)."""
    out, left, start = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
    for level, size in enumerate(sizes):
        at = start + _cell(h[left], level, size)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]] - 1
        left, start = left[~hit], start + size
    return out


SHARD = "shard int, n long, sizes array<long>, bits binary, fingerprints binary, counts binary, owners binary"


@tidy
def _build(group: pa.Table) -> pa.Table:
    """One shard's arrays. Two keys with equal h (none expected) are told apart by keeping the rest in a second row."""
    h, f, n, doc = (group[c].to_numpy() for c in ("h", "f", "n", "doc"))
    rows = []
    while len(h):
        _, first = np.unique(h, return_index=True)
        one = np.zeros(len(h), bool)
        one[first] = True
        sizes, bits = build_mphf(h[one])
        at = slot(sizes, bits, np.cumsum(bits), h[one])
        prints, counts, owners = np.empty(len(at), np.int64), np.empty(len(at), np.uint32), np.empty(len(at), np.int64)
        prints[at], counts[at], owners[at] = f[one], np.minimum(n[one], 2**32 - 1), doc[one]
        rows.append({"shard": group["shard"][0].as_py(), "n": len(at), "sizes": sizes, "bits": np.packbits(bits).tobytes(), "fingerprints": prints.tobytes(), "counts": counts.tobytes(), "owners": owners.tobytes()})
        h, f, n, doc = h[~one], f[~one], n[~one], doc[~one]
    return pa.Table.from_pylist(rows, schema=pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("fingerprints", pa.binary()), ("counts", pa.binary()), ("owners", pa.binary())]))


@functools.lru_cache(maxsize=RESIDENT_KEYS // SHARD_KEYS + 8)
def _shard(uri: str, shard: int) -> list[tuple]:
    fs, path = open_fs(f"{uri}/part={shard}")
    out = []
    for info in fs.get_file_info(pyarrow_selector(path)):
        if info.path.endswith(".parquet"):
            for r in pq.ParquetFile(fs.open_input_file(info.path)).read().to_pylist():
                bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: sum(r["sizes"])].astype(bool)
                out.append((r["sizes"], bits, np.cumsum(bits), np.frombuffer(r["fingerprints"], np.int64), np.frombuffer(r["counts"], np.uint32), np.frombuffer(r["owners"], np.int64)))
    return out


def pyarrow_selector(path: str):
    import pyarrow.fs

    return pyarrow.fs.FileSelector(path, allow_not_found=True)


def probe(uri: str, shards: int, h: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Smallest doc_id of each key that is indexed with a count of two or more, else NO_ID."""
    owner, where = np.full(len(h), NO_ID, np.int64), (h.view(np.uint64) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(where, kind="stable")
    ids, starts = np.unique(where[order], return_index=True)
    for s, own in zip(ids.tolist(), np.split(order, starts[1:]), strict=True):
        for sizes, bits, rank, prints, counts, owners in _shard(uri, s):
            at = slot(sizes, bits, rank, h[own])
            hit = (at >= 0) & (prints[at] == f[own]) & (counts[at] > 1)
            owner[own[hit]] = owners[at[hit]]
    return owner


def shard_of(shards: int) -> Column:
    """The unsigned remainder, as probe() takes it: h < 0 stands for h + 2**64."""
    return F.pmod(F.pmod(F.col("h"), F.lit(shards)) + F.when(F.col("h") < 0, F.lit(2**64 % shards)).otherwise(F.lit(0)), F.lit(shards)).cast("int")


def build_index(docs: DataFrame) -> tuple[str, int, int]:
    """Writes the shards of all keys found in two documents or more; gives their folder, the number of shards and of keys."""
    spark = docs.sparkSession
    keys = docs.select(doc_key().alias("doc"), "text").mapInArrow(_keys, KEYS_SQL)
    found = keys.groupBy("h", "f").agg(F.count("*").alias("n"), F.min("doc").alias("doc"), F.max("doc").alias("last")).filter("doc < last").drop("last")
    found = saved(found, "line-keys")
    n = found.count()
    shards = max(1, -(-n // SHARD_KEYS))
    uri = new_path(spark, "line-index")
    built = found.withColumn("shard", shard_of(shards)).groupBy("shard").applyInArrow(_build, SHARD)
    built.withColumn("part", F.col("shard")).write.partitionBy("part").parquet(uri)
    return uri, shards, n


def _drop_by_index(uri: str, shards: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [t.split(b"\n") for t in texts(batch["text"])]
            keys = [[line_key(x) for x in lines] for lines in split]
            flat = [k for ks in keys for k in ks if k]
            owner = iter(probe(uri, shards, np.array([k[0] for k in flat], np.int64), np.array([k[1] for k in flat], np.int64)).tolist())
            drop = [[bool(k) and next(owner) < d for k in ks] for d, ks in zip(batch["__doc"].to_pylist(), keys, strict=True)]
            yield _kept(batch, split, drop)

    return run


@tidy
def _drop_by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [t.split(b"\n") for t in texts(batch["text"])]
        lost = [{(k["h"], k["f"]) for k in ks or ()} for ks in batch["__lost"].to_pylist()]
        yield _kept(batch, split, [[line_key(x) in ks for x in lines] if ks else [False] * len(lines) for lines, ks in zip(split, lost, strict=True)])


def _kept(batch: pa.RecordBatch, split: list[list[bytes]], drop: list[list[bool]]) -> pa.RecordBatch:
    kept = [b"\n".join(x for x, gone in zip(lines, d, strict=True) if not gone) for lines, d in zip(split, drop, strict=True)]
    own = {"text": pa.array(kept, pa.binary()).cast(pa.string()), "n_lines": pa.array(map(len, split), pa.int64()), "n_dropped": pa.array(map(sum, drop), pa.int64())}
    names = [n for n in batch.schema.names if not n.startswith("__") and n not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return pa.RecordBatch.from_arrays([own[n] if n in own else batch[n] for n in names], names=names)


def _routed(uri: str, shards: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, f, doc, row = (batch[c].to_numpy() for c in KEYS.names)
            lost = probe(uri, shards, h, f) < doc
            yield pa.RecordBatch.from_arrays([pa.array(x[lost], pa.int64()) for x in (h, f, doc, row)], schema=KEYS)

    return run


def dedup_lines(docs: DataFrame, resident_keys: int = RESIDENT_KEYS) -> DataFrame:
    """docs with each repeated line left only in the smallest doc_id that holds it, and n_lines, n_dropped beside.

    Columns of docs of these two names are replaced; all others stay, whatever they are called.
    """
    small_batches(docs.sparkSession)
    docs, back = own_names(docs)
    return _dropped(docs, resident_keys).withColumnsRenamed(back)


def _dropped(docs: DataFrame, resident_keys: int) -> DataFrame:
    uri, shards, n = build_index(docs)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name not in ("n_lines", "n_dropped")]
    schema = ", ".join([*kept, "n_lines long", "n_dropped long"])
    if n <= resident_keys:
        return docs.withColumn("__doc", doc_key()).mapInArrow(_drop_by_index(uri, shards), schema)
    keys = docs.select(doc_key().alias("doc"), "text").mapInArrow(_keys, KEYS_SQL)
    # a task goes through few shards, one after another; a hot shard's lines are spread over SALTS tasks
    spread = keys.withColumn("shard", shard_of(shards)).repartition("shard", F.pmod(F.xxhash64("doc", "row"), F.lit(SALTS))).sortWithinPartitions("shard").select(*KEYS.names)
    lost = spread.mapInArrow(_routed(uri, shards), KEYS_SQL).groupBy("doc", "row").agg(F.collect_set(F.struct("h", "f")).alias("__lost"))

    @tidy
    def with_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(row_of, texts(batch["text"])), pa.int64())], names=[*batch.schema.names, "__row"])

    named = docs.withColumn("__doc", doc_key())
    named = named.mapInArrow(with_row, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema] + ["__row long"]))
    return named.join(lost.withColumnsRenamed({"doc": "__doc", "row": "__row"}), ["__doc", "__row"], "left").mapInArrow(_drop_by_list, schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


#: Whole-table SQL for the same rows.
OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_az AS key FROM (
    SELECT doc_id, i, line, translate(regexp_replace(regexp_replace(line, '^[ \t-\r]+', ''), '[ \t-\r]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
    FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)))),
owner AS (
  SELECT key, min(doc_id) AS own FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (own IS NOT NULL AND own <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (own IS NULL OR own = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN owner USING (key) GROUP BY doc_id
"""
