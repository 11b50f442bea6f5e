"""Source divergence audit (operator 12): how far the sources of a language are from each other, and by which terms.

Terms that enough of a language's documents hold are kept. They are sorted, by their bytes, into chunks: a chunk's terms
are one sorted array, a term's id is its place there (searchsorted), and a group's counts over a chunk are one dense vector
(bincount). As ids keep the order of UTF-8, ties need no look at the terms. Each chunk gives its share of every pair of
sources and its best terms of every source; shares are added, terms ranked, by Spark. All numbers are integers: shares of
a billion come from a long division, so sums of counts up to 9 * 10^15 stay exact.

Results for odd input: null texts, languages and sources count as empty ones; every row is a document of its own, whatever
its id; a group without terms, and a language without kept terms, have their pairs (value 0 without kept terms); very long
texts are counted piece by piece, and very long terms close a chunk early; other columns are not read; an empty table
gives no rows. A chunk's task holds the names and totals of its language's sources: the pairs in the result are more.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_slices, read, saved, small_batches, texts, tidy

MIN_DOCS, TOP = 10, 10
BILLION = 1_000_000_000
#: Terms of a chunk, and bytes of terms that close one before.
CHUNK, CHUNK_BYTES = 4096, 4 << 20
#: Groups whose vectors are dense at a time.
BLOCK = 256
#: Entries that a task counts in before it hands them on, and bytes of a text that are looked at in one go.
HELD, PIECE = 300_000, 1 << 20

TERM, OTHER = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, piece by piece; no term is cut."""
    text, at = text.lower(), 0  # of bytes: A-Z only
    while at < len(text):
        stop = OTHER.search(text, at + PIECE)
        end = stop.start() if stop else len(text)
        yield TERM.findall(text, at, end)
        at = end


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group, for as many documents as HELD entries take."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 50_000):
                own = terms[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own)), pa.array([source] * len(own)), pa.array(own, pa.binary()).cast(pa.string()), pa.array([n[t] for t in own], pa.int64()), pa.array([docs[t] for t in own], pa.int64())], schema=COUNTS)
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts(batch["text"]), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for terms in pieces(text):
                n.update(terms)
                own.update(terms)
            docs.update(own)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


CHUNKS = pa.schema([("lang", pa.string()), ("terms", pa.list_(pa.string())), ("sources", pa.list_(pa.string())), ("ids", pa.list_(pa.int32())), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
CHUNKS_SQL = "lang string, terms array<string>, sources array<string>, ids array<int>, at array<int>, n array<long>"


@tidy
def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of language and term: chunks, counts by ids of the chunk's sorted terms and sources."""
    lang, terms, size = None, [], 0  # terms: distinct ones of the open chunk
    own: list[tuple[str, bytes, int]] = []

    def closed():
        words = np.array([*terms, b""], object)[:-1]  # sorted, as the rows are
        ids = np.searchsorted(words, np.array([*[t for _, t, _ in own], b""], object)[:-1]).astype(np.int32)
        names = sorted({s for s, _, _ in own})
        at = np.searchsorted(np.array([*names, ""], object)[:-1], np.array([*[s for s, _, _ in own], ""], object)[:-1]).astype(np.int32)
        return pa.RecordBatch.from_pylist([{"lang": lang, "terms": [t.decode() for t in terms], "sources": names, "ids": ids.tolist(), "at": at.tolist(), "n": [n for _, _, n in own]}], schema=CHUNKS)

    for batch in in_slices(batches, 10_000):
        for of, source, term, n in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts(batch["term"]), batch["n"].to_pylist(), strict=True):
            fresh = not terms or of != lang or term != terms[-1]
            if terms and (of != lang or (fresh and (len(terms) >= CHUNK or size >= CHUNK_BYTES))):
                yield closed()
                terms, own, size = [], [], 0
            if fresh:
                terms.append(term)
                size += len(term)
            lang = of
            own.append((source, term, n))
    if terms:
        yield closed()


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (total + 2 * kept)), by long division."""
    by, left, out = np.int64(total + 2 * kept), count.astype(np.int64) + 2, np.zeros(count.shape, np.int64)
    for _ in range(3):
        digits, left = np.divmod(left * 1000, by)
        out = out * 1000 + digits
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
FOUND_SQL = "lang string, source string, part string, item string, value long"


def measure(chunk: dict, top: int = TOP) -> list[tuple]:
    """(source, part, item, value) of a chunk: its share of each pair of sources, and each source's best terms in it."""
    names, totals, kept = [g["source"] for g in chunk["groups"]], [g["total"] for g in chunk["groups"]], chunk["kept"]
    width = len(chunk["terms"])
    ids, n = np.array(chunk["ids"], np.int64), np.array(chunk["n"], np.int64)
    place = {s: i for i, s in enumerate(names)}
    row = np.array([place[s] for s in chunk["sources"]], np.int64)[np.array(chunk["at"], np.int64)] if width else ids
    whole = share(np.bincount(ids, n, width).astype(np.int64), sum(totals), kept)  # weights add up as doubles: exact below 2^53

    def dense(low: int) -> tuple[np.ndarray, np.ndarray]:
        here = (row >= low) & (row < low + BLOCK)
        many = min(BLOCK, len(names) - low)
        count = np.bincount((row[here] - low) * width + ids[here], n[here], many * width).astype(np.int64).reshape(many, width)
        return count, np.stack([share(c, t, kept) for c, t in zip(count, totals[low:], strict=False)])

    out = []
    for a in range(0, len(names), BLOCK):
        count, p = dense(a)
        for i in range(len(p)):
            best = np.flatnonzero((count[i] > 0) & (p[i] > whole))
            value = distance(p[i][best], whole[best])
            first = np.lexsort((best, -value))[:top]
            out += [(names[a + i], "term", chunk["terms"][j], int(v)) for j, v in zip(best[first], value[first], strict=True)]
        for b in range(a, len(names), BLOCK):
            q = p if a == b else dense(b)[1]
            for i in range(len(p)):
                low = i + 1 if a == b else 0
                for j, v in enumerate(distance(p[i][None, :], q[low:]).sum(axis=1).tolist(), b + low):
                    out += [(names[a + i], "pair", names[j], v), (names[j], "pair", names[a + i], v)]  # the distance has no direction
    return out


@tidy
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 1):
        for chunk in batch.to_pylist():
            found = measure(chunk)
            for i in range(0, len(found), 50_000):
                source, part, item, value = zip(*found[i : i + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([chunk["lang"]] * len(source)), pa.array(source), pa.array(part), pa.array(item), pa.array(value, pa.int64())], schema=FOUND)


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: how far each source is from each other one of its language,
    and the terms that it has above the language's share."""
    small_batches(docs.sparkSession)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(*map(empty, ("text", "lang", "source")))
    counts = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # dealt by language and term, so that neither the sums of groups nor those of the language move rows again
    counts = counts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = saved(counts.withColumn("held", held).filter(F.col("held") >= min_docs).select("lang", "source", "term", "n"), "divergence-counts")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
    groups = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("groups"))
    sizes = kept.groupBy("lang").agg(F.countDistinct("term").alias("kept"))
    # written, so that its size is known: small ones are broadcast, others joined
    groups = saved(groups.join(sizes, "lang", "left").withColumn("kept", F.coalesce("kept", F.lit(0))), "divergence-groups")

    chunks = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term", "source").mapInArrow(_chunks, CHUNKS_SQL)
    none = groups.filter("kept = 0").select("lang", *[F.array().cast(t).alias(c) for c, t in (("terms", "array<string>"), ("sources", "array<string>"), ("ids", "array<int>"), ("at", "array<int>"), ("n", "array<long>"))])
    found = chunks.unionByName(none).join(groups, "lang").mapInArrow(_measured, FOUND_SQL)
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents").select("text", "lang", "source"))


#: Whole-table SQL for the same rows.
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
own AS (SELECT r, lang, source, term, count(*) AS c FROM (SELECT r, lang, source, unnest(terms) AS term FROM d) AS x GROUP BY ALL),
kept AS (SELECT lang, term FROM own GROUP BY lang, term HAVING count(*) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, sum(c) AS c FROM own JOIN kept USING (lang, term) GROUP BY ALL),
full_cnt AS (SELECT lang, source, term, CAST(coalesce(c, 0) AS HUGEINT) AS c FROM grp JOIN kept USING (lang) LEFT JOIN cnt USING (lang, source, term)),
p AS (SELECT lang, source, term, c, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM full_cnt),
whole AS (SELECT lang, term, 1 + (1000000000 * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM (SELECT lang, term, CAST(sum(c) AS HUGEINT) AS c FROM full_cnt GROUP BY lang, term) AS w),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q) FROM p JOIN whole ON whole.lang = p.lang AND whole.term = p.term WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows_) AS ranked WHERE part = 'pair' OR rank <= 10
"""
