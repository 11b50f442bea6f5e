"""Substring dedup by suffix automata (operator 13): words covered by a window of words that starts elsewhere too go.

Reference shards are repeated passages only. In each window of words the least hash of its runs of 8 words is its anchor;
equal windows have equal anchors, at the same place. Anchors are counted; the passage around one that occurs once can't
repeat. A passage holds all windows of its anchor that follow each other. Passages go to the shard that their anchor
names, each distinct one once, with a mark if it occurs more than once. A shard's suffix automaton over words knows which
of its states occur twice; passages stream through it, and their matching statistics give the maximal repeated spans of
the length asked for or more. So a document meets only the shards of its own anchors, not all of them: every document
through every shard would be quadratic.

Hashes choose passages and name them (128 bits); the automaton compares words.

Results for odd input: a null text is an empty one and has no words; rows that share a doc_id, or have none, are documents
of their own, so texts of `window` words that two rows have go whole; long runs of one word are as many windows as they
have places; very long texts go like any other (their words are in memory once, their passages one by one); columns of
docs come back in `row`, whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, read, saved, small_batches, texts, tidy
from .words import MASK, WordHashes, mix

WINDOW, RUN = 35, 8
#: Words of a shard's passages. An anchor's automaton takes about 1 KB a word, so HOT_WORDS bound it by 50 MB.
SHARD_WORDS = 200_000
#: Words of passages of one anchor from which they are cut into parts, and how many places of the anchor a part takes
#: together, step by step; the last step must be 1.
HOT_WORDS, STEPS = 50_000, (7, 1)
#: Texts and passages that a task remembers, to send each once.
SEEN = 200_000


class SuffixAutomaton:
    """Of sequences with weights: states are sets of runs of words, next maps a word to a state.

    After finish(), repeats() gives, for a sequence, the places at which the longest run that ends there and weighs two or
    more in all has a length asked for or more. Weights count places, so a run met twice in one sequence weighs twice.
    """

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, link: int, nxt: dict) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.length) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of q for the runs no longer than p and the word."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, weight: int = 1) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # met in an earlier sequence
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                new, p = self._state(self.length[last] + 1, 0, {}), last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
                last = new
            self.weight[last] += weight

    def finish(self) -> None:
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        for v in reversed(order[1:]):
            self.weight[self.link[v]] += self.weight[v]
        self.twice = [0] * len(order)  # the state itself or the first one behind its links that weighs two
        for v in order[1:]:
            self.twice[v] = v if self.weight[v] > 1 else self.twice[self.link[v]]

    def repeats(self, words: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans [from, to) of a sequence, in it or not, made of repeated runs of `least` words or more."""
        out: list[list[int]] = []
        v = run = 0
        for i, word in enumerate(words):
            while v and word not in self.next[v]:
                v = self.link[v]
                run = self.length[v]
            if word in self.next[v]:
                v, run = self.next[v][word], run + 1
            u = self.twice[v]
            long = run if u == v else min(run, self.length[u])
            if long >= least:
                start = i + 1 - long
                if out and start <= out[-1][1]:
                    out[-1] = [min(out[-1][0], start), i + 1]
                else:
                    out.append([start, i + 1])
        return [(a, b) for a, b in out]


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least value in each run of `width` values, from runs of 1, 2, 4 and so on."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def anchors(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From words' hashes: first and last window that share an anchor (windows are named by their first word), where it
    stands, and its hash."""
    run = min(RUN, window)
    if len(hashes) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    runs = np.full(len(hashes) - run + 1, np.uint64(run), np.uint64)
    for j in range(run):
        runs += hashes[j : j + len(runs)] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & MASK)
    runs = mix(runs)
    at = leftmost_minima(runs, window - run + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return first, np.append(first[1:], len(at)) - 1, at[first], runs[at[first]].view(np.int64)


def _pair(data: bytes) -> tuple[int, int]:
    bits = xxhash.xxh3_128_intdigest(data)
    return (bits >> 64) - 2**63, (bits & MASK) - 2**63


ANCHORS_SQL = "t1 long, t2 long, anchors array<long>"


def _anchors(window: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Names and anchors of texts that have a window; a task sends those of a text twice at most, which tells it is no single one."""
        cache, seen = WordHashes(), {}
        for batch in in_slices(batches, 200):
            out = []
            for text in texts(batch["text"]):
                name = _pair(text)
                if seen.get(name, 0) < 2:
                    words = text.split()  # of bytes: [^\x20\x09-\x0D]+
                    if len(words) >= window:
                        *_, hashes = anchors(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), window)
                        own, times = np.unique(hashes, return_counts=True)
                        out.append((*name, np.concatenate([own, own[times > 1]]).tolist()))  # twice is enough to know
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[name] = seen.get(name, 0) + 1
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["t1", "t2", "anchors"])

    return run


NAMED_SQL = "t1 long, t2 long, text binary"


@tidy
def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text with its name; a task sends most texts only once."""
    seen: set[tuple[int, int]] = set()
    for batch in in_slices(batches, 200):
        out = []
        for text in texts(batch["text"]):
            name = _pair(text)
            if name not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                out.append((*name, text))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["t1", "t2", "text"])


PASSAGES = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("at", pa.int64()), ("anchor", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int32()), ("passage", pa.binary())])
PASSAGES_SQL = "t1 long, t2 long, at long, anchor long, k1 long, k2 long, n int, passage binary"


def _passages(window: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The passages of a text's repeated anchors, by name and first word; a task sends the words of most only once."""
        cache, seen = WordHashes(), set()
        for batch in in_slices(batches, 50):
            out = []
            for t1, t2, text, wanted in zip(batch["t1"].to_pylist(), batch["t2"].to_pylist(), texts(batch["text"]), batch["anchors"].to_pylist(), strict=True):
                words = text.split()
                first, last, _, hashes = anchors(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), window)
                own = np.isin(hashes, np.array(wanted, np.int64))
                for a, b, h in zip(first[own].tolist(), last[own].tolist(), hashes[own].tolist(), strict=True):
                    passage = b" ".join(words[a : b + window])
                    name = _pair(passage)
                    if name in seen:
                        passage = None
                    else:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(name)
                    out.append((t1, t2, a, h, *name, b - a + window, passage))
                    if len(out) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(PASSAGES)], schema=PASSAGES)
                        out = []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(PASSAGES)], schema=PASSAGES)

    return run


SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
SPANS_SQL = "k1 long, k2 long, start int, end int"


def _shard(window: int):
    @tidy
    def run(group: pa.Table) -> pa.Table:
        """Repeated spans of a shard's passages. Those of one anchor make an automaton, then they stream through it; an
        anchor's only passage is repeated as a whole or not at all."""
        of: dict[int, list[int]] = {}
        for i, anchor in enumerate(group["anchor"].to_pylist()):
            of.setdefault(anchor, []).append(i)
        k1, k2, twice, size, passage = (group[c].to_pylist() for c in ("k1", "k2", "twice", "n", "passage"))
        out = []
        for rows in of.values():
            if len(rows) == 1:
                out += [(k1[i], k2[i], 0, size[i]) for i in rows if twice[i]]
                continue
            automaton = SuffixAutomaton()
            words = [passage[i].split(b" ") for i in rows]
            for i, w in zip(rows, words, strict=True):
                automaton.add(w, 2 if twice[i] else 1)
            automaton.finish()
            out += [(k1[i], k2[i], *span) for i, w in zip(rows, words, strict=True) for span in automaton.repeats(w, window)]
        return pa.Table.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(SPANS)], schema=SPANS)

    return run


PARTS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("anchor", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("n", pa.int32()), ("twice", pa.bool_()), ("part", pa.binary())])
PARTS_SQL = "k1 long, k2 long, start int, anchor long, w1 long, w2 long, n int, twice boolean, part binary"


def _parts(window: int, step: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A hot anchor's passages in parts: windows that have the anchor at about the same place, `step` places as one.
        These share all but step - 1 of their words, which are a part's own anchor."""
        cache = WordHashes()
        for batch in in_slices(batches, 200):
            out = []
            for k1, k2, passage, twice in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), texts(batch["passage"]), batch["twice"].to_pylist(), strict=True):
                words = passage.split(b" ")
                _, _, stands, _ = anchors(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)), window)
                at, last = int(stands[0]), len(words) - window
                for kind in range(max(0, at - last) // step, at // step + 1):
                    a, b = max(0, at - kind * step - step + 1), min(last, at - kind * step)
                    if a <= b:
                        part = b" ".join(words[a : b + window])
                        shared = b" ".join(words[at - kind * step : at - kind * step - step + 1 + window])
                        out.append((k1, k2, a, xxhash.xxh3_64_intdigest(shared) - 2**63, *_pair(part), b - a + window, twice, part))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(PARTS)], schema=PARTS)

    return run


def spans_of(distinct: DataFrame, window: int, shard_words: int, hot_words: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """k1, k2, start and end of repeated spans of distinct passages (anchor, k1, k2, n, twice, passage).

    An anchor with more than hot_words of passages has them cut into parts, by finer anchors; in the last step a part is
    one window, so all that is left to know of it is whether it was met twice.
    """
    distinct = saved(distinct, "passages-distinct")
    total = distinct.agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // shard_words)))).cast("int")
    hot = distinct.groupBy("anchor").agg(F.sum("n").alias("words")).filter(F.col("words") > hot_words).select("anchor")
    usual = distinct.join(hot, "anchor", "left_anti").withColumn("shard", shard).select("shard", "anchor", "k1", "k2", "n", "twice", "passage")
    spans = usual.groupBy("shard").applyInArrow(_shard(window), SPANS_SQL)
    hot = saved(hot, "passages-hot")
    if hot.isEmpty():
        return spans
    parts = distinct.join(hot, "anchor", "left_semi").select("k1", "k2", "twice", "passage").mapInArrow(_parts(window, steps[0]), PARTS_SQL)
    parts = saved(parts, "passages-parts")
    place = F.xxhash64("k1", "k2", "start")
    finer = parts.groupBy("anchor", F.col("w1").alias("k1"), F.col("w2").alias("k2")).agg(F.max("n").alias("n"), ((F.min(place) != F.max(place)) | F.max("twice")).alias("twice"), F.first("part").alias("passage"))
    if steps[0] == 1:
        found = finer.filter("twice").select("k1", "k2", F.lit(0).alias("from"), F.col("n").alias("to"))
    else:
        found = spans_of(finer, window, shard_words, hot_words, steps[1:]).withColumnsRenamed({"start": "from", "end": "to"})
    found = parts.select("k1", "k2", "start", "w1", "w2").join(found.withColumnsRenamed({"k1": "w1", "k2": "w2"}), ["w1", "w2"])
    return spans.union(found.select("k1", "k2", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end")))


def repeated_spans(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, hot_words: int = HOT_WORDS) -> tuple[DataFrame, DataFrame]:
    """(t1, t2, spans) of texts with repeated passages, by word numbers, and (t1, t2) of texts that several rows have."""
    text = docs.select(F.col("text").cast("string").cast("binary").alias("text"))
    found = saved(text.mapInArrow(_anchors(window), ANCHORS_SQL), "passage-anchors")
    copies = found.groupBy("t1", "t2").agg(F.count("*").alias("rows")).filter("rows > 1").select("t1", "t2")
    # a text that several rows have is there more than once, which does no harm
    many = found.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    each = found.select("t1", "t2", F.explode(F.array_distinct("anchors")).alias("anchor"))
    wanted = each.join(many, "anchor").groupBy("t1", "t2").agg(F.collect_set("anchor").alias("anchors"))  # of one text
    rows = text.mapInArrow(_once, NAMED_SQL).join(wanted, ["t1", "t2"])
    passages = saved(rows.mapInArrow(_passages(window), PASSAGES_SQL), "passages")

    # a passage of a text that several rows have, or at two places, occurs more than once; rows met again are the same place
    place = F.xxhash64("t1", "t2", "at")
    one = passages.join(copies.withColumn("copied", F.lit(True)), ["t1", "t2"], "left")
    distinct = one.groupBy("anchor", "k1", "k2").agg(F.max("n").alias("n"), ((F.min(place) != F.max(place)) | F.coalesce(F.max("copied"), F.lit(False))).alias("twice"), F.first("passage", True).alias("passage"))
    # written, so that a passage that very many documents have is a skewed join of two tables, which Spark splits
    spans = saved(spans_of(distinct, window, shard_words, hot_words), "passage-spans")
    met = passages.select("t1", "t2", "at", "k1", "k2").join(spans, ["k1", "k2"])
    met = met.select("t1", "t2", F.struct((F.col("at") + F.col("start")).alias("a"), (F.col("at") + F.col("end")).alias("b")).alias("span"))
    return met.groupBy("t1", "t2").agg(F.collect_set("span").alias("spans")), copies


def covered(n: int, spans: list[dict] | None, whole: bool) -> np.ndarray:
    """Which of n words go."""
    if whole:
        return np.ones(n, bool)
    edge = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(edge, [s["a"] for s in spans], 1)
        np.add.at(edge, [s["b"] for s in spans], -1)
    return np.cumsum(edge[:-1]) > 0


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, text (the words that stay, joined by one blank) and row (docs' columns but for text)."""
    small_batches(docs.sparkSession)
    spans, copies = repeated_spans(docs, window, shard_words, hot_words)
    marks = spans.join(copies, ["t1", "t2"], "left_anti").select("t1", "t2", "spans", F.lit(False).alias("whole"))
    # copies go whole; all others by their spans
    marks = marks.unionByName(copies.select("t1", "t2", F.lit(None).cast("array<struct<a:long,b:long>>").alias("spans"), F.lit(True).alias("whole")))
    rows = docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    kept = {f.name: f.dataType.simpleString() for f in rows.select("doc_id", "row").schema}

    @tidy
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(map(_pair, texts(batch["text"])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64())], names=[*batch.schema.names, "t1", "t2"])

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 200):
            words = [t.split() for t in texts(batch["text"])]
            gone = [covered(len(w), s, bool(x)) for w, s, x in zip(words, batch["spans"].to_pylist(), batch["whole"].to_pylist(), strict=True)]
            left = [b" ".join(x for x, g in zip(w, d.tolist(), strict=True) if not g) for w, d in zip(words, gone, strict=True)]
            own = [pa.array(map(len, words), pa.int64()), pa.array([int(d.sum()) for d in gone], pa.int64()), pa.array(left, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *own, batch["row"]], names=["doc_id", "n_words", "n_removed", "text", "row"])

    rows = rows.mapInArrow(named, f"doc_id {kept['doc_id']}, row {kept['row']}, text binary, t1 long, t2 long")
    rows = rows.join(marks, ["t1", "t2"], "left").select("doc_id", "row", "text", "spans", "whole")
    return rows.mapInArrow(cut, f"doc_id {kept['doc_id']}, n_words long, n_removed long, text string, row {kept['row']}")


def op13_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_passages(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: Whole-table SQL for the same rows.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win FROM p JOIN d USING (r) WHERE i <= len(w) - 34),
again AS (SELECT r, i FROM windows WHERE win IN (SELECT win FROM windows GROUP BY win HAVING count(*) > 1)),
marked AS (
  SELECT r, i, word, coalesce(max(CASE WHEN again.i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM p LEFT JOIN again USING (r, i))
SELECT doc_id, count(word) AS n_words, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN marked USING (r) GROUP BY r, doc_id
"""
