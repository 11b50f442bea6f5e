"""Language of mixed-language text: script ranges, per-word scores and Viterbi spans (operator 6).

Words are runs of letters (Unicode categories L; numerals are none). A word's script (by ranges of code points) leaves the languages that were seen to write it;
each of these scores the word by the log-likelihood of its hashed character n-grams. Viterbi with a penalty for every
switch labels the words; neighbours with one label are a span. The text's language is the one whose spans hold most
letters and the score is their share.

Viterbi goes over all texts of a batch side by side, with a state for each language. Texts of over CHUNK words are cut
in chunks: what each chunk makes of every label before it is worked out first, a bounded number of chunks at a time and
without back-pointers, then the labels at the chunks' ends, and with those all chunks go like texts of their own.

Learning takes text and lang of at most MAX_ROWS rows with a lang whose crc32(doc_id) isn't 0 by 5, by a hash of id
and text. Counts are summed by Spark; the model has at most FEATURES numbers for each language and is broadcast.

Odd input: `und` with score 0 if a text is null or has no letter, or nothing could be learned; repeated rows are
labelled each on their own and chosen for learning together; rows without an id are held out; very long texts are labelled whole; other columns are not looked at; a
table without rows gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read, small_batches, tidy

FEATURES = 1 << 16
MAX_ROWS = 20_000
#: Code points of n-grams; a blank stands before and after each word.
SIZES = (1, 2, 3, 4, 5)
#: The most that a word speaks against a language, and the price of a switch.
CLIP, SWITCH = 10.0, 14.0
#: Share of a language's words in a script from which on it is a candidate for that script.
CANDIDATE = 0.01
#: Words of a chunk: texts are labelled chunk by chunk for every state before it, then joined.
CHUNK = 256
#: Words of which a task keeps the scores.
CACHE = 150_000
#: Numbers that the look ahead over chunks may hold at a time.
AHEAD = 1 << 22
#: A letter, then letters and the marks that combine with them (categories L, then L and M).
RUN = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
#: First code points of ranges of scripts; a range ends where the next one starts.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0x20000, "han"), (0x31350, "other"),
]
STARTS = np.array([a for a, _ in SCRIPTS])
NAMES = sorted({n for _, n in SCRIPTS})
SCRIPT_AT = np.array([NAMES.index(n) for _, n in SCRIPTS])


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all words' n-grams, the word each belongs to, and each word's script."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    blank = codes == 32
    word = np.cumsum(blank) - 1  # the blank before a word counts as the word's
    ends = np.flatnonzero(blank)
    scripts = SCRIPT_AT[np.searchsorted(STARTS, codes[ends[:-1] + 1].astype(np.int64), "right") - 1]
    # where the word of each position ends, so that no n-gram runs on into the next word
    end = ends[np.minimum(word + 1, len(ends) - 1)]
    features, owners, h = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(SIZES) + 1):
        h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in SIZES:
            at = np.arange(len(h))
            at = at[(at + n - 1 <= end[: len(h)]) & ~(blank[: len(h)] & (n == 1)) & (word[: len(h)] < len(words))]
            x = (h[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            features.append((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40))
            owners.append(word[at])
    return (np.concatenate(features) % np.uint64(FEATURES)).astype(np.int64), np.concatenate(owners), scripts


def words_of(text: str) -> list[str]:
    """Runs of letters with their marks, in lower case; numerals end a word."""
    return RUN.findall(text.lower())


COUNTED = pa.schema([("lang", pa.string()), ("feature", pa.int64()), ("n", pa.int64())])


@tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams (feature >= 0) and of words by script (feature = -1 - script) for each language."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(words_of(text or ""))
        for lang, count in words.items():
            if count:
                features, owner, scripts = grams(list(count))
                times = np.array(list(count.values()))
                own = total.setdefault(lang, np.zeros(FEATURES + len(NAMES), np.int64))
                own += np.bincount(np.concatenate([features, FEATURES + scripts]), np.concatenate([times[owner], times]), len(own)).astype(np.int64)
    for lang, own in total.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(np.where(at < FEATURES, at, FEATURES - 1 - at)), pa.array(own[at])], schema=COUNTED)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        """counts: a row for each feature, a column for each language; scripts: a row for each script."""
        self.langs = langs
        smooth = counts + 0.5
        self.score = np.log(smooth / smooth.sum(0)).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(0), 1)
        self.candidate = share >= CANDIDATE
        self.candidate[~self.candidate.any(1)] = True  # a script that nothing is known about leaves all
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(langs)), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Scores (0 for the best language, less for others) of words, a row for each."""
        if len(self.known) > CACHE:
            self.known, self.rows = {}, self.rows[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            features, owner, scripts = grams(new)
            own = np.stack([np.bincount(owner, self.score[features, k], len(new)) for k in range(len(self.langs))], 1)
            own[~self.candidate[scripts]] = -np.inf
            own = np.maximum(own - own.max(1, keepdims=True), -CLIP).astype(np.float32)
            self.known.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, own])
        return self.rows[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]


def _forward(value: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """One word on: value (..., label) is that of the best way to each label; the new one is changed in place."""
    np.maximum(value, value.max(-1, keepdims=True) - np.float32(SWITCH), out=value)
    value += scores
    return value


def _through(scores: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For chunks, longest first: value of the best way from each label before a chunk to each label at its end."""
    k = scores.shape[1]
    value = np.full((len(first), k, k), -np.inf, np.float32)
    value[:, np.arange(k), np.arange(k)] = 0
    for t in range(int(length[0])):
        n = int(np.searchsorted(-length, -t, "left"))
        _forward(value[:n], scores[first[:n] + t][:, None, :])
    return value


def _labels(scores: np.ndarray, first: np.ndarray, length: np.ndarray, before: np.ndarray, after: np.ndarray, out: np.ndarray) -> None:
    """Labels of the words of runs, longest first, given the label before a run (-1: any) and at its end (-1: the best)."""
    k, longest = scores.shape[1], int(length[0])
    value = np.where((before[:, None] < 0) | (before[:, None] == np.arange(k)), np.float32(0), np.float32(-np.inf))
    live = np.searchsorted(-length, -np.arange(longest), "left")  # runs that have a word t
    stays, bests = [], []
    for t in range(longest):
        now = value[: live[t]]
        bests.append(now.argmax(1).astype(np.uint16))
        stays.append(now >= now.max(1, keepdims=True) - np.float32(SWITCH))
        _forward(now, scores[first[: live[t]] + t])
    label = np.where(after < 0, value.argmax(1), after)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        out[first[:n] + t] = label[:n]
        label[:n] = np.where(stays[t][np.arange(n), label[:n]], label[:n], bests[t])


def viterbi(scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Best label of each word of several texts (sizes: words of each, at least one)."""
    k, starts, chunks = scores.shape[1], np.concatenate([[0], np.cumsum(sizes)]), -(-sizes // CHUNK)
    text = np.repeat(np.arange(len(sizes)), chunks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first = starts[text] + number * CHUNK
    length = np.minimum(starts[text + 1], first + CHUNK) - first
    before, after = np.full(len(text), -1), np.full(len(text), -1)
    many, step = np.flatnonzero(chunks[text] > 1), max(1, AHEAD // (k * k))
    for a in range(0, len(many), step):
        own = many[a : a + step]
        order = np.argsort(-length[own], kind="stable")
        ways = np.empty((len(own), k, k), np.float32)
        ways[order] = _through(scores, first[own[order]], length[own[order]])
        for at, way in zip(own.tolist(), ways, strict=True):
            if number[at] == 0:
                total, back = np.zeros(k, np.float32), []
            through = total[:, None] + way
            back.append(through.argmax(0).astype(np.uint16))
            total = through.max(0)
            if len(back) == chunks[text[at]]:  # the labels at the ends of this text's chunks
                label = int(total.argmax())
                for b in reversed(back):
                    after[at] = label
                    before[at] = label = int(b[label])
                    at -= 1
    out, order = np.zeros(len(scores), np.int64), np.argsort(-length, kind="stable")
    step = max(1, AHEAD * 8 // (k * CHUNK))
    for a in range(0, len(order), step):
        own = order[a : a + step]
        _labels(scores, first[own], length[own], before[own], after[own], out)
    return out


def train(docs: DataFrame, max_rows: int = MAX_ROWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, n-gram counts and script counts. docs: text, lang and doc_id."""
    known = docs.filter("lang is not null").filter(~held_out())
    share = min(1.0, max_rows / max(known.count(), 1))
    chosen = known.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string")), F.lit(1 << 30)) < F.lit(int((1 << 30) * share)))
    rows = chosen.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    got = rows.mapInArrow(_count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    number = {x: i for i, x in enumerate(langs)}
    column = np.array([number[x] for x in got["lang"].to_pylist()], np.int64)
    feature, n = (got[c].to_numpy().astype(np.int64) for c in ("feature", "n"))
    counts, scripts = np.zeros((FEATURES, len(langs)), np.float32), np.zeros((len(NAMES), len(langs)))
    counts[feature[feature >= 0], column[feature >= 0]] = n[feature >= 0]
    scripts[-1 - feature[feature < 0], column[feature < 0]] = n[feature < 0]
    return langs, counts, scripts


def label(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score and spans (lang, first word, word after the last) of each row of docs."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value) if sent.value[0] else None
        for batch in batches:
            words = [words_of(t or "") for t in batch["text"].to_pylist()]
            sizes = np.array([len(w) for w in words])
            best, shares, spans = ["und"] * len(words), [0.0] * len(words), [[] for _ in words]
            flat = [w for ws in words for w in ws]
            if own and flat:
                labels = viterbi(own.look_up(flat), sizes[sizes > 0])
                letters = np.fromiter(map(len, flat), np.int64, len(flat))
                at = 0
                for i in np.flatnonzero(sizes):
                    mine = labels[at : at + sizes[i]]
                    held = np.bincount(mine, letters[at : at + sizes[i]], len(own.langs))
                    best[i], shares[i] = own.langs[int(held.argmax())], float(held.max() / held.sum())
                    edges = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), len(mine)]
                    spans[i] = [{"lang": own.langs[mine[a]], "from": a, "to": b} for a, b in zip(edges, edges[1:])]  # noqa: B905
                    at += sizes[i]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(best), pa.array(shares, pa.float64()), pa.array(spans, kind)], names=["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, spans array<struct<lang:string,from:long,to:long>>")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return label(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
