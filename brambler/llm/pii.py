"""Personal data by bootstrapped contextual extraction (operator 5).

One pass finds the base spans (email, ip, card, phone by fixed rules) and notes the lexical patterns of each of them and
of every other token that looks like an identifier:

* before it, the last two words, or one word that ends in a cue such as a colon;
* behind it, the next two words;
* its own form, where a kind has no checksum or range that a form can't tell: letters and runs of digits of an email, and
  the groups of a phone without its country code.

Patterns and tokens (instances) are the two sides of a graph. Base spans are the seeds. Spark scores in rounds: a
pattern by the share of its occurrences that instances of a kind fill, an instance by its patterns together. Patterns
with high scores and several different seeds then give their kind to the other tokens they stand at, where the token's
digits or signs allow that kind.

All counts cover the whole corpus; tokens, contexts and documents may be of any length. n_email to n_phone and
base_sha256 tell of the base spans, spans of all. To measure what patterns find, a share of the seeds can be hidden:
hidden ones are tokens like others (hidden_seeds()).
Odd input: a null or empty text has no spans; repeated rows are read each on their own, and count again in the graph
only as further occurrences; other columns are not looked at; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, saved, small_batches, tidy

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[0-9]")
SPACE = re.compile(r"\s")
#: What may stand between the digits of a group-wise identifier, and its groups one after another.
GROUPED = re.compile(r"[+(]?[0-9]++(?=[ ().-]{1,3}[0-9])")
NEXT = re.compile(r"[ ().-]{1,3}[0-9]++")
#: Digits that a card may have at least and at most, and a phone, if they don't keep the kind's rule.
CARD_DIGITS, PHONE_DIGITS = (12, 19), (7, 15)
#: Words of a pattern, and the characters before a token in which they are looked for first.
WORDS, BEFORE = 2, 48
CUES = ":=#"
ROUNDS = 3
#: A pattern is trusted from this score and this many different seeds on.
TRUST, SEEDS = 0.8, 3


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches; each @ is looked at once, with the characters that may stand before it since the last one."""
    done = 0
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        size = len(before) - len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if size else None
        if found:
            yield at - size, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    twice = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in m[0].split(".")) and all(int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.findall(m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def pattern_before(text: str, start: int) -> str | None:
    """The lexical pattern that ends where a token starts; None if too little stands there."""
    size, words = BEFORE, []
    while True:
        at = max(0, start - size)
        before = text[at:start]
        words = before.lower().split()
        sign = any(map(SIGN.search, words[-WORDS:]))
        if at and words and not before[0].isspace():
            words = words[1:]  # may be cut in the middle
        if words and words[-1][-1] in CUES and not SIGN.search(words[-1]):
            return words[-1]
        if len(words) >= WORDS or not at or sign:
            break
        size *= 4
    words = words[-WORDS:]
    return " ".join(words) if len(words) == WORDS and not sign else None


def pattern_behind(text: str, end: int) -> str | None:
    """The two words that follow a token; None if there are fewer or one looks like an identifier itself."""
    size = BEFORE
    while True:
        after = text[end : end + size]
        words = after.lower().split()
        if any(map(SIGN.search, words[:WORDS])):
            return None  # a sign rules the words out, however long they are
        if end + size < len(text) and words and not after[-1].isspace():
            words = words[:-1]  # may be cut in the middle
        if len(words) >= WORDS or end + size >= len(text):
            break
        size *= 4
    words = words[:WORDS]
    return " ".join(words) if len(words) == WORDS else None


COUNTRY = re.compile(r"^\+[0-9]{1,3}[ .-]*(?=[(0-9])")


def form(kind: int, token: str) -> str | None:
    """The form of an email or phone; None for other kinds, whose rules are about values."""
    if kind == 3:
        token = re.sub("[0-9]", "9", COUNTRY.sub("", token))
        return token if re.search("[^0-9]", token) else None  # digits alone may be anything
    return re.sub("[0-9]+", "9", re.sub("[A-Za-z]+", "a", token)) if kind == 0 else None


def patterns_of(text: str, start: int, end: int, kinds: list[int]) -> list[str]:
    """All patterns of a token, each with a letter for its sort in front."""
    found = [("l", pattern_before(text, start)), ("r", pattern_behind(text, end)), *((f"f{k}", form(k, text[start:end])) for k in kinds)]
    return [f"{sort} {p}" for sort, p in found if p]


def allowed(kind: int, token: str) -> bool:
    """Whether a token can be of a kind at all, though it doesn't keep the kind's rule."""
    digits = len(DIGITS.findall(token))
    return (kind == 0 and "@" in token) or (kind == 1 and token.count(".") >= 3 and digits >= 4) or (kind == 2 and CARD_DIGITS[0] <= digits <= CARD_DIGITS[1]) or (kind == 3 and PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1] and "@" not in token)


def grown(text: str, start: int, least: int, limit: int) -> list[tuple[int, int]]:
    """(kind, end) for card and phone where the digits from start on, over the blanks, parentheses, dots and hyphens
    between their groups, give one; each as long as the kind allows. Ends are behind least, none beyond limit."""
    first = GROUPED.match(text, start)
    if not first:
        return []
    best: dict[int, int] = {}
    end, digits, plain = first.end(), len(DIGITS.findall(first[0])), text[start] not in "+("
    while m := NEXT.match(text, end):
        mark = m[0].rstrip("0123456789")
        end, digits, plain = m.end(), digits + len(m[0]) - len(mark), plain and mark in (" ", "-")
        if end > limit or digits > CARD_DIGITS[1]:
            break
        if end > least and not (text[end : end + 1].isalnum() or text[end : end + 1] in ("@", "_")):
            if plain and digits >= CARD_DIGITS[0]:
                best[2] = end
            if PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1]:
                best[3] = end
    return sorted(best.items())


def hidden(token: str) -> bool:
    """Whether a seed is among the fifth that is hidden for measuring."""
    return zlib.crc32(token.lower().encode()) % 5 == 0


def occurrences(text: str, base: list[tuple[int, int, int]], hide: bool = False) -> list[dict]:
    """Base spans and identifier-like tokens, each with patterns and instance; kinds: bits of the kinds it may get.

    A token grows over the groups of digits behind it for a card or phone that it can't be alone. Of several spans at a
    place only the first has an instance, so that the place counts once.
    """
    out = []
    for kind, a, b in base:
        if p := patterns_of(text, a, b, [kind]):
            seed = not (hide and hidden(text[a:b]))
            out.append({"patterns": p, "instance": text[a:b].lower(), "seed": kind if seed else None, "kinds": 0 if seed else 1 << kind, "start": a, "end": b})
    taken = sorted((a, b) for _, a, b in base)
    done, k = 0, 0
    for m in SIGN.finditer(text):
        if m.start() < done:
            continue
        a, b = m.start(), m.end()
        while a > done and not text[a - 1].isspace():
            a -= 1
        space = SPACE.search(text, b)
        b = done = space.start() if space else len(text)
        while a < b and text[a] in "\"'([{<":
            a += 1
        opened = a > 0 and text[a - 1] == "("
        while b > a and text[b - 1] in ".,;:!?\"')]}>":
            b -= 1
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        # spans from k on end behind a, but for some that lie in longer ones; they are in order of their starts
        if any(y > a for x, y in itertools.takewhile(lambda span: span[0] < b, itertools.islice(taken, k, None))):
            continue
        token = text[a:b]
        kinds = sum(1 << i for i in range(len(KINDS)) if allowed(i, token))
        # a "(" that is closed behind the first digits is part of the run
        start = a - 1 if opened and text[b : b + 1] == ")" and token.isdigit() else a
        ends = [(i, e) for i, e in grown(text, start, b, taken[k][0] if k < len(taken) else len(text)) if not kinds >> i & 1]
        if not ends and b - a < 4:
            continue
        if not kinds and ends:
            done = max(done, max(e for _, e in ends))
        spans = [(a, b, kinds)] * bool(kinds or not ends) + [(start, e, 1 << i) for i, e in sorted(ends, key=lambda x: -x[1])]
        for n, (x, y, own) in enumerate(spans):
            if p := patterns_of(text, x, y, [i for i in range(len(KINDS)) if own >> i & 1]):
                out.append({"patterns": p, "instance": None if n else text[x:y].lower(), "seed": None, "kinds": own, "start": x, "end": y})
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SPAN = "array<struct<kind:int,start:long,end:long>>"
SEEN = "array<struct<patterns:array<long>,instance:long,seed:int,kinds:int,start:long,end:long>>"


def _look(hide: bool):
    number = lambda s: xxhash.xxh3_64_intdigest(s) - 2**63
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    note = pa.list_(pa.struct([("patterns", pa.list_(pa.int64())), ("instance", pa.int64()), ("seed", pa.int32()), ("kinds", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, seen = [], []
            for text in batch["text"].to_pylist():
                base = base_spans(text or "")
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
                found = occurrences(text or "", base, hide)
                seen.append([o | {"patterns": [number(p) for p in o["patterns"]], "instance": None if o["instance"] is None else number(o["instance"])} for o in found])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, span), pa.array(seen, note)], names=["doc_id", "base", "seen"])

    return run


def trusted_patterns(seen: DataFrame) -> DataFrame:
    """(pattern, kind, score) of the patterns that are trusted, from rows (pattern, instance, seed)."""
    edges = saved(seen.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-graph")
    seeds = edges.filter("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind")).withColumn("score", F.lit(1.0))
    scores, patterns = seeds, None
    size = edges.groupBy("pattern").agg(F.sum("n").alias("size"))
    for _ in range(ROUNDS):
        filled = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("filled"), F.count_if(F.col("score") >= 1).alias("seeds"))
        patterns = saved(filled.join(size, "pattern").select("pattern", "kind", "seeds", (F.col("filled") / (F.col("size") + 0.5)).alias("score")), "pii-patterns")
        good = patterns.filter(F.col("seeds") >= SEEDS).select("pattern", "kind", F.col("score").alias("trust"))
        found = edges.filter("seed is null").join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("score"))
        # a seed keeps its score; all others get one anew
        scores = saved(seeds.unionByName(found.join(seeds.select("instance"), "instance", "left_anti").select("instance", "kind", F.least("score", F.lit(0.99)).alias("score"))), "pii-scores")
    return patterns.filter((F.col("score") >= TRUST) & (F.col("seeds") >= SEEDS)).select("pattern", "kind", "score")


def find_pii(docs: DataFrame, hide: bool = False) -> DataFrame:
    """doc_id, base (spans by rule) and more (spans that patterns add) of each row of docs; hide: see hidden_seeds()."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_look(hide), f"doc_id {dict(docs.dtypes)['doc_id']}, base {SPAN}, seen {SEEN}")
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "pii")
    seen = rows.select("row", F.explode("seen").alias("o")).select("row", "o.*").withColumn("pattern", F.explode("patterns")).drop("patterns")
    trusted = trusted_patterns(seen.filter("instance is not null").select("pattern", "instance", "seed"))
    new = seen.filter("seed is null and kinds > 0").join(trusted, "pattern").filter("(shiftright(kinds, kind) & 1) = 1")
    # of the spans that start at one place the one with the best pattern stays, then the longest; what overlaps a span
    # that starts before it goes
    best = F.max_by(F.struct("kind", "end"), F.struct("score", "end", -F.col("kind"))).alias("best")
    new = new.groupBy("row", "start").agg(best).select("row", "start", "best.*")
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = new.withColumn("past", F.max("end").over(before)).filter("past is null or past <= start")
    more = new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("more"))
    return rows.drop("seen").join(more, "row", "left").select("doc_id", "base", F.coalesce("more", F.array().cast(SPAN)).alias("more"))


def hidden_seeds(docs: DataFrame) -> DataFrame:
    """kind (its number), hidden, found and added: with a fifth of the identifiers hidden, their spans, those of them that
    patterns bring back, and all spans that patterns give this kind. docs must have different ids."""
    spans = find_pii(docs, hide=True).join(docs.select("doc_id", "text"), "doc_id")
    told = spans.select("doc_id", "text", F.explode("base").alias("s")).select("doc_id", F.expr("substring(text, int(s.start) + 1, int(s.end - s.start))").alias("token"), "s.*")
    told = told.filter(F.crc32(F.lower("token").cast("binary")) % 5 == 0).withColumn("hidden", F.lit(1))
    more = spans.select("doc_id", F.explode("more").alias("s")).select("doc_id", "s.*").withColumn("added", F.lit(1))
    both = told.join(more, ["doc_id", "kind", "start", "end"], "full")
    return both.groupBy("kind").agg(F.count("hidden").alias("hidden"), F.count(F.when(F.col("hidden") == 1, F.col("added"))).alias("found"), F.count("added").alias("added"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    text = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.array_compact(F.transform("base", lambda s: F.when(s["kind"] == F.lit(k), 1)))).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_added"))


def base_sha256(text: str) -> str:
    return hashlib.sha256(told(base_spans(text)).encode()).hexdigest()
