"""Near-duplicate documents by SetSketch registers (operator 10).

A document's set is its distinct runs of five words. Its sketch has M registers: register i holds the smallest of the
exponential values that the set's elements draw for i, on a scale of powers of BASE and cut to 16 bits. Sketches of
unions are the larger values register by register (merge()), and equal registers are the likelier the more similar two
sets are. Runs of ROWS registers are hashed as bands, and documents that share a band's value are candidates:

1. Every member of a band is told the band's first member and the one before it. Of all these partners each document
   is compared with two, those it shares most bands with. That is work in proportion to the documents, however many
   share a band, and joins nearly all that belongs together.
2. Bands whose members are in different components after that are compared whole, but for pairs of one component: by
   the joint likelihood of their registers (how many are larger, smaller, equal), which rules out pairs far below the
   threshold. A pair counts in the first band it shares. Large bands go by classes of size (similar sets differ by one
   class at most) and in blocks of bounded size, whose rows are registers without texts.
3. Pairs that are left are confirmed on the full sets, block by block, but for those that other links of the block join
   already. A block gets a row with the text of each member that is in such a pair, not one for each pair, and gives no
   more links than it has members.

With 60 bands of 6 registers a pair at the threshold of 0.75 is missed in under 1 of 100,000 cases (0.822^60), one of
0.8 in under 1 of 10^8. Equal sets are one class from the start, by a 128-bit digest.

Odd input: without words (null, empty, blank) a set is empty and linked with nothing; a null doc_id counts as the
largest id inside and its component_id is null if no row of its group has an id; rows that share a doc_id (or have
none) are told apart by their texts and grouped each by its own, and of a group all rows with the smallest id are kept;
very long texts are one set like any other; other columns are not looked at; a table without rows gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, doc_key, own_names, read, saved, small_batches, texts, tidy
from .graph import components
from .words import WordHashes, hashed, mix, shingles

BANDS, ROWS = 60, 6
M = BANDS * ROWS
BASE = 1.001
#: Register values are 1 - log(smallest value, BASE), so that sets of 1 to 10^12 elements fit 16 bits.
TOP = 2**16 - 2
#: Shares of the union, in hundredths: links need 100 * intersection >= 75 * union.
PERCENT = 75
#: Members of a band that are compared as one block, pairs and elements of sets that a task confirms at once, about.
BLOCK, PAIRS, ELEMENTS = 512, 400, 400_000
#: Members of a block up to which its pairs are looked at together with those of other blocks.
FEW = 24


def sketches(sets: list[np.ndarray], m: int = M) -> np.ndarray:
    """Registers (a row of m for each set) of sets of 64-bit hashes; an empty set's are 0.

    The values an element draws for all registers are the points of one random process with m points per unit of
    time, each belonging to a random register. Only points before a time that leaves hardly a register empty count;
    the few sets with an empty register are done again with more time.
    """
    least = np.full((len(sets), m), np.inf)
    sizes = np.array([len(s) for s in sets])
    todo, reach = np.flatnonzero(sizes), math.log(m) + 2.5
    while len(todo):
        # an element of a small set has many points before that time: they are drawn a block at a time
        width = np.clip(2 ** np.floor(np.log2(reach * m / sizes[todo])), 1, 512).astype(int)
        for w in np.unique(width):
            _draw([(i, sets[i]) for i in todo[width == w]], int(w), reach, least.reshape(-1), m)
        todo = todo[np.isinf(least[todo]).any(1)]
        least[todo] = np.inf
        reach *= 2
    with np.errstate(divide="ignore"):
        values = np.floor(1 - np.log(least) / math.log(BASE)) + TOP // 3
    return np.clip(values, 0, TOP).astype(np.uint16)


def _draw(sets: list[tuple[int, np.ndarray]], width: int, reach: float, least: np.ndarray, m: int) -> None:
    """Lowers `least` (m values for each set's number) by the points of the sets' elements, `width` of them at a time."""
    x = np.concatenate([s for _, s in sets])
    number, sizes = np.array([i for i, _ in sets]), np.array([len(s) for _, s in sets])
    own, until = np.repeat(number, sizes), np.repeat(reach / sizes, sizes)
    at, k = np.zeros(len(x)), 0
    while len(x):
        step = np.arange(k + 1, k + width + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        k += width
        h = mix(x[:, None] + step)
        time = np.log1p((h >> np.uint64(11)) * -(2.0**-53)) / -m
        time[:, 0] += at
        time = np.cumsum(time, 1)
        early = time < until[:, None]
        at, points = time[:, -1], h[early]
        register = ((mix(points + np.uint64(1)) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        np.minimum.at(least, np.repeat(own, early.sum(1)) * m + register.astype(np.int64), time[early])
        left = early[:, -1]
        x, own, until, at = x[left], own[left], until[left], at[left]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sketched sets."""
    return np.maximum(a, b)


GRID = np.linspace(0, 1, 101)


def likeliest(a: np.ndarray, sizes_a: np.ndarray, b: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """For each row the Jaccard similarity of two sketched sets that makes their registers likeliest.

    With sizes as shares u and v of their sum, a register of the first is larger with probability p(u - v J), smaller
    with p(v - u J) and equal otherwise, where p(x) = -log(1 - x (BASE - 1) / BASE, BASE).
    """
    larger, smaller = (a > b).sum(1), (a < b).sum(1)
    u = (sizes_a / (sizes_a + sizes_b))[:, None]
    p = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-9, 1)
    up, down = p(u - (1 - u) * GRID), p((1 - u) - u * GRID)
    even = np.clip(1 - up - down, 1e-9, 1)
    score = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + (a.shape[1] - larger - smaller)[:, None] * np.log(even)
    score[GRID[None, :] > np.minimum(u / (1 - u), (1 - u) / u) + 0.01] = -np.inf
    return GRID[score.argmax(1)]


def likely(i: np.ndarray, j: np.ndarray, registers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of rows their registers don't rule out."""
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 2048):
        x, y = i[at : at + 2048], j[at : at + 2048]
        out[at : at + 2048] = likeliest(registers[x], sizes[x], registers[y], sizes[y]) >= PERCENT / 100 - MARGIN
    return out


#: Estimates this far under the threshold (4.5 standard deviations: 1 of 300,000 at it) rule a pair out.
MARGIN = 4.5 * math.sqrt(0.75 * 0.25 / M)

SIGNED = pa.schema([("doc", pa.int64()), ("own", pa.string()), ("n", pa.int64()), ("key", pa.binary()), ("registers", pa.binary())])


@tidy
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, seen = WordHashes(), set()
    for batch in batches:
        sets = [shingles(hashed(t, cache)) for t in texts(batch["text"])]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        new = []
        for i, k in enumerate(keys):
            if k and k not in seen:  # a task sketches each set once
                seen.add(k)
                new.append(i)
        registers: list[bytes | None] = [None] * len(sets)
        for part in range(0, len(new), 256):
            own = new[part : part + 256]
            for i, r in zip(own, sketches([sets[i] for i in own]), strict=True):
                registers[i] = r.tobytes()
        yield pa.RecordBatch.from_arrays([batch["doc"], batch["own"].cast(pa.string()), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(registers, pa.binary())], schema=SIGNED)


@tidy
def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each band's registers, whose last 6 bits are the band's number."""
    tag = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))
    for batch in batches:
        registers = registers_of(batch["registers"]).reshape(-1, BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(tag, registers.shape[:2]).copy()
        for j in range(ROWS):
            h = mix(h * np.uint64(31) + registers[:, :, j])
        h = (h & np.uint64(2**64 - 64)) | np.arange(BANDS, dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(batch["rep"].to_numpy(), BANDS))], names=["band", "rep"])


def registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


SHARED = pa.schema([("band", pa.int64()), ("rep", pa.int64()), ("head", pa.int64()), ("prior", pa.int64())])


@tidy
def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (band, rep). All members of a band but its first one, with that one and the one before them."""
    band = rep = head = np.zeros(0, np.int64)  # the last row that was seen
    for batch in batches:
        if not batch.num_rows:
            continue
        last = len(band)
        band, rep = np.concatenate([band, batch["band"].to_numpy()]), np.concatenate([rep, batch["rep"].to_numpy()])
        new = np.concatenate([[True], band[1:] != band[:-1]])
        starts = np.flatnonzero(new)
        own = rep[starts]
        if last:
            own[0] = head[0]
        heads = own[np.cumsum(new) - 1]
        at = np.flatnonzero(~new)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (band[at], rep[at], heads[at], rep[at - 1])], schema=SHARED)
        band, rep, head = band[-1:], rep[-1:], heads[-1:]


NEAR = pa.schema([("block", pa.int64()), ("rep", pa.int64()), ("comp", pa.int64()), ("n", pa.int64()), ("band", pa.int64()), ("side", pa.int32()), ("half", pa.int32())])


def _survivors(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For whole blocks, sorted: pairs of members that the block has to tell of and that their registers don't rule out."""
    block, rep, comp, n, band, side, half = (rows[c].to_numpy() for c in NEAR.names)
    registers = registers_of(rows["registers"].combine_chunks())
    new = np.concatenate([[True], block[1:] != block[:-1]])
    group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(rep)))

    def told(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (comp[i] != comp[j]) & (rep[i] != rep[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
        ok &= ~((side[i] == 1) & (side[j] == 1)) & ((half[i] < 0) | (half[i] != half[j]))
        i, j = i[ok], j[ok]
        same = (registers[i] == registers[j]).reshape(-1, BANDS, ROWS).all(2)
        ok = same.any(1) & (same.argmax(1) == (band[i] & 63))
        i, j = i[ok], j[ok]
        ok = likely(i, j, registers, n)
        return i[ok], j[ok]

    found = []
    small = np.flatnonzero(sizes[group] <= FEW)
    for d in range(1, min(FEW, int(sizes.max()))):
        i = small[small + d < len(rep)]
        i = i[group[i] == group[i + d]]
        found += [told(i[at : at + 4096], i[at : at + 4096] + d) for at in range(0, len(i), 4096)]
    for g in np.flatnonzero(sizes > FEW):
        end = starts[g] + sizes[g]
        for i in range(starts[g], end - 1):
            j = np.arange(i + 1, end)
            found.append(told(np.full(len(j), i), j))
    i, j = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
    return i, j


def _open_members(rows: pa.Table) -> pa.RecordBatch:
    """Members of whole blocks that are in a pair to confirm."""
    at = np.unique(np.concatenate(_survivors(rows)))
    return rows.select(NEAR.names).cast(NEAR).take(pa.array(at)).combine_chunks().to_batches()[0] if len(at) else pa.RecordBatch.from_pylist([], NEAR)


@tidy
def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, 2 * BLOCK for one at most; the last block of a batch waits for the next batch."""
    left: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = pa.Table.from_batches([batch])
        rows = own if left is None else pa.concat_tables([left, own])
        block = rows["block"].to_numpy()
        cut = int(np.flatnonzero(block != block[-1])[-1]) + 1 if block[0] != block[-1] else 0
        left = rows.slice(cut)
        if cut:
            yield _open_members(rows.slice(0, cut))
    if left is not None:
        yield _open_members(left)


@tidy
def _confirm(rows: pa.Table) -> pa.Table:
    """Links between members of some blocks in different components, without those that other links already join."""
    rows = rows.sort_by("block")
    i, j = _survivors(rows)
    names, at = np.unique(rows["rep"].to_numpy(), return_index=True)
    own = np.searchsorted(names, rows["rep"].to_numpy())
    cache, text = WordHashes(), rows["text"].combine_chunks()
    sets = [shingles(hashed(t, cache)) for t in texts(text.take(pa.array(at)))]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    _, group = np.unique(rows["comp"].to_numpy()[at], return_inverse=True)
    marked, out = np.zeros(len(ids), bool), []
    a, b = own[i], own[j]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    for x, ys in zip(*(lambda u, k: (u, np.split(b, k[1:])))(*np.unique(a, return_index=True)), strict=True):
        marked[ids[starts[x] : starts[x + 1]]] = True
        for y in ys:
            if group[y] != group[x]:
                shared = int(np.count_nonzero(marked[ids[starts[y] : starts[y + 1]]]))
                if 100 * shared >= PERCENT * (sizes[x] + sizes[y] - shared):
                    out.append((names[x], names[y]))
                    group[group == group[y]] = group[x]
        marked[ids[starts[x] : starts[x + 1]]] = False
    return pa.Table.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=LINK)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@tidy
def _verify(pairs: pa.Table, rows: pa.Table) -> pa.Table:
    """The pairs of one task that are linked, without those that its other links already join."""
    names, text = rows["rep"].to_numpy(), rows["text"].combine_chunks()
    order = np.argsort(names)
    a, b = (order[np.searchsorted(names[order], pairs[c].to_numpy())] for c in ("a", "b"))
    ok = likely(a, b, registers_of(rows["registers"].combine_chunks()), rows["n"].to_numpy())
    sort = np.lexsort((b[ok], a[ok]))
    group, cache, out, last, own = np.arange(len(names)), WordHashes(), [], -1, None
    for i, j in zip(a[ok][sort].tolist(), b[ok][sort].tolist(), strict=True):
        if group[i] == group[j]:
            continue
        set_of = lambda k: shingles(hashed(texts(text.slice(k, 1))[0], cache))
        if i != last:
            last, own = i, set_of(i)
        if similar(own, set_of(j)):
            out.append((names[i], names[j]))
            group[group == group[j]] = group[i]
    return pa.Table.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=LINK)


def text_key() -> Column:
    """With doc_key() a row's identity; rows that are equal in both are in one group."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def shared_bands(classes: DataFrame) -> DataFrame:
    """(band, rep, head, prior) of each member of a band but its first: a row for each band that a class shares."""
    bands = classes.select("rep", "registers").mapInArrow(_bands, "band long, rep long")
    return saved(bands.repartition("band").sortWithinPartitions("band", "rep").mapInArrow(_shared, "band long, rep long, head long, prior long"), "bands")


def first_partners(shared: DataFrame) -> DataFrame:
    """(block, a, b): each class with the two partners that it shares most bands with; PAIRS of them are a block."""
    counts = shared.groupBy("rep", "head").count().withColumnRenamed("head", "a").unionByName(shared.groupBy("rep", "prior").count().withColumnRenamed("prior", "a"))
    most = counts.groupBy("rep", "a").agg(F.max("count").alias("count")).groupBy("rep").agg(F.max_by("a", F.struct("count", -F.col("a"))).alias("a"), F.max_by("a", F.struct("count", "a")).alias("z"))
    pairs = most.select(F.explode(F.array_distinct(F.array("a", "z"))).alias("a"), F.col("rep").alias("b"))
    # pairs of one first partner are confirmed together, in parts if they are many
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts")).filter("parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"), F.lit(0))
    return pairs.join(many, "a", "left").select(F.xxhash64("a", part).alias("block"), "a", "b")


def open_members(shared: DataFrame, components_of: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of bands, in blocks, that are in a pair of different components which registers don't rule out."""
    comp = components_of.select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    heads = comp.select(F.col("rep").alias("head"), F.col("comp").alias("first"))
    placed = shared.select("band", "rep", "head").join(comp, "rep", "left").join(heads, "head", "left")
    mixed = placed.filter(F.coalesce("comp", "rep") != F.coalesce("first", "head")).select("band").distinct()
    mixed = saved(shared.select("band", "rep", "head").join(mixed, "band"), "mixed-bands")
    members = mixed.select("band", "rep").unionByName(mixed.select("band", F.col("head").alias("rep")).distinct())
    members = members.join(classes.select("rep", "n"), "rep").join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    members = saved(members, "band-members")
    large = members.groupBy("band").count().filter(F.col("count") > BLOCK).select("band", F.lit(True).alias("large"))
    level = F.floor(F.log("n") / F.lit(math.log(100 / PERCENT)) + 1e-9).cast("int")
    at = lambda k, side: F.struct(k.cast("int").alias("level"), F.lit(side).alias("side"))
    levels = F.when(F.col("large"), F.array(at(level, 0), at(level + 1, 1))).otherwise(F.array(at(F.lit(-1), 0)))
    sized = members.join(large, "band", "left").select("band", "rep", "comp", F.explode(levels).alias("at")).select("band", "rep", "comp", "at.*")
    parts = sized.groupBy("band", "level").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.min("side").alias("own"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    parts = saved(parts.filter("own = 0 and low < high").drop("own", "low", "high"), "band-parts")  # read anew, so that Spark can split a large band
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    cut = sized.join(parts, ["band", "level"]).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = F.xxhash64("band", "level", F.least("part", "other"), F.greatest("part", "other"))
    half = F.when(F.col("part") == F.col("other"), -1).otherwise((F.col("part") > F.col("other")).cast("int"))
    rows = cut.select("band", "rep", "comp", F.col("side"), block.alias("block"), half.cast("int").alias("half")).join(classes.select("rep", "n", "registers"), "rep")
    return rows.repartition("block").sortWithinPartitions("block", "side", "rep").mapInArrow(_near, "block long, rep long, comp long, n long, band long, side int, half int")


def confirmed(members: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between open_members(). Small blocks are put together, so that a task's groups are few."""
    members = saved(members, "open-members")
    total = members.agg(F.count("*").alias("n"), F.sum("n").alias("elements")).first()
    tasks = max(1, -(-total.n // (2 * BLOCK)), -(-(total.elements or 0) // ELEMENTS))
    sent = members.join(rows.drop("n"), "rep").withColumn("task", F.pmod("block", F.lit(tasks)))
    return saved(sent.groupBy("task").applyInArrow(_confirm, "a long, b long"), "near-links")


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the pairs (block, a, b) that full sets confirm. Small blocks are put together, so that a task's groups
    are few; rows: rep, n, registers and text of all that may be in a pair."""
    pairs = saved(pairs, "near-pairs")
    sizes = rows.select("rep", "n")
    work = pairs.join(sizes.withColumnRenamed("rep", "a").withColumnRenamed("n", "n_a"), "a").join(sizes.withColumnRenamed("rep", "b").withColumnRenamed("n", "n_b"), "b")
    total = work.agg(F.count("*").alias("pairs"), F.sum(F.col("n_a") + F.col("n_b")).alias("elements")).first()
    blocks = max(1, -(-total.pairs // PAIRS), -(-(total.elements or 0) // ELEMENTS))
    pairs = pairs.withColumn("block", F.pmod("block", F.lit(blocks)))
    ends = pairs.select("block", F.col("a").alias("rep")).unionByName(pairs.select("block", F.col("b").alias("rep"))).distinct()
    sent = ends.withColumnRenamed("block", "to").join(rows, "rep")
    return saved(pairs.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(_verify, "a long, b long"), "near-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc, n_shingles and component_id of each document (doc: its id, or NO_ID for null), one row for each row."""
    return _grouped(docs).drop("own")


def _grouped(docs: DataFrame) -> DataFrame:
    """near_duplicates() with own, the text_key() of each row."""
    small_batches(docs.sparkSession)
    docs = docs.select(doc_key().alias("doc"), text_key().alias("own"), F.col("text").cast("string").alias("text"))
    signed = saved(docs.mapInArrow(_sign, "doc long, own string, n long, key binary, registers binary"), "sketches")
    # a class is a set: rep is its number, written once, and (doc, own) one row that has it
    classes = signed.filter("key is not null").groupBy("key").agg(F.min(F.struct("doc", "own")).alias("row"), F.min("n").alias("n"), F.max("registers").alias("registers"))
    classes = saved(classes.select(F.monotonically_increasing_id().alias("rep"), "key", "row.doc", "row.own", "n", "registers"), "classes")

    shared = shared_bands(classes)
    named = shared.select("rep").unionByName(shared.select(F.col("head").alias("rep"))).distinct()
    rows = classes.select("rep", "doc", "own", "n", "registers").join(named, "rep", "left_semi")
    rows = saved(docs.join(rows, ["doc", "own"]).select("rep", "n", "registers", "text").dropDuplicates(["rep"]), "near-texts")
    links = verified(first_partners(shared), rows)
    found = components(links)
    more = confirmed(open_members(shared, found, classes), rows)
    if more.limit(1).count():
        found = components(links.unionByName(more))

    found = classes.select("key", "rep", "doc").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    least = found.filter("component is not null").groupBy("component").agg(F.min("doc").alias("least"))
    named = found.join(least, "component", "left").select("key", F.coalesce("least", "doc").alias("component_id"))
    return signed.select("doc", "own", "n", "key").join(named, "key", "left").select("doc", "own", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of docs, without those whose group has one with a smaller doc_id."""
    kept = _grouped(docs).filter("doc = component_id").select(F.col("doc").alias("__doc"), F.col("own").alias("__own")).distinct()
    docs, back = own_names(docs)
    return docs.withColumns({"__doc": doc_key(), "__own": text_key()}).join(kept, ["__doc", "__own"], "left_semi").drop("__doc", "__own").withColumnsRenamed(back)


def op10_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    ids = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("doc", "doc_id"), ("component_id", "component_id"))]
    return found.select(ids[0], "n_shingles", ids[1], (F.col("doc") == F.col("component_id")).alias("kept"))


#: Whole-table SQL for the same rows.
OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS doc, doc_id AS met FROM documents UNION SELECT reach.doc, ties.b FROM reach JOIN ties ON ties.a = reach.met)
SELECT doc AS doc_id, coalesce(max(n), 0) AS n_shingles, min(met) AS component_id, doc = min(met) AS kept FROM reach LEFT JOIN sizes ON sizes.doc_id = doc GROUP BY doc
"""
