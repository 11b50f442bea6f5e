"""Removal of repeated 50-byte strings by blockwise suffix sorting over a cover sample (operator 1).

Every byte covered by a WINDOW-byte string that also starts in a document with a smaller doc_id goes.

A full suffix array would send each position with its prefix to a bucket, many times the input. As in difference-cover
construction only a sample of positions is sorted, and all other suffixes are compared through the sample position
that both reach after the same distance. The cover is taken from the content: in each window the GRAM-byte string with
the smallest hash is sampled, so equal windows have their sample at the same offset, and one position in about 14 is
in it. Buckets are ranges of the sampled strings' hashes; a task sorts one bucket at a time:

1. Sampled hashes of all documents meet in their buckets; those of one document only cannot be in a shared window.
2. For the rest, the bytes around the sample position (what a window through it can reach) go to the bucket. There the
   suffixes that start at the sample positions are sorted, and the reversed prefixes that end there; their longest
   common prefixes name every prefix of every length. A window is a pair of names (bytes before, bytes from the sample
   position on), so ties of any length are resolved by those ranks; the smallest doc_id of each pair is the owner.
3. Each sample position gets a mask that tells for which windows through it another document with a smaller id has
   the same bytes, and documents drop what these windows cover.

A bucket of a string that stands before and behind much else would hold a context for each place. Packs tell how many
positions they have in a bucket, and where that comes to more than HOT the contexts are dealt out to parts, twice: by the
bytes that all windows with few bytes before the sample position share, and by those of all other windows. Equal windows
meet in one part, so nothing is lost.

Documents are packed once, compressed, into the shared folder, and only such packs are sent where they meet the
answers. Copies of a context in one pack are sent once, so a passage of any number of documents is at most one row for
each pack. Memory is bounded by a pack, by HOT contexts or a part of a bucket, and by one row of a bucket for each pack.

Odd input: a null or empty text has 0 bytes; a null doc_id counts as the largest; rows that share a doc_id are one
document, so they remove nothing from each other; other columns are not looked at; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, doc_key, read, saved, small_batches, texts, tidy
from .words import mix

WINDOW, GRAM = 50, 24
#: Places of a GRAM-byte string in a window, and the bytes around a sample position that windows can reach.
PLACES, BEFORE = WINDOW - GRAM + 1, WINDOW - GRAM
CONTEXT = BEFORE + WINDOW
PACK_BYTES = 512 << 10
#: Sampled hashes that a bucket holds on average.
BUCKET = 500_000
#: Positions in a bucket beyond which its contexts are dealt out to parts of about BUCKET.
HOT = 4 * BUCKET
#: Windows that start at most this far before the sample position are looked at in parts by what follows it.
TURN = PLACES // 2
PRINT = 5  # bytes of a hash that are sent; the bucket adds to them

PACK = pa.schema([("pack", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("bytes", pa.int64()), ("data", pa.binary())])


def _pack(limit: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k, docs, parts, size = TaskContext.get().partitionId() << 32, 0, [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(([base + k], [docs], [[len(p) for p in parts]], [size], [zlib.compress(b"".join(parts), 6)]), PACK, strict=True)], schema=PACK)

        for batch in batches:
            for doc, text in zip(batch["doc"].to_pylist(), texts(batch["text"]), strict=True):
                if docs and size + len(text) > limit:
                    yield packed()
                    k, docs, parts, size = k + 1, [], [], 0
                docs.append(doc)
                parts.append(text)
                size += len(text)
        if docs:
            yield packed()

    return run


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of x[i : i + width] for each i."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


BYTE = mix(np.arange(1, 257, dtype=np.uint64))
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash (at least 1) of data[i : i + GRAM] for each i."""
    whole, width, at, left = None, 1, 0, GRAM
    h, power = BYTE[data], FACTOR
    while True:
        if left & 1:
            part = h[at : at + len(data) - GRAM + 1]
            whole = part if whole is None else whole * power + part
            at += width
        left >>= 1
        if not left:
            return mix(whole) | np.uint64(1)
        h = h[:-width] * power + h[width:]
        width, power = 2 * width, np.uint64(int(power) ** 2 & (2**64 - 1))


class Sample:
    """Sample positions of a pack's documents."""

    def __init__(self, row: dict):
        self.docs, self.sizes = np.array(row["docs"], np.int64), np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(zlib.decompress(row["data"]), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.at = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if len(self.data) >= WINDOW:
            h = _gram_hashes(self.data)
            low = _sliding(h, PLACES, np.minimum)  # of each window
            for end in self.ends:  # windows that reach into the next document don't count
                low[max(0, end - WINDOW + 1) : end] = 0
            pad = np.zeros(PLACES - 1, np.uint64)
            high = _sliding(np.concatenate([pad, low, pad]), PLACES, np.maximum)
            self.at = np.flatnonzero(high == h)
            self.hash = h[self.at]
        self.doc = np.searchsorted(self.ends, self.at, "right")

    def buckets(self, n: int) -> np.ndarray:
        return ((self.hash >> np.uint64(40)) % np.uint64(n)).astype(np.int64)

    def prints(self) -> np.ndarray:
        return self.hash & np.uint64(2 ** (8 * PRINT) - 1)

    def groups(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (bucket, print) by bucket and print, the group of each position, and whether ids differ in a group."""
        key = (self.buckets(n).astype(np.uint64) << np.uint64(40)) | self.prints()
        names, group = np.unique(key, return_inverse=True)
        ids = self.docs[self.doc]
        low, high = np.full(len(names), NO_ID), np.full(len(names), -(2**63))
        np.minimum.at(low, group, ids)
        np.maximum.at(high, group, ids)
        return names, group, low < high

    def contexts(self, repeated: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """For positions that are repeated: bucket, context bytes, reach before and behind, and doc; one for each distinct
        context (its smallest doc), with the context of each position."""
        at, doc = self.at[repeated], self.doc[repeated]
        start = np.concatenate([[0], self.ends[:-1]])[doc]
        before, behind = np.minimum(at - start, BEFORE), np.minimum(self.ends[doc] - at, WINDOW)
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(WINDOW, np.uint8)])
        rows = padded[at[:, None] + np.arange(CONTEXT)]
        column = np.arange(CONTEXT)
        rows[(column < BEFORE - before[:, None]) | (column >= BEFORE + behind[:, None])] = 0
        bucket, ids = self.buckets(n)[repeated], self.docs[doc]
        full = np.concatenate([rows, before[:, None].astype(np.uint8), behind[:, None].astype(np.uint8)], 1)
        order = np.lexsort((ids, *(mix_rows(full)), bucket))
        same = (full[order][1:] == full[order][:-1]).all(1) & (bucket[order][1:] == bucket[order][:-1]) if len(order) else np.zeros(0, bool)
        first = np.concatenate([[True], ~same])[: len(order)]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        top = order[first]
        return bucket[top], rows[top], before[top], behind[top], ids[top], group


def parts_of(rows: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For contexts of a bucket in so many parts: the odd part of each for windows that start up to TURN bytes before the
    sample position, and the even one for those that start further before it."""
    behind, before = rows[:, BEFORE : BEFORE + WINDOW - TURN], rows[:, BEFORE - TURN - 1 : BEFORE + GRAM]
    odd, even = ((mix_rows(np.ascontiguousarray(x))[0] % np.uint64(parts)).astype(np.int64) for x in (behind, before))
    return 2 * odd + 1, 2 * even + 2


def mix_rows(rows: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each row, to sort equal rows together."""
    out = []
    for k in (1, 2):
        h = np.full(len(rows), k, np.uint64)
        padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
        padded[:, : rows.shape[1]] = rows
        for column in padded.view(np.uint64).T:
            h = mix(h * FACTOR + column)
        out.append(h)
    return out


SENT = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
ASKED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("pack", pa.int64()), ("data", pa.binary())])


def _send_prints(n: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            sample = Sample(row)
            names, group, many = sample.groups(n)
            bucket = (names >> np.uint64(40)).astype(np.int64)
            ids, starts = np.unique(bucket, return_index=True)
            places = np.add.reduceat(np.bincount(group, minlength=len(names)), starts) if len(ids) else []
            data = []
            for part, flag in zip(np.split(names, starts[1:]), np.split(many, starts[1:]), strict=True):
                data.append(part.view(np.uint8).reshape(-1, 8)[:, :PRINT].tobytes() + np.packbits(flag).tobytes())
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([row["pack"]] * len(ids), pa.int64()), pa.array(places, pa.int64()), pa.array(data, pa.binary())], schema=SENT)

    return run


def _answer(group: pa.Table, part: pa.Array, data: list[bytes]) -> pa.Table:
    return pa.Table.from_arrays([group["pack"].combine_chunks(), group["bucket"].combine_chunks(), part, pa.array(data, pa.binary())], names=["pack", "bucket", "part", "data"])


def _repeated(bucket: int, hot: int):
    @tidy
    def run(group: pa.Table) -> pa.Table:
        """One bucket: which of each pack's prints occur in another document; part is the number of its parts."""
        prints, many, sizes = [], [], []
        places = sum(group["n"].to_pylist())
        parts = -(-places // bucket) if places > hot else 1
        for data in group["data"].to_pylist():
            n = len(data) * 8 // (8 * PRINT + 1)
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :PRINT] = np.frombuffer(data, np.uint8, n * PRINT).reshape(n, PRINT)
            prints.append(wide.view(np.uint64)[:, 0])
            many.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=n * PRINT))[:n].astype(bool))
            sizes.append(n)
        _, own, count = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        flags = (count[own] > 1) | np.concatenate(many)
        return _answer(group, pa.array([parts] * len(sizes), pa.int64()), [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum(sizes)[:-1])])

    return run


def _flagged(row: dict, sample: Sample, n: int) -> np.ndarray:
    """Which positions of a pack have a print that occurs in another document."""
    names, group, _ = sample.groups(n)
    bucket = (names >> np.uint64(40)).astype(np.int64)
    flags = np.zeros(len(names), bool)
    for a in row["flags"] or ():
        own = slice(*np.searchsorted(bucket, [a["bucket"], a["bucket"] + 1]))
        flags[own] = np.unpackbits(np.frombuffer(a["data"], np.uint8))[: own.stop - own.start]
    return flags[group] if len(group) else np.zeros(0, bool)


def _in_parts(row: dict, bucket: np.ndarray, rows: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """Which of a pack's contexts (sorted by bucket) go to each bucket and part; part 0 is a bucket that is whole."""
    out, parts = {}, {a["bucket"]: a["part"] for a in row["flags"] or ()}
    names, starts = np.unique(bucket, return_index=True)
    for name, own in zip(names.tolist(), np.split(np.arange(len(bucket)), starts[1:]), strict=True) if len(names) else ():
        if parts[name] == 1:
            out[name, 0] = own
        else:
            for side in parts_of(rows[own], parts[name]):
                out.update(((name, p), own[side == p]) for p in np.unique(side).tolist())
    return out


def _send_contexts(n: int):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            sample = Sample(row)
            bucket, rows, before, behind, ids, _ = sample.contexts(_flagged(row, sample, n), n)
            if len(bucket):
                full = np.concatenate([rows, before[:, None].astype(np.uint8), behind[:, None].astype(np.uint8), ids.view(np.uint8).reshape(-1, 8)], 1)
                dealt = _in_parts(row, bucket, rows)
                data = [zlib.compress(full[own].tobytes(), 1) for own in dealt.values()]
                names, parts = zip(*dealt, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(parts, pa.int64()), pa.array([row["pack"]] * len(names), pa.int64()), pa.array(data, pa.binary())], schema=ASKED)

    return run


def sorted_names(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows, and the bytes that each has in common with the one before it in that order."""
    width = rows.shape[1]
    padded = np.zeros((len(rows), -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    order = np.lexsort(tuple(padded.view(">u8").T[::-1]))
    a = rows[order]
    differs = a[1:] != a[:-1]
    common = np.where(differs.any(1), differs.argmax(1), width) if len(a) > 1 else np.zeros(0, np.int64)
    return order, np.concatenate([[0], common])


def owners_of_windows(rows: np.ndarray, before: np.ndarray, behind: np.ndarray, ids: np.ndarray, places: range = range(PLACES)) -> np.ndarray:
    """For each context a mask: bit s (of places) is set if the window that starts s bytes before the sample position lies
    in its document and stands in another context with a smaller id."""
    masks = np.zeros(len(rows), np.uint64)
    right_order, right_common = sorted_names(rows[:, BEFORE:])
    left_order, left_common = sorted_names(rows[:, :BEFORE][:, ::-1])
    left, right = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for s in places:
        left[left_order] = np.cumsum(left_common < s) if s else 0
        right[right_order] = np.cumsum(right_common < WINDOW - s)
        own = np.flatnonzero((before >= s) & (behind >= WINDOW - s))
        if len(own) < 2:
            continue
        key = left[own] * (len(rows) + 1) + right[own]
        order = np.lexsort((ids[own], key))
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        least = ids[own][order][new][np.cumsum(new) - 1]
        masks[own[order]] |= (least < ids[own][order]).astype(np.uint64) << np.uint64(s)
    return masks


@tidy
def _compared(group: pa.Table) -> pa.Table:
    """One bucket or a part of it: the mask of each pack's contexts."""
    part = group["part"][0].as_py()
    places = range(PLACES) if not part else range(TURN + 1) if part % 2 else range(TURN + 1, PLACES)
    parts = [np.frombuffer(zlib.decompress(d), np.uint8).reshape(-1, CONTEXT + 10) for d in group["data"].to_pylist()]
    full = np.concatenate(parts)
    masks = owners_of_windows(full[:, :CONTEXT], full[:, CONTEXT].astype(np.int64), full[:, CONTEXT + 1].astype(np.int64), full[:, CONTEXT + 2 :].copy().view(np.int64)[:, 0], places)
    return _answer(group, group["part"].combine_chunks(), [zlib.compress(m.tobytes(), 1) for m in np.split(masks, np.cumsum([len(p) for p in parts])[:-1])])


CUT = pa.schema([("doc", pa.int64()), ("text", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])


def _cut(n: int, whole: bool):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            sample = Sample(row)
            flagged = _flagged(row, sample, n)
            bucket, rows, _, _, ids, group = sample.contexts(flagged, n)
            masks = np.zeros(len(bucket), np.uint64)
            dealt = _in_parts(row, bucket, rows)
            for a in row["masks"] or ():
                masks[dealt[a["bucket"], a["part"]]] |= np.frombuffer(zlib.decompress(a["data"]), np.uint64)
            at, doc = sample.at[flagged], sample.doc[flagged]
            mine = masks[group]
            # a copy in this pack of a context whose smallest id is another one's: all its windows are repeated
            copy = sample.docs[doc] > ids[group]
            room = np.minimum(at - np.concatenate([[0], sample.ends[:-1]])[doc], BEFORE), np.minimum(sample.ends[doc] - at, WINDOW)
            window = np.zeros(len(sample.data) + 1, np.int32)
            for s in range(PLACES):
                hit = np.where(copy, (room[0] >= s) & (room[1] >= WINDOW - s), (mine >> np.uint64(s)) & np.uint64(1) > 0)
                window[at[hit] - s] = 1
            starts = np.flatnonzero(window)
            edge = np.zeros(len(sample.data) + 1, np.int32)
            edge[starts] += 1
            edge[starts + WINDOW] -= 1  # starts are distinct
            gone = np.cumsum(edge)[:-1] > 0
            out = []
            begin = 0
            for d, end in zip(sample.docs.tolist(), sample.ends.tolist(), strict=True):
                own = gone[begin:end]
                kept = sample.data[begin:end][~own].tobytes()
                spans = int((np.diff(own.astype(np.int8), prepend=0) == 1).sum())
                out.append((d, kept if whole else hashlib.sha256(kept).hexdigest().encode(), end - begin, int(own.sum()), spans))
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), CUT, strict=True)], schema=CUT)

    return run


def remove_repeats(docs: DataFrame, whole: bool = True) -> DataFrame:
    """doc, n_bytes, n_removed and n_spans of each row of docs, and text: its remaining bytes (or their SHA-256 in hex)."""
    small_batches(docs.sparkSession, 16)
    rows = docs.select(doc_key().alias("doc"), F.col("text").cast("string").alias("text"))
    packs = saved(rows.mapInArrow(_pack(PACK_BYTES), "pack long, docs array<long>, sizes array<long>, bytes long, data binary"), "packs", "uncompressed")
    total = packs.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, -(-total * 2 // (PLACES + 1) // BUCKET))
    sent = "bucket long, pack long, n long, data binary"
    answer = "pack long, bucket long, part long, data binary"
    told = lambda name, df: df.groupBy("pack").agg(F.collect_list(F.struct("bucket", "part", "data")).alias(name))
    flags = saved(told("flags", packs.mapInArrow(_send_prints(n), sent).groupBy("bucket").applyInArrow(_repeated(BUCKET, HOT), answer)), "flags")
    asked = packs.join(flags, "pack", "left").mapInArrow(_send_contexts(n), "bucket long, part long, pack long, data binary")
    masks = saved(told("masks", asked.groupBy("bucket", "part").applyInArrow(_compared, answer)), "masks")
    return packs.join(flags, "pack", "left").join(masks, "pack", "left").mapInArrow(_cut(n, whole), "doc long, text binary, n_bytes long, n_removed long, n_spans long")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"), whole=False)
    return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("text").cast("string").alias("kept_sha256"))


#: Whole-table SQL for the same rows.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
places AS (SELECT doc_id, unnest(range(0, n)) AS i FROM d),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM places JOIN d USING (doc_id) WHERE i <= n - 50),
owner AS (SELECT s, min(doc_id) AS own FROM windows GROUP BY s HAVING count(*) > 1),
later AS (SELECT doc_id, i FROM windows JOIN owner USING (s) WHERE own < doc_id),
marked AS (SELECT doc_id, i, coalesce(max(CASE WHEN later.i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone FROM places LEFT JOIN later USING (doc_id, i)),
runs AS (SELECT doc_id, i, gone, gone - coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 1 AS begins FROM marked)
SELECT doc_id, any_value(n) AS n_bytes, count(*) FILTER (gone = 1) AS n_removed, count(*) FILTER (begins) AS n_spans,
  sha256(from_hex(coalesce(string_agg(substr(h, 2 * i + 1, 2), '' ORDER BY i) FILTER (gone = 0), ''))) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id
"""
