"""Media columns: content-addressed payloads in tar shards (operator 9).

A text's UTF-8 bytes, filled with zero bytes up to a positive multiple of 64, are the samples of an 8-bit grey image
64 pixels wide, kept losslessly as PNG. Each distinct payload is one member of one tar shard, named by the payload's
SHA-256; rows carry that digest and the shard, offset and length of the member's data. Metadata columns are filled by
reading a member's first 33 bytes; features read its whole range.

Odd input: a null or empty text is 64 zero bytes; equal texts share one member; null ids stay null, repeated rows stay;
a very long text is one member like any other, so a task holds it whole; other columns are not looked at; a table
without rows makes no shard. A shard of a lost task stays as an unused file: the written index only names finished
shards. Names and order of shards, and so shard and offset, differ from run to run; all else agrees.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, open_fs, read, saved, small_batches, tidy

WIDTH = 64
SHARD_BYTES = 256 << 20
#: Stored bytes that a task reads back, about.
READ_BYTES = 8 << 20
HEADER = 33
#: Digests of copies up to which every task reads their first 8 bytes (32 MB).
RESIDENT = 4_000_000
PNG = b"\x89PNG\r\n\x1a\n"


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


def payload_column(text: Column) -> Column:
    """The same bytes as an expression."""
    raw = F.coalesce(text.cast("string").cast("binary"), F.lit(b""))
    n = F.octet_length(raw)
    fill = F.when(n == 0, WIDTH).otherwise(F.pmod(-n, F.lit(WIDTH)))
    return F.concat(raw, F.unhex(F.repeat(F.lit("00"), fill)))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line starts with filter type 0
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_size(header: bytes) -> tuple[int, int]:
    """Width and height from a file's first HEADER bytes."""
    if header[:8] != PNG or header[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">II", header[16:24])


def from_png(data: bytes) -> bytes:
    width, height = png_size(data[:HEADER])
    at, body = 8, b""
    while at < len(data):
        size, kind = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        chunk = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + chunk) != struct.unpack(">I", data[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("a chunk's checksum is wrong")
        body += chunk if kind == b"IDAT" else b""
        at += 12 + size
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Size, mean and an 8 x 8 average hash of the image."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH).astype(np.int64)
    bands = np.array_split(np.arange(len(rows)), 8)
    cells = np.array([rows[b].reshape(len(b), 8, 8).sum((0, 2)) / max(1, len(b)) for b in bands])
    bits = int("".join("1" if x else "0" for x in (cells > cells.mean()).ravel()), 2)
    return f"{WIDTH}x{len(rows)}:{rows.mean():.4f}:{bits:016x}"


class _Shards:
    """Appends members to this task's tar shards, a new one after every SHARD_BYTES."""

    def __init__(self, uri: str):
        self.uri, self.out, self.at, self.name = uri, None, 0, ""

    def add(self, digest: bytes, media: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at > SHARD_BYTES:
            self.close()
            fs, path = open_fs(self.uri)
            fs.create_dir(path)
            self.name = f"{uuid.uuid4().hex}.tar"
            self.out, self.at = fs.open_output_stream(f"{path}/{self.name}"), 0
        info = tarfile.TarInfo(f"{digest.hex()}.png")
        info.size = len(media)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + media + bytes(-len(media) % 512))
        start = self.at + len(head)
        self.at = start + len(media) + -len(media) % 512
        return self.name, start, len(media)

    def close(self) -> None:
        if self.out:
            self.out.write(bytes(1024))
            self.out.close()


@functools.lru_cache(maxsize=1)
def _copied(path: str) -> np.ndarray:
    """First 8 bytes of all digests in a written table, sorted."""
    fs, at = open_fs(path)
    parts = [pq.read_table(fs.open_input_file(i.path), columns=["head"])["head"].to_numpy() for i in fs.get_file_info(pyarrow.fs.FileSelector(at)) if i.path.endswith(".parquet")]
    return np.sort(np.concatenate([np.zeros(0, np.int64), *parts]))


def _members(uri: str, copied: str | None):
    """Members whose payload occurs once go to a shard at once; those of copies (all, if `copied` is None) are sent on."""

    @tidy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()  # a task codes and sends a payload once
        shards = _Shards(uri)
        for batch in batches:
            rows = []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                payload = payload_of(text or b"")
                digest = hashlib.sha256(payload).digest()
                if copied is not None:
                    known, head = _copied(copied), struct.unpack(">q", digest[:8])[0]
                    i = int(np.searchsorted(known, head))
                    if i == len(known) or known[i] != head:
                        rows.append((digest, *shards.add(digest, to_png(payload)), None))
                        continue
                if digest not in sent:
                    sent.add(digest)
                    rows.append((digest, None, None, None, to_png(payload)))
            yield _batch(rows, SENT)
        shards.close()

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


INDEX = pa.schema([("digest", pa.binary()), ("shard", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


SENT = INDEX.append(pa.field("media", pa.binary()))


def _write_shards(uri: str):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, last = _Shards(uri), None
        for batch in batches:
            rows = []
            for digest, media in zip(batch["digest"].to_pylist(), batch["media"].to_pylist(), strict=True):
                if digest != last:  # sorted by digest: else the same payload from another task
                    rows.append((digest, *shards.add(digest, media)))
                    last = digest
            yield _batch(rows, INDEX)
        shards.close()

    return run


def store(docs: DataFrame, column: str = "text", resident: int = RESIDENT) -> tuple[str, DataFrame]:
    """Writes the distinct payloads of a column to tar shards; gives their folder and the index by digest.

    Digests that occur more than once are written to the shared folder first. Up to `resident` of them, every task
    reads their first 8 bytes, writes what occurs once where it is read and sends on the rest alone; beyond that, all
    members are dealt out by digest.
    """
    spark = docs.sparkSession
    small_batches(spark)
    uri, known = new_path(spark, "media"), new_path(spark, "copied")
    docs = docs.select(F.col(column).cast("string").alias("text"))
    digest = F.sha2(payload_column(F.col("text")), 256)
    copies = docs.select(F.unhex(digest).alias("digest")).groupBy("digest").count().filter("count > 1")
    # the first 8 bytes as a long: the top bit apart, as conv() is unsigned
    copies.select(F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("long").alias("head")).write.parquet(known)
    few = spark.read.schema("head long").parquet(known).count() <= resident
    members = docs.mapInArrow(_members(uri, known if few else None), "digest binary, shard string, offset long, length long, media binary")
    if few:
        members = saved(members, "members")
    rest = members.filter("media is not null").select("digest", "media").repartition("digest").sortWithinPartitions("digest")
    index = rest.mapInArrow(_write_shards(uri), "digest binary, shard string, offset long, length long")
    return uri, saved(members.filter("media is null").drop("media").unionByName(index) if few else index, "media-index")


@functools.lru_cache(maxsize=4)
def _open(uri: str, shard: str):
    fs, path = open_fs(uri)
    return fs.open_input_file(f"{path}/{shard}")


def dealt(index: DataFrame) -> DataFrame:
    """The index in parts of about READ_BYTES of stored bytes: by size alone its few bytes a row would make a few tasks."""
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // READ_BYTES))
    # neighbours in a shard stay together as far as a part goes
    return index.repartition(parts, "shard", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("shard", "offset")


def read_range(uri: str, shard: str, offset: int, length: int) -> bytes:
    return _open(uri, shard).read_at(length, offset)


def with_metadata(uri: str, index: DataFrame) -> DataFrame:
    """width and height of each member, by ranges of HEADER bytes only."""

    @tidy

    def run(batches):
        for batch in batches:
            sizes = [png_size(read_range(uri, s, o, HEADER)) for s, o in zip(batch["shard"].to_pylist(), batch["offset"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([w for w, _ in sizes], pa.int32()), pa.array([h for _, h in sizes], pa.int32())], names=[*batch.schema.names, "width", "height"])

    return index.mapInArrow(run, "digest binary, shard string, offset long, length long, width int, height int")


def with_features(uri: str, index: DataFrame) -> DataFrame:
    """What each member's whole range shows: sizes, digests of payload and stored form, checksum of the end, feature."""

    @tidy

    def run(batches):
        for batch in batches:
            rows = []
            for s, o, n in zip(*(batch[c].to_pylist() for c in ("shard", "offset", "length")), strict=True):
                media = read_range(uri, s, o, n)
                payload = from_png(media)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(payload)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            more = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *FEATURES])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema)
    return index.mapInArrow(run, f"{kept}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


FEATURES = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    uri, index = store(docs)
    found = with_features(uri, with_metadata(uri, dealt(index)))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.unhex(F.sha2(payload_column(F.col("text")), 256)).alias("digest"))
    return rows.join(found, "digest").select("doc_id", "n_bytes", *FEATURES, "width", "height", "shard", "offset", "length")
