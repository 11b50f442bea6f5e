"""What the operators of this subpackage share: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import inspect
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows whose doc_id is null are worked on under this id, so they come after all others.
NO_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that the driver and all executors see: spark.checkpoint.dir. A session without one gets a folder
    of this machine if all its tasks run here (as in tests), else an error."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if sc._jsc.sc().getCheckpointDir().isEmpty() and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='brambler-')}")
        found = sc._jsc.sc().getCheckpointDir().get()
    return found if "://" in found or found.startswith("file:") else f"file://{found}"


#: Paths that scratch() removes; one list for each that is open.
_open_scratch: list[list[str]] = []


def new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _open_scratch and not keep:
        _open_scratch[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what is written to the shared folder inside, but for tables that are to be kept. What rests on these
    tables must be written by then."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def saved(df: DataFrame, name: str, codec: str = "snappy", keep: bool = False) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, and every reader sees the same rows. Tables stay
    there, as results may rest on them, unless a scratch() is open and they aren't to be kept."""
    path = new_path(df.sparkSession, name, keep)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """For tasks: the file system of a URI in the shared folder, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri.replace("file:/", "file:///") if uri.startswith("file:/") and not uri.startswith("file:///") else uri)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bounds the Arrow batches that tasks get; long rows are further bounded by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)


def doc_key(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def held_out(name: str = "doc_id") -> Column:
    """Whether a row is kept from all training: crc32 of its id as text leaves 0 by 5 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def own_names(docs: DataFrame, *more: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with other names for the columns that an operator's own could meet (those that start with two underscores, and
    more, in any case), and the way back for withColumnsRenamed()."""
    taken, away = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.startswith("__") or c.lower() in more:
            n = next(n for k in range(len(docs.columns) + 1) if (n := f"own{k}_{c.strip('_')}").lower() not in taken)
            taken.add(n.lower())
            away[c] = n
    return docs.withColumnsRenamed(away), {v: k for k, v in away.items()}


def table(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) if not isinstance(c, pa.Array) else c.cast(t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null counts as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def counted(docs: DataFrame) -> DataFrame:
    """docs with n_chars, where it has that column, as the length of its text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def release() -> None:
    """Gives memory that a task has freed back to the machine; Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Seconds between releases after groups; groups may be many and small.
RELEASE_S = 3.0
_released = [0.0]


def tidy(task):
    """For functions of mapInArrow and applyInArrow (of one table or two): release() after each task, or after a group if
    some time has passed."""

    @functools.wraps(task)
    def over_batches(batches):
        try:
            yield from task(batches)
        finally:
            release()

    def now_and_then() -> None:
        if time.monotonic() - _released[0] > RELEASE_S:
            release()
            _released[0] = time.monotonic()

    @functools.wraps(task)
    def over_group(group):
        try:
            return task(group)
        finally:
            now_and_then()

    @functools.wraps(task)
    def over_groups(left, right):
        try:
            return task(left, right)
        finally:
            now_and_then()

    if inspect.isgeneratorfunction(task):
        return over_batches
    return over_group if len(inspect.signature(task).parameters) == 1 else over_groups
