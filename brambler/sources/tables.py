"""Tables that are kept and changed a bit at a time: rows lie in buckets of their key, and a change rewrites its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import upsert

#: The column by which files are partitioned; a table's rows don't have it.
BUCKET = "__bucket"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors see (spark.checkpoint.dir); a session of this machine
    alone may have none, and gets one."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='brambler-')}")
    found = found or sc._jsc.sc().getCheckpointDir().get()
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """rows written to the shared folder and read again: what they rest on is worked out once, and their size is known."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int, mode: str) -> None:
    dealt = rows.withColumn(BUCKET, _bucket(keys, buckets)).repartition(BUCKET)  # a file for each bucket
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def create(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Stores rows by their key. Keys with nulls, which never meet another, lie in buckets as well."""
    _write(rows, path, keys, buckets, "errorifexists")


def load(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """A stored table, or some of its buckets: others are not read."""
    rows = spark.read.parquet(path)
    return (rows if only is None else rows.filter(F.col(BUCKET).isin(only))).drop(BUCKET)


def apply(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], buckets: int, order: list[Column], change) -> int:
    """Upserts changes into a stored table; gives the number of buckets that were rewritten. Files of all others stay.

    change(column, old, new) is that of upsert(). New buckets are written beside the table first, so what is read is never
    what is being replaced; a job that is done again gives the same rows, but for keys with nulls, which are added again.
    """
    touched = sorted(r[0] for r in changes.select(_bucket(keys, buckets)).distinct().collect())  # numbers of buckets
    if not touched:
        return 0
    found = upsert(load(spark, path, touched), changes, keys, order, change).drop("inserted")
    beside = shared_path(spark, "changed-buckets")
    _write(found, beside, keys, buckets, "errorifexists")
    spark.read.parquet(beside).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(beside)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return len(touched)
