"""Messages of mail folders. Spark's own readers list and read the files, so any store that Spark can open will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What stands between the messages of one file in mbox folders: a line that starts with "From ", behind an empty one.
MBOX = "\n\nFrom "
#: The newest files' names come to the driver, so their number is bounded.
MOST_NEWEST = 100_000


def message_files(spark: SparkSession, path: str | list[str], newest: int | None = None) -> DataFrame:
    """msg_id (the file's path), raw and read_at of folders with a message in each file; of the newest n files if asked.

    Files are listed without being read, and only the newest are loaded. Files at one time go by their path. Bytes that are
    no UTF-8 are replaced; blank files are no messages.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if newest is not None:
        if not 0 <= newest <= MOST_NEWEST:
            raise ValueError(f"the newest 0 to {MOST_NEWEST} files")
        names = [r.path for r in files.select("path", "modificationTime").orderBy(F.desc("modificationTime"), "path").limit(newest).collect()]
        files = spark.read.format("binaryFile").load(names) if names else files.limit(0)
    rows = files.select(F.col("path").alias("msg_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("raw"), F.col("modificationTime").alias("read_at"))
    return rows.filter(F.trim(F.regexp_replace("raw", r"\s+", " ")) != "")


def messages_in(spark: SparkSession, path: str | list[str], separator: str = MBOX) -> DataFrame:
    """msg_id and raw of files that hold several messages with a separator between them. Large files are read in parts.

    msg_id is the file's path and a hash of the message, so equal messages of a file share it. Blank messages are none. The
    separator is no part of a message; the line that starts an mbox message goes with it.
    """
    rows = spark.read.option("lineSep", separator).option("recursiveFileLookup", True).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    if separator == MBOX:
        rows = rows.withColumn("raw", F.regexp_replace("raw", r"^(From )?[^\n]*\n", ""))
    rows = rows.filter(F.trim(F.regexp_replace("raw", r"\s+", " ")) != "")
    return rows.select(F.concat("path", F.lit("#"), F.hex(F.xxhash64("raw"))).alias("msg_id"), "raw")
