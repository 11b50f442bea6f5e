"""Text files in, CSV out; every reader refuses what it can't vouch for."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def address_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct addresses of a text file's lines that hold an @; a file without any is an error."""
    rows = spark.read.text(path).filter(F.contains("value", F.lit("@"))).select(F.lower(F.trim("value")).alias("email")).distinct()
    if rows.isEmpty():
        raise ValueError(f"no address in {path}")
    return rows


def batch_file(spark: SparkSession, path: str) -> DataFrame:
    """(id, email) of a tab-separated batch; any bad or repeated row is an error, so is an empty file."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(F.trim("value") != "").select(F.expr("try_cast(trim(get(split(value, '\t'), 0)) as long)").alias("id"), F.lower(F.trim(F.get(parts, F.lit(1)))).alias("email"))
    ok = F.col("id").isNotNull() & F.coalesce(F.col("email").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.lit(False))
    n, bad, ids, emails = rows.agg(F.count("*"), F.count_if(~ok), F.countDistinct("id"), F.countDistinct("email")).first()
    if not n or bad or ids != n or emails != n:
        raise ValueError(f"{path}: {n} rows, {bad} malformed, {ids} ids, {emails} addresses")
    return rows


def preflight(spark: SparkSession, path: str, archive: DataFrame, marker: str, accounts: DataFrame | None = None) -> tuple[int, DataFrame | None]:
    """(0, matches) if nobody in a batch was written to, (1, matches) if somebody was, (2, None) on any error."""
    from ..operators.read import preflight_matches

    try:
        matches = preflight_matches(batch_file(spark, path), archive, marker, accounts)
        return (0 if matches.isEmpty() else 1), matches
    except Exception:  # noqa: BLE001  whatever it is, nothing may be sent
        log.exception("preflight of %s failed", path)
        return 2, None


def export_csv(rows: DataFrame, path: str) -> None:
    """Contacts with their organisation as CSV files with headers, in the order of an export from file to file."""
    from ..operators.read import export_order

    rows.orderBy(*export_order()).write.mode("overwrite").option("header", True).csv(path)
