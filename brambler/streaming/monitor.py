"""The send monitor over a stream of events: an extension, its batch form is read.sends_by_day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import local_day
from ..operators.read import EVENTS


def sends_by_day_stream(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Counts by local date of a stream of send events. Grouped on the date, which no change of clocks can break; the
    watermark bounds what repeated ids are remembered."""
    rows = events.withColumn("occurred_at", F.col("occurred_at").cast("timestamp")).withWatermark("occurred_at", late).dropDuplicatesWithinWatermark(["id"])
    return rows.withColumn("day", local_day(F.col("occurred_at"))).groupBy("day").agg(*[F.count_if(F.col("event") == e).alias(e) for e in EVENTS])
