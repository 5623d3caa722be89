"""Structured Streaming forms of the batch operators; an extension, for sources that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.facts import normalize


def stream_facts(spark: SparkSession, folder: str, schema: str, delimiter: str = "\t", files_per_trigger: int = 4) -> DataFrame:
    """Canonical facts of delimited files as they arrive.

    ``schema`` must hold ``source_row_number``; physical order isn't known in a
    stream.  A row that comes again within the state is dropped.
    """
    raw = spark.readStream.schema(schema).option("header", "true").option("sep", delimiter).option("maxFilesPerTrigger", files_per_trigger).csv(folder)
    return normalize(raw, row_number=False)


def distinct_facts(facts: DataFrame, late: str = "7 days") -> DataFrame:
    """Each transaction once; the state is kept only as long as rows may be late."""
    return facts.withColumn("event_time", F.col("fecha_documento").cast("timestamp")).withWatermark("event_time", late).dropDuplicatesWithinWatermark(["transaction_id"])


def weekly_clusters(events: DataFrame, keys: list[str], time: str = "ts", late: str = "7 days") -> DataFrame:
    """Counts and spread per key and week, final once the watermark passes."""
    week = F.window(time, "7 days", startTime="4 days").alias("w")  # weeks from Monday: the epoch was a Thursday
    grouped = events.withWatermark(time, late).groupBy(*keys, week).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return grouped.select(*keys, F.col("w.start").alias("week"), "n", "mean", "sd")
