"""Incremental loading of monthly files and windowed counts over an event stream (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from synaxis.session import cut, exists
from synaxis.sources.acts import dedupe
from synaxis.sources.files import write_months


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 10) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by window and type; events later than ``late`` are dropped by the watermark.

    In append mode a window is written once, when the watermark has passed its end, and its state is
    dropped then, so the state holds the windows of ``late`` only.
    """
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )


def first_seen(events: DataFrame, key: str, late: str = "2 days") -> DataFrame:
    """Each key once, as of its first event within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def upsert_months(stream: DataFrame, path: str, checkpoint: str, order: str):
    """Rewrite exactly the months a batch brings rows for, keeping the last row per reference number.

    Only a path that does not exist yet counts as an empty table; any other failure to read it ends the
    batch before anything is written.
    """
    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        months = batch.select("_source_year", "_source_month").distinct()
        merged = batch
        if exists(spark, path):
            old = spark.read.parquet(path).join(F.broadcast(months), ["_source_year", "_source_month"], "left_semi")  # the batch's months
            merged = old.unionByName(batch, allowMissingColumns=True)
        write_months(cut(dedupe(merged, "referenceNumber", [order])), path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
