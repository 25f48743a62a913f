"""The event-time form of the bucketed panels: a stream of events into fixed-width buckets, with a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def bucketed(stream: DataFrame, aggregates: Sequence[Column], time: str = "time", width: str = "2 hours", late: str = "1 hour", keys: Sequence[str] = ("asset",)) -> DataFrame:
    """Aggregates per bucket and key of a stream; state of buckets older than the watermark is dropped."""
    out = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("_w"), *keys).agg(*aggregates)
    return out.select(F.col("_w.start").alias("time_bucket"), *(c for c in out.columns if c != "_w"))


def event_stream(spark: SparkSession, folder: str, glob: str, files_per_batch: int = 1) -> DataFrame:
    """Events files of a folder as a stream of role rows (time, asset, amount, user, kind)."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    raw = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return raw.select(F.col("ts").cast("timestamp").alias("time"), (F.regexp_extract("props", "([0-9]+)", 1).cast("long") % 10).alias("asset"), F.round(F.col("value") * 100).cast("long").alias("amount"), F.col("user_id").alias("user"), F.col("event_type").alias("kind"))


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write finished buckets as Parquet, once each."""
    return stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
