"""Structured Streaming: incremental writing, windows with watermarks, deduplication within a time to live."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def table_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over the files of a Parquet table; the rate is limited by files a trigger."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.option("pathGlobFilter", "*.parquet").parquet(path)


def stamped(events: DataFrame, time: str) -> DataFrame:
    """Watermarks need timestamps with a zone; those without one are read in the session's."""
    return events.withColumn(time, F.col(time).cast("timestamp"))


def windowed(events: DataFrame, *, time: str = "ts", by: list[str], width: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts and sums over tumbling or sliding windows; rows later than the watermark don't count."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stamped(events, time).withWatermark(time, late).groupBy(w, *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, *, time: str = "ts", by: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    return stamped(events, time).withWatermark(time, late).groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n"))


def once_within(events: DataFrame, keys: list[str], *, time: str = "ts", ttl: str = "7 days") -> DataFrame:
    """The first row of a key within a time to live: a cache with expiry."""
    return stamped(events, time).withWatermark(time, ttl).dropDuplicatesWithinWatermark(keys)


def write(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything there is now, then stop; a rerun goes on where the checkpoint ends."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
