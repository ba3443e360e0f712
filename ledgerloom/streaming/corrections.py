"""Corrections as a stream of files: joined with extractions and appended; and backfills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.corrections import replay
from ledgerloom.sources.io import rebuild


def read_stream(spark: SparkSession, folder: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def backfill(corrections: DataFrame, extractions: DataFrame, folder: str, now: float | None = None) -> str:
    """A new version of the joined corrections, replayed in the order they were submitted; older versions stay. Gives its path."""
    return rebuild(replay(corrections, extractions), folder, now)


def append_stream(stream: DataFrame, extractions: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends corrections with their extraction. No watermark: a late correction still counts.

    once: takes what is there and ends; otherwise it looks every minute. The checkpoint replays after a failure.
    """
    joined = stream.join(extractions, "extraction_id")
    writer = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()
