"""Raw frames as tables and streams: `source, raw, received_ns`, stamped at receipt."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FRAME


def read_frames(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(FRAME).format(file_format).load(path)


def stream_frames(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the frames in a landing directory, as files arrive."""
    reader = spark.readStream.schema(FRAME).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def frames_from_kafka(records: DataFrame) -> DataFrame:
    """Frames from Kafka records: the topic names the feed, the broker stamped the receipt."""
    return records.select(
        F.col("topic").alias("source"),
        F.col("value").alias("raw"),
        (F.unix_micros("timestamp") * F.lit(1_000)).alias("received_ns"),
    )


def merge_feeds(*feeds: DataFrame) -> DataFrame:
    """One table or stream from several feeds, of frames or of ticks."""
    if not feeds:
        raise ValueError("At least one feed must be provided")
    return reduce(DataFrame.unionByName, feeds)
