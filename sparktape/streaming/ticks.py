"""Streams from raw frames to the tick tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import tick_line
from ..operators.decode import decode_frames, frame_ticks
from ..schema import PARTITION_COLS, WRITE_LOG
from ..sources import published
from ..sources.lake import check_fence, check_stream_target
from ..sources.published import with_date

# Ticks per file and seconds between flushes, unless the caller says otherwise.
FLUSH_TICKS = 10_000
FLUSH_INTERVAL = "30 seconds"
CHECKPOINT_SUFFIX = "-checkpoint"


def tick_stream(frames: DataFrame, on_error: str = "prefix") -> DataFrame:
    """Ticks of a stream of frames; the same stateless decoding as for tables."""
    return frame_ticks(decode_frames(frames, on_error=on_error))


def write_tick_stream(
    ticks: DataFrame,
    root: str,
    checkpoint: str | None = None,
    *,
    available_now: bool = False,
    flush_interval: str = FLUSH_INTERVAL,
    max_records_per_file: int = FLUSH_TICKS,
) -> StreamingQuery:
    """Write a stream of ticks to a tree of its own, each tick exactly once.

    A micro-batch becomes visible as a whole when it commits. A query that is restarted with
    its checkpoint goes on where it stopped; `available_now` drains what is there and ends.
    The checkpoint belongs to the tree: unless named, it is a fixed folder beside it. A tree
    of batch files, or one that is ahead of the checkpoint, is refused.
    """
    spark = ticks.sparkSession
    checkpoint = checkpoint or f"{str(root).rstrip('/')}{CHECKPOINT_SUFFIX}"
    check_stream_target(spark, str(root), checkpoint)
    rows = with_date(ticks).observe("written", F.count(F.lit(1)).alias("n_ticks"))
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*PARTITION_COLS)
        .option("path", str(root))
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": flush_interval}
    return writer.trigger(**trigger).start()


def publish_tick_stream(
    frames: DataFrame,
    root: str,
    checkpoint: str | None = None,
    *,
    name: str = "ticks",
    on_error: str = "prefix",
    available_now: bool = False,
    flush_interval: str = FLUSH_INTERVAL,
    max_records_per_file: int = 0,
) -> StreamingQuery:
    """Decode a stream of frames into a published tree, with a write log beside the ticks.

    Each micro-batch is one commit: its files, its rows in the write log (one per feed) and
    its row in the batch log become visible together. A batch that runs again, after a
    restart or a lost executor, finds its number in the tree and changes nothing. The log
    lives as long as the tree, over all runs. Several streams may write to a tree under
    different names, and batch jobs and compaction beside them.
    """
    spark = frames.sparkSession
    root = str(root).rstrip("/")
    checkpoint = checkpoint or f"{root}{CHECKPOINT_SUFFIX}"
    published.create_published(spark, root)
    check_fence(spark, root, checkpoint, name)

    def publish(batch: DataFrame, batch_id: int) -> None:
        now = published.latest(batch.sparkSession, root)
        if now.fences.get(name, -1) >= batch_id:
            return
        seen = Observation()
        decoded = decode_frames(batch, on_error=on_error).observe(
            seen,
            F.count(F.lit(1)).alias("n_frames"),
            F.count_if(F.col("status") == "error").alias("n_errors"),
        )
        published.publish_ticks(
            frame_ticks(decoded),
            root,
            commit=f"{name}-{batch_id:012d}",
            fence=(name, batch_id),
            frames=seen,
            max_records_per_file=max_records_per_file,
        )

    trigger = {"availableNow": True} if available_now else {"processingTime": flush_interval}
    writer = frames.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def print_tick_stream(ticks: DataFrame, *, available_now: bool = False) -> StreamingQuery:
    """Show a stream of ticks on the console, one line each."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    lines = ticks.select(tick_line().alias("tick"))
    return lines.writeStream.format("console").option("truncate", False).trigger(**trigger).start()


def drain(query: StreamingQuery) -> None:
    """Take in all that has arrived, then stop."""
    query.processAllAvailable()
    query.stop()


def _refuse_long_run(spark: SparkSession, query: StreamingQuery) -> None:
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(query.recentProgress) >= kept:
        raise ValueError(f"only the last {kept} batches are known; raise numRecentProgressUpdates")


def progress_log(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Write log of a query's micro-batches, without feeds.

    Spark keeps a bounded number of them; a longer run is refused rather than cut. A
    published tree keeps a log of all batches and feeds (`published.write_log`).
    """
    _refuse_long_run(spark, query)
    batches = [
        (
            int(p.batchId),
            None,
            None,
            int(p.observedMetrics["written"]["n_ticks"]),
            p.durationMs.get("addBatch", 0) / 1000.0,
            p.timestamp,
        )
        for p in query.recentProgress
        if "written" in p.observedMetrics
    ]
    raw = spark.createDataFrame(
        batches,
        "batch_id long, exchange string, symbol string, n_ticks long, latency_s double, at string",
    )
    at_ns = F.unix_micros(F.to_timestamp("at")) * F.lit(1_000)
    return raw.withColumn("at_ns", at_ns).select(*WRITE_LOG.fieldNames())


def published_summary(spark: SparkSession, root: str) -> DataFrame:
    """One row on all that was ever streamed into a published tree, over any number of runs:
    batches, frames in, frames that failed, ticks and files written, frames per second of
    writing."""
    return published.batch_log(spark, root).where("stream IS NOT NULL").agg(
        F.count("*").alias("n_batches"),
        F.coalesce(F.sum("n_frames"), F.lit(0)).alias("n_frames"),
        F.coalesce(F.sum("n_errors"), F.lit(0)).alias("n_errors"),
        F.coalesce(F.sum("n_ticks"), F.lit(0)).alias("n_ticks"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("files_written"),
        F.round(F.sum("n_frames") / F.nullif(F.sum("latency_s"), F.lit(0.0)), 1).alias("msgs_per_sec"),
    )


def run_summary(query: StreamingQuery, inventory: DataFrame) -> DataFrame:
    """One row on a tree's only run: frames in, ticks and files out, time spent, frames per
    second.

    Spark keeps a limited number of a query's batches, and none of an earlier run; a longer
    run, or one that went on where another stopped, is refused rather than summed up in
    part. `published_summary` covers all runs.
    """
    _refuse_long_run(inventory.sparkSession, query)
    done = query.recentProgress
    if done and done[0].batchId > 0:
        raise ValueError("an earlier run wrote to this tree, and its batches are not known any more")
    frames = sum(p.numInputRows for p in done)
    seconds = sum(p.durationMs.get("triggerExecution", 0) for p in done) / 1000.0
    return inventory.agg(
        F.lit(len(done)).alias("n_batches"),
        F.lit(frames).alias("n_frames"),
        F.round(F.lit(frames / seconds if seconds else 0.0), 1).alias("msgs_per_sec"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_ticks"),
        F.count("*").alias("files_written"),
    )
