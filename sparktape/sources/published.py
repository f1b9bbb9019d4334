"""Tick trees whose files are listed in a manifest: whole commits, no directory listing.

    <root>/data/commit=C/exchange=X/symbol=Y/date=D/*.parquet    ticks
    <root>/files/...     one row per file that a commit adds or removes, with its time range
    <root>/writes/...    one row per batch and feed that was written
    <root>/batches/...   one row per batch
    <root>/_snapshots/   which of these folders count (see `snapshots`)

A range scan asks the manifest, a Spark query pruned by feed, day and time, for the files
that can hold a match, and reads those. What a failed job leaves behind is in no snapshot.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import utc_date
from ..functions.timeargs import TimeInput, clamp_long, to_ns
from ..schema import BATCH_LOG, FEED, FILE_ENTRY, PARTITION_COLS, STORED_COLS, STORED_TICK, TICK_COLS, WRITE_LOG
from .snapshots import Conflict, Snapshot, advance, fold, latest, read_folders

FILES, WRITES, BATCHES = "files", "writes", "batches"
# Small folders of one table from which they are folded into one.
FOLD_ABOVE = 64
TARGET_BYTES = 128 << 20
_COMPACTIONS = "compactions"


def with_date(ticks: DataFrame) -> DataFrame:
    """Ticks in stored form, the day computed from the trade time."""
    return ticks.select(*TICK_COLS, utc_date(F.col("timestamp_ns")).alias("date"))


def write_partitions(
    rows: DataFrame, path: str, mode: str, *, cluster: bool = True, max_records_per_file: int = 0
) -> None:
    """Stored ticks as a partitioned tree, sorted by time within files.

    With `cluster`, rows are first gathered per partition with a rebalance, which adaptive
    execution splits where one feed's day is too large and merges where days are small.
    """
    if cluster:
        rows = rows.hint("rebalance", *PARTITION_COLS)
    (
        rows.sortWithinPartitions(*PARTITION_COLS, "timestamp_ns")
        .write.mode(mode)
        .partitionBy(*PARTITION_COLS)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(str(path))
    )


# -- writing ------------------------------------------------------------------------------------


def create_published(spark: SparkSession, root: str) -> None:
    """An empty published tree, unless there is one."""
    advance(spark, root, lambda now: now)


def is_published(spark: SparkSession, root: str) -> bool:
    return latest(spark, root) is not None


def _file_path() -> Column:
    """A file's path as Spark's readers take it: `file_path` is a URI, in which only what a
    path may not hold is escaped (a plus sign is not)."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def _entries(spark: SparkSession, root: str, commit: str) -> DataFrame:
    """Manifest rows of the files that a commit has written; reads one column of them."""
    folder = f"{root}/data/commit={commit}"
    rows = spark.read.schema(STORED_TICK).option("basePath", folder).parquet(folder)
    return (
        rows.select(*PARTITION_COLS, "timestamp_ns", _file_path().alias("path"), F.col("_metadata.file_size").alias("n_bytes"))
        .groupBy(*PARTITION_COLS, "path", "n_bytes")
        .agg(F.count("*").alias("n_rows"), F.min("timestamp_ns").alias("min_ns"), F.max("timestamp_ns").alias("max_ns"))
        # From the root on, so that a tree can be moved.
        .withColumn("path", F.substring_index("path", f"data/commit={commit}/", -1))
        .withColumn("path", F.concat(F.lit(f"data/commit={commit}/"), "path"))
        .withColumn("removed", F.lit(False))
        .select(*FILE_ENTRY.fieldNames())
    )


def _write_small(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def publish_ticks(
    ticks: DataFrame,
    root: str,
    *,
    commit: str | None = None,
    fence: tuple[str, int] | None = None,
    frames: Observation | None = None,
    max_records_per_file: int = 0,
) -> Snapshot:
    """Add ticks to a published tree in one commit, which readers see as a whole.

    The write log gets one row per feed: how many ticks this commit wrote, and how long the
    write took. `fence`, a stream's name and its batch number, makes a batch count once
    however often it runs; `frames` has observed `n_frames` and `n_errors` of its input.
    """
    spark, root = ticks.sparkSession, str(root).rstrip("/")
    commit = commit or f"append-{uuid.uuid4().hex}"
    started = time.time()
    write_partitions(
        with_date(ticks), f"{root}/data/commit={commit}", "overwrite", max_records_per_file=max_records_per_file
    )
    ended = time.time()
    _write_small(_entries(spark, root, commit).coalesce(1).sortWithinPartitions(*PARTITION_COLS), f"{root}/files/{commit}")
    batch_id = F.lit(fence[1] if fence else None).cast("long")
    stamp = {
        "batch_id": batch_id,
        "latency_s": F.lit(ended - started),
        "at_ns": F.lit(int(ended * 1e6) * 1_000).cast("long"),
    }
    written = spark.read.schema(FILE_ENTRY).parquet(f"{root}/files/{commit}")
    feeds = written.groupBy(*FEED).agg(F.sum("n_rows").alias("n_ticks")).withColumns(stamp)
    _write_small(feeds.select(*WRITE_LOG.fieldNames()).coalesce(1), f"{root}/writes/{commit}")
    seen = frames.get if frames else {}
    one = written.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_ticks"), F.count("*").alias("n_files")
    ).withColumns(
        stamp
        | {
            "stream": F.lit(fence[0] if fence else None).cast("string"),
            "n_frames": F.lit(seen.get("n_frames")).cast("long"),
            "n_errors": F.lit(seen.get("n_errors")).cast("long"),
        }
    )
    _write_small(one.select(*BATCH_LOG.fieldNames()), f"{root}/batches/{commit}")

    def change(now: Snapshot) -> Snapshot:
        if fence and now.fences.get(fence[0], -1) >= fence[1]:
            return now
        for table in (FILES, WRITES, BATCHES):
            now = now.with_folder(table, commit)
        return now.with_fence(*fence) if fence else now

    done = advance(spark, root, change)
    fold(spark, root, WRITES, WRITE_LOG, above=FOLD_ABOVE)
    fold(spark, root, BATCHES, BATCH_LOG, above=FOLD_ABOVE)
    fold(spark, root, FILES, FILE_ENTRY, _net, above=FOLD_ABOVE)
    return done


def compact(
    spark: SparkSession,
    root: str,
    *,
    target_bytes: int = TARGET_BYTES,
    small_bytes: int | None = None,
    **bounds,
) -> int:
    """Put the small files of each feed's day together; returns how many were replaced.

    `bounds` (as for `files_in_range`) restrict it to a feed or to some days; the driver gets
    the paths of the files that it replaces. Files below `small_bytes` (half the target) are dealt, in order of time, into files of
    about `target_bytes`. Old and new files change places in one commit, beside which a
    stream may go on; of two compactions at once, the later one raises `Conflict`. Replaced
    files stay on disk for readers that have begun with them.
    """
    root = str(root).rstrip("/")
    before = latest(spark, root)
    small = F.col("n_bytes") < (target_bytes // 2 if small_bytes is None else small_bytes)
    day = Window.partitionBy(*PARTITION_COLS)
    ahead = F.sum("n_bytes").over(day.orderBy("min_ns", "path")) - F.col("n_bytes")
    bins = files_in_range(live_files(spark, root, before), **bounds).where(small).withColumn(
        "bin", F.floor(ahead / target_bytes).cast("int")
    )
    several = F.count("*").over(Window.partitionBy(*PARTITION_COLS, "bin")) > 1
    bins = bins.withColumn("several", several).where("several").drop("several")
    commit = f"compact-{uuid.uuid4().hex}"
    # The plan is kept: it is read three times, and must not change in between.
    _write_small(bins, f"{root}/plans/{commit}")
    plan = spark.read.schema(bins.schema).parquet(f"{root}/plans/{commit}")
    total = plan.agg(F.count("*"), F.sum("n_bytes"), F.sum("n_rows")).first()
    if not total[0]:
        return 0
    rows = _read_files(spark, root, [r.path for r in plan.select("path").collect()], _file_path().alias("path"))
    rows = rows.withColumn("path", F.concat(F.lit("data/commit="), F.substring_index("path", "/data/commit=", -1)))
    rows = rows.join(plan.select("path", "bin"), "path").drop("path")
    rows = rows.hint("rebalance", *PARTITION_COLS, "bin")
    # Two bins of a day may meet in one task; rows a file bound what comes of it.
    write_partitions(
        rows.drop("bin"),
        f"{root}/data/commit={commit}",
        "overwrite",
        cluster=False,
        max_records_per_file=max(1, -(-target_bytes * total[2] // total[1])),
    )
    gone = plan.withColumn("removed", F.lit(True)).select(*FILE_ENTRY.fieldNames())
    _write_small(_entries(spark, root, commit).unionByName(gone), f"{root}/files/{commit}")
    wrote = spark.read.schema(FILE_ENTRY).parquet(f"{root}/files/{commit}").where("NOT removed")
    if wrote.agg(F.sum("n_rows")).first()[0] != total[2]:
        raise RuntimeError(f"{root}: the new files do not hold the rows of the old ones")
    turn = before.fences.get(_COMPACTIONS, 0)

    def change(now: Snapshot) -> Snapshot:
        if now.fences.get(_COMPACTIONS, 0) != turn:
            raise Conflict(f"{root}: another compaction was faster")
        return now.with_folder(FILES, commit).with_fence(_COMPACTIONS, turn + 1)

    advance(spark, root, change)
    return total[0]


# -- reading ------------------------------------------------------------------------------------


def _net(entries: DataFrame) -> DataFrame:
    """The files that are added and not removed."""
    gone = entries.where("removed").select("path")
    return entries.where("NOT removed").join(gone, "path", "left_anti").select(*FILE_ENTRY.fieldNames())


def live_files(spark: SparkSession, root: str, snapshot: Snapshot | None = None) -> DataFrame:
    """Manifest of a published tree: one row per file that counts."""
    return _net(read_folders(spark, root, FILES, FILE_ENTRY, snapshot))


def files_in_range(
    files: DataFrame,
    *,
    exchange: str | None = None,
    symbol: str | None = None,
    start: TimeInput | None = None,
    end: TimeInput | None = None,
) -> DataFrame:
    """Files that can hold a tick of the feed in `[start, end)`; bounds may be absent."""
    for name, value in (("exchange", exchange), ("symbol", symbol)):
        if value is not None:
            files = files.where(F.col(name) == value)
    if start is not None:
        files = files.where(F.col("max_ns") >= F.lit(clamp_long(to_ns(start))).cast("long"))
    if end is not None:
        files = files.where(F.col("min_ns") < F.lit(clamp_long(to_ns(end))).cast("long"))
    return files


def _read_files(spark: SparkSession, root: str, paths: list[str], *more: Column) -> DataFrame:
    reader = spark.read.schema(STORED_TICK).option("basePath", f"{root}/data")
    return reader.parquet(*(f"{root}/{path}" for path in paths)).select(*STORED_COLS, *more)


def read_published(spark: SparkSession, root: str, snapshot: Snapshot | None = None, **bounds) -> DataFrame:
    """Ticks of the files that can hold a match; `bounds` as for `files_in_range`.

    The driver gets the paths of those files and nothing else. What the bounds leave in
    those files is for the caller to filter.
    """
    root = str(root).rstrip("/")
    files = files_in_range(live_files(spark, root, snapshot), **bounds)
    paths = [row.path for row in files.select("path").collect()]
    return _read_files(spark, root, paths) if paths else spark.createDataFrame([], STORED_TICK)


def write_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch and feed that was ever published: ticks, seconds, time of writing."""
    return read_folders(spark, root, WRITES, WRITE_LOG)


def batch_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: frames read, frames that failed, ticks and files written."""
    return read_folders(spark, root, BATCHES, BATCH_LOG)
