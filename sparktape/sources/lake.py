"""The tick tree: `exchange=X/symbol=Y/date=D/` partitions of ZSTD Parquet."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeargs import TimeInput
from ..schema import STORED_COLS, STORED_TICK
from . import published
from .published import with_date, write_partitions

STREAM_LOG = "_spark_metadata"


# Names that stand in a path as they are, whoever wrote the tree.
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def _directory(name: str, value: str | None) -> str:
    return f"{name}={value if value and _PLAIN_NAME.fullmatch(value) else '*'}"


def _open(
    spark: SparkSession, root: str, exchange: str | None = None, symbol: str | None = None
) -> DataFrame | None:
    """Tree at `root`, or None where there is no such path."""
    root = str(root).rstrip("/")
    reader = spark.read.schema(STORED_TICK).option("pathGlobFilter", "*.parquet")
    path = root
    if (exchange or symbol) and not _is_stream_tree(spark, root):
        path = f"{root}/{_directory('exchange', exchange)}/{_directory('symbol', symbol)}"
        reader = reader.option("basePath", root)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_ticks(
    spark: SparkSession,
    *roots: str,
    exchange: str | None = None,
    symbol: str | None = None,
    start: TimeInput | None = None,
    end: TimeInput | None = None,
) -> DataFrame:
    """Ticks of one or more trees with the path's `date`; no rows where nothing exists yet.

    The schema is given, so no file is opened to infer one, and unfinished `.tmp` files
    of other writers are passed over. Trees are read one by one because a tree written by
    a stream keeps its own list of finished files.

    Naming an exchange or a symbol keeps the driver from listing the directories of all
    the others, which matters in a tree with millions of them. Of a published tree no
    directory is listed at all: its manifest names the files, and `start` and `end` leave
    out those without a tick in between. (Rows outside of them may still come out.)
    """
    named = {"exchange": exchange, "symbol": symbol}
    found = [
        published.read_published(spark, root, start=start, end=end, **named)
        if published.is_published(spark, root)
        else _open(spark, root, **named)
        for root in roots
    ]
    trees = [tree.select(*STORED_COLS) for tree in found if tree is not None]
    ticks = reduce(DataFrame.unionByName, trees) if trees else spark.createDataFrame([], STORED_TICK)
    for name, value in named.items():
        if value is not None:
            ticks = ticks.where(F.col(name) == value)
    return ticks


def read_partition(
    spark: SparkSession, root: str, exchange: str, symbol: str, day: str, columns: list[str]
) -> DataFrame:
    """Some columns of one partition; only that directory is read."""
    return (
        read_ticks(spark, root, exchange=exchange, symbol=symbol)
        .where(F.col("date") == F.lit(day).cast("date"))
        .select(*columns)
    )


def append_ticks(
    ticks: DataFrame, root: str, *, cluster: bool = True, max_records_per_file: int = 0
) -> None:
    """Add ticks to a tree. A file appears complete or not at all, when the job commits.

    Spark's default committer then moves the files one by one, so a reader at that moment can
    see a part of them; a job that fails leaves none. Where readers must never see a part, use
    a published tree (`published.create_published`), to which this appends in one commit.

    Rows are gathered per partition with a rebalance, which adaptive execution splits
    where one feed's day is too large for a task and merges where days are small; within a
    file they are sorted by time, so range filters skip row groups. `cluster=False`
    writes without a shuffle, for input that is already arranged.
    """
    spark = ticks.sparkSession
    if _is_stream_tree(spark, root):
        raise ValueError(f"{root} is written by a stream; append to another tree and read both")
    if published.is_published(spark, root):
        published.publish_ticks(ticks, root, max_records_per_file=max_records_per_file)
        return
    rows = with_date(ticks)
    write_partitions(rows, root, "append", cluster=cluster, max_records_per_file=max_records_per_file)


def _batch_numbers(spark: SparkSession, path: str) -> list[int] | None:
    """Batches that a stream's log folder has an entry for; None where there is no folder.

    Spark's readers hide such folders, so the file system is asked.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    names = [status.getPath().getName().split(".")[0] for status in files.listStatus(folder)]
    return [int(name) for name in names if name.isdigit()]


def _is_stream_tree(spark: SparkSession, root: str) -> bool:
    return _batch_numbers(spark, f"{str(root).rstrip('/')}/{STREAM_LOG}") is not None


def check_stream_target(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Refuses a tree that a stream with this checkpoint would lose ticks in.

    The sink's list of files would hide the files of a batch job, and it takes a batch whose
    number it already holds for done; so the tree may not be ahead of the checkpoint.
    """
    listed = _batch_numbers(spark, f"{str(root).rstrip('/')}/{STREAM_LOG}")
    if listed is None:
        tree = _open(spark, root)
        if tree is not None and tree.inputFiles():
            raise ValueError(f"{root} holds files of batch writes; stream to another tree and read both")
        return
    done = _batch_numbers(spark, f"{checkpoint.rstrip('/')}/commits") or [-1]
    # The last batch may be in the tree but not yet in the checkpoint.
    if max(listed, default=-1) > max(done) + 1 or (listed and done == [-1] and max(listed) > 0):
        raise ValueError(f"{root} is ahead of the checkpoint {checkpoint}; restart with its own")


def check_fence(spark: SparkSession, root: str, checkpoint: str, name: str) -> None:
    """Refuses a checkpoint that is behind what the stream `name` has published at `root`:
    its batches would be taken for done."""
    now = published.latest(spark, root)
    done = max(_batch_numbers(spark, f"{checkpoint.rstrip('/')}/commits") or [-1], default=-1)
    # The last batch may be in the tree but not yet in the checkpoint.
    if now and now.fences.get(name, -1) > done + 1 or (now and done == -1 and now.fences.get(name, -1) > 0):
        raise ValueError(f"stream {name!r} at {root} is ahead of the checkpoint {checkpoint}")


def tree_feeds(spark: SparkSession, *roots: str) -> list[tuple[str, str]]:
    """Exchange and symbol of each directory, from the paths of the files alone."""
    found = set()
    for root in roots:
        if published.is_published(spark, root):
            feeds = published.live_files(spark, root).select("exchange", "symbol").distinct()
            found |= {tuple(feed) for feed in feeds.collect()}
            continue
        tree = _open(spark, root)
        for path in tree.inputFiles() if tree is not None else []:
            parts = dict(p.split("=", 1) for p in path.split("/") if "=" in p)
            # Names in file URIs are escaped once by Spark and once more as a URI.
            found.add(tuple(unquote(unquote(parts[c])) for c in ("exchange", "symbol")))
    return sorted(found)


def partition_path() -> Column:
    """Relative directory of a tick; Spark escapes awkward characters when it writes."""
    return F.concat_ws(
        "/",
        F.concat(F.lit("exchange="), F.col("exchange")),
        F.concat(F.lit("symbol="), F.col("symbol")),
        F.concat(F.lit("date="), F.col("date").cast("string")),
    )


def partition_layout(ticks: DataFrame) -> DataFrame:
    """Ticks per partition directory."""
    return ticks.groupBy(partition_path().alias("partition")).agg(F.count("*").alias("n_rows"))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files of a tree with bytes and rows; no data column is read, and of a published tree
    nothing but its manifest."""
    if published.is_published(spark, root):
        path = F.concat(F.lit(f"{str(root).rstrip('/')}/"), "path").alias("path")
        return published.live_files(spark, root).select(path, "n_bytes", "n_rows")
    tree = _open(spark, root)
    if tree is None:
        return spark.createDataFrame([], "path string, n_bytes long, n_rows long")
    return (
        tree.select("_metadata.file_path", "_metadata.file_size")
        .groupBy(F.col("file_path").alias("path"), F.col("file_size").alias("n_bytes"))
        .agg(F.count("*").alias("n_rows"))
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Files, rows and bytes of a whole tree."""
    return inventory.agg(
        F.count("*").alias("n_files"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"),
    )
