"""Intermediate tables in the shared folder, and small fixed-size filters made from them."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Bits of a key filter: 2^26 bits are 8 MB, however many keys there are.
FILTER_BITS = 26
_BLOCK = 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder that all executors share, and read from there.

    Cuts the lineage: a lost executor costs no more than the step that was running.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, name)
    # Mostly hashes: a dictionary would only cost time.
    rows.write.option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# Bytes of rows that go to a Python worker at once; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python workers in batches of `BATCH_BYTES` for as long as this lasts."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def lean(run: Callable) -> Callable:
    """The function of a Python stage, giving freed memory back when its task is done: a
    worker lives on through later tasks and stages."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return wrapped


def computed_once(rows: DataFrame, name: str) -> DataFrame:
    """The rows, their column `name` behind a generator of one element: a filter on it is not
    pushed into a second copy of the Python function that computes it."""
    return rows.withColumn(name, F.explode(F.array(name)))


def text_bytes(name: str = "text") -> Column:
    """UTF-8 of a text column, without decoding it on the way to Python; null stays null."""
    return F.col(name).cast("string").cast("binary")


def free_names(rows: DataFrame, *wanted: str) -> list[str]:
    """Names for working columns that clash with no column of `rows`."""
    taken = {name.lower() for name in rows.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def key_filter(rows: DataFrame, key: Column) -> Broadcast:
    """Set of long keys as a bit array of fixed size, sent to all executors.

    Membership has no false negatives; false positives grow with the number of keys, so
    whoever uses it must not rely on it for more than saving work.
    """
    slot = key.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    blocks = (
        rows.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", _BLOCK).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << _BLOCK) - 1)).alias("bits"))
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (_BLOCK - 3)
    for row in blocks.collect():  # at most 2^(26 - 15) rows of 4 KB
        bits[row.block * width : (row.block + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bits)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & ((1 << FILTER_BITS) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
