"""Fixed schemas of ticks, raw frames and the write log."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(38, 18)

TICK = T.StructType(
    [
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", MONEY, False),
        T.StructField("size", MONEY, False),
        T.StructField("side", T.StringType(), False),
        T.StructField("timestamp_ns", T.LongType(), False),
        T.StructField("received_ns", T.LongType(), False),
        T.StructField("trade_id", T.StringType(), False),
    ]
)

# A stored tick: `date` is the UTC day of `timestamp_ns` and lives in the path only.
STORED_TICK = T.StructType([*TICK.fields, T.StructField("date", T.DateType(), False)])

FRAME = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("raw", T.StringType(), True),
        T.StructField("received_ns", T.LongType(), False),
    ]
)

WRITE_LOG = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("exchange", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("n_ticks", T.LongType(), False),
        T.StructField("latency_s", T.DoubleType(), False),
        T.StructField("at_ns", T.LongType(), False),
    ]
)

# One batch as a whole; the counts of frames are null for a batch that did not come from frames.
BATCH_LOG = T.StructType(
    [
        T.StructField("stream", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("n_frames", T.LongType(), True),
        T.StructField("n_errors", T.LongType(), True),
        T.StructField("n_ticks", T.LongType(), False),
        T.StructField("n_files", T.LongType(), False),
        T.StructField("latency_s", T.DoubleType(), False),
        T.StructField("at_ns", T.LongType(), False),
    ]
)

# A file of a published tree, added or removed by some commit; the path is from the root on.
FILE_ENTRY = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("min_ns", T.LongType(), False),
        T.StructField("max_ns", T.LongType(), False),
        T.StructField("removed", T.BooleanType(), False),
    ]
)

TICK_COLS = TICK.fieldNames()
STORED_COLS = STORED_TICK.fieldNames()
FEED = ["exchange", "symbol"]
PARTITION_COLS = ["exchange", "symbol", "date"]
