"""Event-time jobs over a stream of ticks: bars and gaps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions.columns import as_double, bar_start, ns_to_timestamp
from ..functions.timeargs import NS_PER_SECOND, parse_interval
from ..operators.health import STALE_RED_S, STALE_YELLOW_S
from ..operators.market import BAR_COLS, bar_columns, gap_threshold_ns, trade_order
from ..schema import FEED
from ..sources.lake import check_fence
from ..sources.snapshots import Snapshot, advance, fold, latest, read_folders

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed_state(spark: SparkSession) -> None:
    """Processors with state of their own need the RocksDB store; a store that the session
    names itself stays."""
    if not spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKS_DB)


def stream_bars(ticks: DataFrame, interval: str = "1m", delay: str = "1 minute") -> DataFrame:
    """Bars per feed, each emitted once the watermark has passed its end.

    Ticks later than `delay` are left out of bars already emitted; the batch query over
    the stored ticks remains the complete answer. Open and close go by the nanosecond.
    """
    seconds = parse_interval(interval) // NS_PER_SECOND
    timed = ticks.withColumn("ts", ns_to_timestamp(F.col("timestamp_ns"))).withWatermark("ts", delay)
    start_ns = F.unix_micros("window.start") * F.lit(1_000)
    return (
        timed.groupBy(*FEED, F.window("ts", f"{seconds} seconds"))
        .agg(*bar_columns())
        .withColumn("bar_start_ns", start_ns)
        .select(*FEED, *BAR_COLS)
    )


# -- corrected bars -----------------------------------------------------------------------------

BARS = "bars"
# Folders of partial bars from which they are merged into one.
_FOLD_ABOVE = 32
BAR_PART = T.StructType(
    [
        T.StructField("exchange", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("bar_start_ns", T.LongType()),
        T.StructField("first", T.DecimalType(38, 0)),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("last", T.DecimalType(38, 0)),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("count", T.LongType()),
    ]
)


def _bar_parts(ticks: DataFrame, interval: str) -> DataFrame:
    """Bars of some ticks, with the order of their first and last trade."""
    slot = bar_start(parse_interval(interval)).alias("bar_start_ns")
    order, price = trade_order(), as_double("price")
    return (
        ticks.groupBy(*FEED, slot)
        .agg(
            F.min(order).alias("first"),
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(order).alias("last"),
            F.max_by(price, order).alias("close"),
            F.sum(as_double("size")).alias("volume"),
            F.count("*").alias("count"),
        )
        .select(*BAR_PART.fieldNames())
    )


def _merged(parts: DataFrame) -> DataFrame:
    """One part per bar."""
    return (
        parts.groupBy(*FEED, "bar_start_ns")
        .agg(
            F.min_by("open", "first").alias("open"),
            F.min("first").alias("first"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "last").alias("close"),
            F.max("last").alias("last"),
            F.sum("volume").alias("volume"),
            F.sum("count").alias("count"),
        )
        .select(*BAR_PART.fieldNames())
    )


def publish_bars(
    ticks: DataFrame,
    root: str,
    interval: str = "1m",
    checkpoint: str | None = None,
    *,
    available_now: bool = False,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Bars of a stream of ticks that late ticks go on to correct, however late they are.

    There is no watermark and no state: each micro-batch publishes, in one commit, a partial
    bar for every bar that it has ticks of, and `corrected_bars` merges the parts. A bar
    thus changes when a late tick arrives and is final when the last one has. A batch that
    runs again changes nothing.
    """
    spark, root = ticks.sparkSession, str(root).rstrip("/")
    checkpoint = checkpoint or f"{root}-checkpoint"
    name = f"{BARS}-{interval}"
    advance(spark, root, lambda now: now)
    check_fence(spark, root, checkpoint, name)

    def publish(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if latest(session, root).fences.get(name, -1) >= batch_id:
            return
        folder = f"{name}-{batch_id:012d}"
        parts = _bar_parts(batch, interval)
        parts.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{name}/{folder}")

        def change(now: Snapshot) -> Snapshot:
            done = now.fences.get(name, -1) >= batch_id
            return now if done else now.with_folder(name, folder).with_fence(name, batch_id)

        advance(session, root, change)
        fold(session, root, name, BAR_PART, _merged, above=_FOLD_ABOVE)

    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    writer = ticks.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def corrected_bars(spark: SparkSession, root: str, interval: str = "1m") -> DataFrame:
    """Bars of all ticks that have arrived at a folder of `publish_bars`, unordered."""
    parts = read_folders(spark, root, f"{BARS}-{interval}", BAR_PART)
    return _merged(parts).select(*FEED, *BAR_COLS)


# -- gaps ---------------------------------------------------------------------------------------

_GAP = "exchange string, symbol string, gap_start_ns long, gap_end_ns long, gap_seconds double"


def slot_micros(max_gap_seconds: float) -> int:
    """Width of the slots in which a stream of ticks is gathered before gaps are looked for."""
    return max((gap_threshold_ns(max_gap_seconds) + 1) // 1_000, 1)


class _Stitch(StatefulProcessor):
    """Gaps of one feed between slots that come in order; remembers the last time seen."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for lo, hi in sorted((r.lo, r.hi) for r in rows):
            if last is not None and lo - last > self.threshold:
                yield Row(
                    exchange=key[0], symbol=key[1], gap_start_ns=last, gap_end_ns=lo, gap_seconds=(lo - last) / 1e9
                )
            last = hi if last is None else max(last, hi)
        self.last.update((last,))

    def close(self) -> None:
        pass


def stream_gaps(ticks: DataFrame, max_gap_seconds: float = 60.0, delay: str = "1 minute") -> DataFrame:
    """Gaps per feed, exact to the nanosecond, emitted as the watermark passes the slot in
    which they end.

    Two ticks in one slot of at most `threshold + 1` ns cannot be a gap apart, so a streaming
    aggregate first shrinks each slot of each feed to its first and last time. Its groups
    are slots, not feeds: however busy one feed is, its ticks combine on the map side and
    spread over all tasks. Only slots that the watermark has passed, one row each and in
    order, go on to the feed's state, which is a single time.

    Thresholds below a microsecond are refused.
    """
    threshold, width = gap_threshold_ns(max_gap_seconds), slot_micros(max_gap_seconds)
    if threshold < 999:
        raise ValueError("a stream tells gaps apart from a microsecond on")
    _keyed_state(ticks.sparkSession)
    timed = ticks.withColumn("ts", ns_to_timestamp(F.col("timestamp_ns"))).withWatermark("ts", delay)
    slots = (
        timed.groupBy(*FEED, F.window("ts", f"{width} microseconds"))
        .agg(F.min("timestamp_ns").alias("lo"), F.max("timestamp_ns").alias("hi"))
        .select(*FEED, "lo", "hi")
    )
    return slots.groupBy(*FEED).transformWithState(_Stitch(threshold), _GAP, "append", "none")


# -- silent feeds -------------------------------------------------------------------------------

_LEVEL = "exchange string, symbol string, level string, since_ms long, at_ms long"


class _Watch(StatefulProcessor):
    """Level of one feed, from the time at which its last message was processed."""

    def __init__(self, yellow_ms: int, red_ms: int):
        self.steps = [("yellow", yellow_ms), ("red", red_ms)]

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "seen long, level string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for _ in rows:
            pass
        now = timerValues.getCurrentProcessingTimeInMs()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        for _, after in self.steps:
            self.handle.registerTimer(now + after)
        before = self.seen.get()[1] if self.seen.exists() else None
        self.seen.update((now, "green"))
        if before != "green":
            yield Row(exchange=key[0], symbol=key[1], level="green", since_ms=now, at_ms=now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, (seen, before) = timerValues.getCurrentProcessingTimeInMs(), self.seen.get()
        reached = [level for level, after in self.steps if now - seen >= after]
        if reached and reached[-1] != before:
            self.seen.update((seen, reached[-1]))
            yield Row(exchange=key[0], symbol=key[1], level=reached[-1], since_ms=seen, at_ms=now)

    def close(self) -> None:
        pass


def stream_staleness(
    ticks: DataFrame, yellow_s: float = STALE_YELLOW_S, red_s: float = STALE_RED_S
) -> DataFrame:
    """A row whenever the level of a feed changes: green as a message comes, yellow and red
    once it has been silent for that many seconds.

    Timers of the processing clock raise the levels, so a feed that stops is noticed without
    any new data, as long as the query runs with a processing-time trigger. Messages shrink
    to one per feed and task before the shuffle. A change is reported at the first trigger
    after it is due; a feed that turns red between two triggers skips yellow.
    """
    _keyed_state(ticks.sparkSession)
    one = ticks.select(*FEED).mapInArrow(_distinct_feeds, "exchange string, symbol string")
    watch = _Watch(int(yellow_s * 1_000), int(red_s * 1_000))
    return one.groupBy(*FEED).transformWithState(watch, _LEVEL, "update", "processingTime")


def _distinct_feeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pa.Table.from_batches([batch]).group_by(FEED).aggregate([]).to_batches()
