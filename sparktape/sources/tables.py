"""Ticks, frames and a write log derived from the generic test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import utc_date
from ..schema import STORED_COLS

# Constant clock of the test data: 2024-02-01 UTC, just after its last event.
AS_OF_NS = 1_706_745_600_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str, columns: str) -> DataFrame:
    """Some columns of a table. Zone-free times are read as instants in UTC, which takes
    the session's time zone out of the arithmetic."""
    return spark.read.schema(columns).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, spread: int = 1) -> DataFrame:
    """Tick columns of `events` next to the row number `n` and the time in microseconds.

    With `spread`, the table's rows are first dealt over so many tasks, however few its files.
    """
    columns = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    rows = _table(spark, sf_dir, "events", columns)
    return (rows.repartition(spread) if spread > 1 else rows).selectExpr(
        "CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'coinbase' END AS exchange",
        "upper(event_type) AS symbol",
        "CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price",
        "CAST(CAST(get_json_object(props, '$.k') AS BIGINT) + 1 AS DECIMAL(38,18)) AS size",
        "CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side",
        "unix_micros(ts) * 1000 AS timestamp_ns",
        "unix_micros(ts) * 1000 + event_id % 500 * 1000000 AS received_ns",
        "CAST(event_id AS STRING) AS trade_id",
        "event_id AS n",
        "unix_micros(ts) AS micros",
    )


def _with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date", utc_date(rows["timestamp_ns"]))


# UTC text of an instant, with as many fraction digits as it needs.
_ISO_TIME = (
    "translate(CAST(timestampadd(MICROSECOND, micros, TIMESTAMP_NTZ'1970-01-01') AS STRING), "
    "' ', 'T') || 'Z'"
)


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row number and ISO text of every event time."""
    return _events(spark, sf_dir).selectExpr("n AS event_id", f"{_ISO_TIME} AS iso_time")


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per row of `events`: ten feeds over thirty days."""
    return _with_date(_events(spark, sf_dir)).select(*STORED_COLS)


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per row of `lineitem`: a few busy feeds with equal times among them."""
    columns = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    time = "unix_micros(l_shipdate) * 1000 + (l_orderkey * 7 + l_linenumber) % 86400 * 1000000000"
    ticks = _table(spark, sf_dir, "lineitem", columns).selectExpr(
        "CASE WHEN l_suppkey % 3 = 0 THEN 'coinbase' ELSE 'binance' END AS exchange",
        "l_returnflag || l_linestatus AS symbol",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price",
        "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS size",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'buy' ELSE 'sell' END AS side",
        f"{time} AS timestamp_ns",
        f"{time} + l_partkey % 500 * 1000000 AS received_ns",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trade_id",
    )
    return _with_date(ticks).select(*STORED_COLS)


def event_frames(spark: SparkSession, sf_dir: str, spread: int = 1) -> DataFrame:
    """One raw frame per row of `events`, in the shape of its exchange.

    By row number modulo 50, on both exchanges: 0 cut short, 2 another kind of message.
    Binance: 1 negative price, 3 and 4 wrapped as on combined streams.
    Coinbase: 1 three trades with a bad second one, 3 a snapshot of two trades,
    4 an unknown side, 5 an event of another type before the trade. `spread` as for `_events`.
    """
    rows = _events(spark, sf_dir, spread).selectExpr(
        "exchange AS source",
        "received_ns",
        "n % 50 AS kind",
        "symbol",
        "side",
        "trade_id",
        "CAST(CAST(price AS DECIMAL(18,2)) AS STRING) AS price_text",
        "CAST(CAST(size AS BIGINT) AS STRING) AS size_text",
        "CAST(micros DIV 1000 AS STRING) AS millis",
        f"{_ISO_TIME} AS iso_time",
    )
    text = f"CASE WHEN source = 'binance' THEN {_binance_text()} ELSE {_coinbase_text()} END"
    return rows.selectExpr("source", f"{text} AS raw", "received_ns")


def _binance_text() -> str:
    def trade(price: str) -> str:
        return f"""concat('{{"e":"trade","E":', millis, ',"s":"', symbol, '","t":', trade_id,
          ',"p":"', {price}, '","q":"', size_text, '","T":', millis,
          ',"m":', CASE side WHEN 'sell' THEN 'true' ELSE 'false' END, ',"M":true}}')"""

    plain = trade("price_text")
    return f"""
      CASE kind
        WHEN 0 THEN substring({plain}, 1, 40)
        WHEN 1 THEN {trade("'-1'")}
        WHEN 2 THEN concat('{{"e":"depthUpdate","s":"', symbol, '"}}')
        ELSE CASE WHEN kind IN (3, 4)
          THEN concat('{{"stream":"', lower(symbol), '@trade","data":', {plain}, '}}')
          ELSE {plain} END END"""


def _coinbase_text() -> str:
    def trade(suffix: str = "", size: str = "size_text", side: str = "upper(side)") -> str:
        return f"""concat('{{"trade_id":"', trade_id, '{suffix}","product_id":"', symbol,
          '","price":"', price_text, '","size":"', {size}, '","side":"', {side},
          '","time":"', iso_time, '"}}')"""

    def frame(event: str, *trades: str, before: str = "") -> str:
        head = '{"channel":"market_trades","sequence_num":0,"events":[' + before
        head += f'{{"type":"{event}","trades":['
        return f"""concat('{head}', concat_ws(',', {", ".join(trades)}), ']}}]}}')"""

    other = '{"type":"l2_data","trades":[{"side":"LONG"}]},'
    return f"""
      CASE kind
        WHEN 0 THEN substring({frame("update", trade())}, 1, 60)
        WHEN 1 THEN {frame("update", trade("a"), trade("b", size="'0'"), trade("c"))}
        WHEN 2 THEN '{{"channel":"subscriptions","events":[{{"subscriptions":{{}}}}]}}'
        WHEN 3 THEN {frame("snapshot", trade("a"), trade("b"))}
        WHEN 4 THEN {frame("update", trade(side="'LONG'"))}
        WHEN 5 THEN {frame("update", trade(), before=other)}
        ELSE {frame("update", trade())} END"""


def event_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped tick rows with one broken field each for some rows, by number modulo 20.

    1 side, 2 price zero, 3 empty id, 4 a time in 2001, 5 receipt two seconds early,
    6 size not a number, 7 too many decimals, 8 negative size, 9 a far future time.
    """
    price, size = "CAST(CAST(price AS DECIMAL(18,2)) AS STRING)", "CAST(CAST(size AS BIGINT) AS STRING)"
    return (
        _events(spark, sf_dir)
        .selectExpr("*", "n % 20 AS kind")
        .selectExpr(
            "exchange",
            "symbol",
            f"CASE kind WHEN 2 THEN '0' WHEN 7 THEN {price} || '0000000000000000001' ELSE {price} END AS price",
            f"CASE kind WHEN 6 THEN 'abc' WHEN 8 THEN '-' || {size} ELSE {size} END AS size",
            "CASE kind WHEN 1 THEN 'long' ELSE side END AS side",
            "CASE kind WHEN 4 THEN 1000000000000000000L WHEN 9 THEN timestamp_ns + 630720000000000000L "
            "ELSE timestamp_ns END AS timestamp_ns",
            "CASE kind WHEN 5 THEN timestamp_ns - 2000000000L WHEN 9 THEN received_ns + 630720000000000000L "
            "ELSE received_ns END AS received_ns",
            "CASE kind WHEN 3 THEN '' ELSE trade_id END AS trade_id",
        )
    )


def event_write_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A write log as if each feed's day had been written in one batch."""
    rows = _with_date(_events(spark, sf_dir)).selectExpr(
        "exchange", "symbol", "date", "n", "received_ns"
    )
    batches = rows.groupBy("exchange", "symbol", "date").agg(
        F.min("n").alias("batch_id"), F.count("*").alias("n_ticks"), F.max("received_ns").alias("at_ns")
    )
    return batches.selectExpr(
        "batch_id", "exchange", "symbol", "n_ticks",
        "batch_id * 7919 % 12000 / 1000D AS latency_s", "at_ns",
    )
