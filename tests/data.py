"""Tick sets with known answers, made by Spark from a range of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktape.schema import STORED_COLS, STORED_TICK
from sparktape.functions.columns import utc_date

BASE_NS = 1_716_163_200_000_000_000  # 2024-05-20 UTC
ROWS = 333_334
STEP_NS = 2 * 86_400_000_000_000 // ROWS
HOUR_NS = 3_600_000_000_000


def two_days(spark: SparkSession) -> DataFrame:
    """A million ticks of three symbols over two days; prices rise by one, modulo 100."""
    bases = "map('BTCUSDT', 1000, 'ETHUSDT', 2000, 'SOLUSDT', 50)"
    return (
        spark.range(ROWS)
        .select("id", F.explode(F.expr(bases)).alias("symbol", "base"))
        .selectExpr(
            "'binance' AS exchange",
            "symbol",
            "CAST(base + id % 100 AS DECIMAL(38,18)) AS price",
            "CAST(0.1 AS DECIMAL(38,18)) AS size",
            "CASE WHEN id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side",
            f"{BASE_NS}L + id * {STEP_NS}L AS timestamp_ns",
            f"{BASE_NS}L + id * {STEP_NS}L + 1000000L AS received_ns",
            "symbol || '-' || id AS trade_id",
        )
        .withColumn("date", utc_date(F.col("timestamp_ns")))
        .select(*STORED_COLS)
    )


def ticks_at(
    spark: SparkSession,
    times: list[int],
    exchange: str = "test",
    symbol: str = "GAPUSDT",
    price: str = "100",
    size: str = "1",
) -> DataFrame:
    """Ticks of one feed at the given nanoseconds."""
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "timestamp_ns long, i long")
    return (
        rows.selectExpr(
            f"'{exchange}' AS exchange",
            f"'{symbol}' AS symbol",
            f"CAST('{price}' AS DECIMAL(38,18)) AS price",
            f"CAST('{size}' AS DECIMAL(38,18)) AS size",
            "'buy' AS side",
            "timestamp_ns",
            "timestamp_ns AS received_ns",
            "'t' || i AS trade_id",
        )
        .withColumn("date", utc_date(F.col("timestamp_ns")))
        .select(*STORED_TICK.fieldNames())
    )


def with_gap(spark: SparkSession) -> DataFrame:
    """A hundred seconds of ticks, five minutes of nothing, a hundred seconds more."""
    second = 1_000_000_000
    first = [BASE_NS + i * second for i in range(100)]
    later = [first[-1] + 300 * second + i * second for i in range(100)]
    return ticks_at(spark, first + later)
