import time
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from sparktape.operators import validate

NOW = time.time_ns()
GOOD = {
    "exchange": "binance",
    "symbol": "BTC-USDT",
    "price": "67432.50",
    "size": "0.01234",
    "side": "buy",
    "timestamp_ns": NOW - 1_000_000,
    "received_ns": NOW,
    "trade_id": "abc123",
}
SCHEMA = (
    "exchange string, symbol string, price string, size string, side string, "
    "timestamp_ns long, received_ns long, trade_id string"
)


def reasons(spark, *changes):
    rows = [tuple((GOOD | change).values()) for change in changes]
    checked = validate.check_ticks(spark.createDataFrame(rows, SCHEMA), NOW)
    return [r.reason for r in checked.collect()]


ACCEPTED = [
    {},
    {"side": "sell"},
    {"price": "50000", "size": "1"},
    {"price": "0.00000001", "size": "123456789.123456789"},
    {"received_ns": NOW - 1_000_000 - 500_000_000},
    {"price": "1e3"},
    {"price": "1.0E-18"},
    {"price": "+5."},
    {"price": ".5"},
    {"price": " 7 "},
    {"price": "1.1000000000000000000000"},
    {"price": "00000000000000000000000012"},
]
REJECTED = [
    ({"price": "0"}, "price must be > 0"),
    ({"price": "-1"}, "price must be > 0"),
    ({"price": "0.000"}, "price must be > 0"),
    ({"price": "-1e40"}, "price must be > 0"),
    ({"size": "0"}, "size must be > 0"),
    ({"price": "abc"}, "Cannot convert"),
    ({"price": "NaN"}, "Cannot convert"),
    ({"price": ""}, "Cannot convert"),
    ({"price": "1.2.3"}, "Cannot convert"),
    ({"price": "Infinity"}, "Cannot convert"),
    ({"price": "1.0000000000000000001"}, "scale_overflow"),
    ({"price": "1e-19"}, "scale_overflow"),
    ({"price": "1e21"}, "scale_overflow"),
    ({"price": "123456789012345678901"}, "scale_overflow"),
    ({"side": "long"}, "Unknown side"),
    ({"timestamp_ns": 10**18}, "before 2010"),
    ({"timestamp_ns": NOW + 7_300 * 86_400 * 10**9, "received_ns": NOW + 7_300 * 86_400 * 10**9}, "future"),
    ({"received_ns": NOW - 2_100_000_000}, "clock sync"),
    ({"timestamp_ns": None}, "not readable"),
    ({"trade_id": ""}, "missing or empty"),
    ({"exchange": None}, "missing or empty"),
    ({"price": None}, "missing or empty"),
    ({"side": None}, "missing or empty"),
]


def test_accepted(spark):
    assert reasons(spark, *ACCEPTED) == [None] * len(ACCEPTED)


def test_accepted_text_is_read_in_full(spark):
    rows = [tuple((GOOD | change).values()) for change in ACCEPTED]
    ticks, _ = validate.split_valid(spark.createDataFrame(rows, SCHEMA), NOW)
    want = sorted(Decimal((GOOD | change)["price"].strip()) for change in ACCEPTED)
    assert sorted(r.price for r in ticks.collect()) == want


def test_rejected(spark):
    found = reasons(spark, *(change for change, _ in REJECTED))
    assert all(want in got for got, (_, want) in zip(found, REJECTED, strict=True)), found


def test_values_are_exact(spark):
    rows = [tuple((GOOD | {"price": p}).values()) for p in ("0.00000001", "1e3", "67432.12345678901234")]
    ticks, bad = validate.split_valid(spark.createDataFrame(rows, SCHEMA), NOW)
    assert {r.price for r in ticks.collect()} == {
        Decimal("1E-8"), Decimal(1000), Decimal("67432.12345678901234"),
    }
    assert bad.count() == 0


@pytest.mark.parametrize("kind", ["double", "float"])
def test_floats_are_refused_by_schema(spark, kind):
    rows = spark.createDataFrame([tuple(GOOD.values())], SCHEMA)
    floats = rows.withColumn("price", rows["price"].cast(kind))
    with pytest.raises(ValueError, match="float is not allowed"):
        validate.check_ticks(floats)


def test_typed_rows(spark):
    rows = spark.createDataFrame([tuple(GOOD.values()), tuple((GOOD | {"size": "-3"}).values())], SCHEMA)
    typed = rows.withColumn("price", rows["price"].cast("decimal(38,18)")).withColumn(
        "size", rows["size"].cast("decimal(38,18)")
    )
    ticks, bad = validate.split_valid(typed)
    assert ticks.count() == 1
    assert [r.reason for r in bad.collect()] == ["size must be > 0"]
    whole = rows.where("size > '0'").withColumn("price", F.lit(50_000))
    assert validate.check_ticks(whole, NOW).where("reason IS NULL").count() == 1
