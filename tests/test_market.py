import random
from datetime import UTC, date, datetime
from decimal import Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktape import TickLake, append_ticks
from sparktape.functions.columns import as_double, bar_start
from sparktape.operators import market
from sparktape.schema import FEED, TICK
from tests.data import BASE_NS, HOUR_NS, ROWS, STEP_NS, ticks_at, two_days, with_gap

DAY_NS = 24 * HOUR_NS
WHOLE = (BASE_NS, BASE_NS + 2 * DAY_NS)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    append_ticks(two_days(spark), str(root))
    append_ticks(with_gap(spark), str(root))
    with TickLake(spark, str(root), own_layout=True) as opened:
        yield opened


def test_symbols_are_sorted_pairs(lake):
    assert lake.symbols() == [
        "binance:BTCUSDT",
        "binance:ETHUSDT",
        "binance:SOLUSDT",
        "test:GAPUSDT",
    ]


def test_first_hundred_trades(lake):
    rows = lake.trades("BTCUSDT", BASE_NS, BASE_NS + 100 * STEP_NS).collect()
    assert [int(r.price) for r in rows] == list(range(1000, 1100))
    times = [r.timestamp_ns for r in rows]
    assert times == sorted(times)
    assert rows[0].asDict().keys() >= {"exchange", "side", "received_ns", "trade_id", "date"}


def test_ranges_are_half_open(lake):
    assert lake.trades("BTCUSDT", BASE_NS, BASE_NS + STEP_NS).count() == 1
    assert lake.trades("BTCUSDT", BASE_NS + 1, BASE_NS + STEP_NS).count() == 0
    assert lake.trades("BTCUSDT", BASE_NS, BASE_NS).count() == 0
    assert lake.trades("BTCUSDT", *WHOLE).count() == ROWS
    assert lake.trades("BTCUSDT", 0, 2**70).count() == ROWS


def test_time_forms_agree(lake):
    texts = lake.trades("ETHUSDT", "2024-05-20T00:00:00Z", "2024-05-20T01:00:00Z")
    moments = lake.trades("ETHUSDT", datetime(2024, 5, 20), datetime(2024, 5, 20, 1, tzinfo=UTC))
    assert texts.count() == moments.count() == -(-HOUR_NS // STEP_NS)


def test_exchange_filter(lake):
    assert lake.trades("BTCUSDT", *WHOLE, exchange="coinbase").count() == 0
    assert lake.trades("BTCUSDT", *WHOLE, exchange="binance").count() == ROWS


def test_vwap(lake):
    assert float(lake.vwap("BTCUSDT", BASE_NS, BASE_NS + 100 * STEP_NS)) == pytest.approx(1049.5)
    assert isinstance(lake.vwap("BTCUSDT", *WHOLE), Decimal)
    with pytest.raises(ValueError, match="No trades found"):
        lake.vwap("BTCUSDT", *WHOLE, exchange="coinbase")


@pytest.mark.parametrize(
    ("interval", "end", "bars"),
    [("1m", HOUR_NS, 60), ("5m", HOUR_NS, 12), ("1h", 2 * DAY_NS, 48), ("1d", 2 * DAY_NS, 2)],
)
def test_bar_counts(lake, interval, end, bars):
    rows = lake.bars("BTCUSDT", BASE_NS, BASE_NS + end, interval).collect()
    assert len(rows) == bars
    starts = [r.bar_start_ns for r in rows]
    assert starts == sorted(starts)
    assert all(r.high >= max(r.open, r.close) and r.low <= min(r.open, r.close) for r in rows)
    assert all(r.volume == pytest.approx(r["count"] * 0.1) for r in rows)


def test_bars_lose_no_volume(lake):
    day = lake.bars("BTCUSDT", *WHOLE, interval="1d").agg(F.sum("volume"), F.sum("count")).first()
    assert day[0] == pytest.approx(ROWS * 0.1)
    assert day[1] == ROWS


def test_bars_of_nothing(lake):
    assert lake.bars("NONE", *WHOLE).collect() == []
    with pytest.raises(ValueError, match="Invalid interval"):
        lake.bars("BTCUSDT", *WHOLE, interval="0s")


def test_small_bars_add_up_to_large_ones(lake):
    minutes = lake.bars("SOLUSDT", *WHOLE, interval="1m")
    hour = (F.col("bar_start_ns") - F.col("bar_start_ns") % HOUR_NS).alias("bar_start_ns")
    rolled = minutes.groupBy(hour).agg(
        F.min_by("open", "bar_start_ns").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_start_ns").alias("close"),
        F.sum("count").alias("count"),
    )
    hours = lake.bars("SOLUSDT", *WHOLE, interval="1h").drop("volume")
    assert rolled.exceptAll(hours).count() == 0
    assert hours.exceptAll(rolled).count() == 0


def test_equal_times_are_ordered_by_trade_id(spark):
    one = ticks_at(spark, [BASE_NS], price="5").withColumn("trade_id", F.lit("b"))
    two = ticks_at(spark, [BASE_NS], price="7").withColumn("trade_id", F.lit("a"))
    bar = market.bars_by_feed(one.unionByName(two), "1m", tie_break=True).first()
    assert (bar.open, bar.close) == (7.0, 5.0)


def test_exact_notional(spark):
    ticks = ticks_at(spark, [BASE_NS, BASE_NS + 1], price="67432.12345678", size="0.00000003")
    row = market.vwap_exact_parts(ticks).first()
    assert Decimal(row.notional) == 2 * Decimal("67432.12345678") * Decimal("0.00000003")
    assert Decimal(row.volume) == Decimal("0.00000006")


def test_doubles_are_the_nearest_ones(spark):
    texts = ["0.1", "67000.12345678", "67432.12345678901234", "0.00000000012345678", "0.000000000000000001",
             "99999999999999999999.999999999999999999", "12345678901.5", "9007199254740993", "45035996.27370497"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "t", "CAST(t AS DECIMAL(38,18)) AS price"
    )
    for row in rows.select("t", as_double("price").alias("d")).collect():
        assert row.d == float(row.t)


def test_minute_counts(spark):
    rows = market.minute_counts(with_gap(spark)).orderBy("minute_s").collect()
    assert sum(r.trade_count for r in rows) == 200
    assert {r.avg_price for r in rows} == {100.0}
    assert all(r.minute_s % 60 == 0 for r in rows)


def test_display_seconds(spark):
    bars = market.bars(with_gap(spark), "GAPUSDT", *WHOLE, interval="10s")
    shown = market.with_bar_seconds(bars)
    assert shown.columns == ["bar_start_s", *market.BAR_COLS[1:]]
    assert shown.first().bar_start_s == BASE_NS // 1_000_000_000


# -- gaps ----------------------------------------------------------------------------------------


def test_one_gap(lake):
    gap = lake.gaps("GAPUSDT", "test", 60).collect()
    assert [(g.gap_seconds, g.gap_end_ns - g.gap_start_ns) for g in gap] == [(300.0, 300 * 10**9)]
    assert lake.gaps("GAPUSDT", "test", 600).collect() == []
    assert lake.gaps("GAPUSDT", "test", 300).collect() == []  # strictly longer only
    assert lake.gaps("GAPUSDT", "test", 299.999999999).count() == 1
    assert lake.gaps("BTCUSDT", "binance", 60).collect() == []
    assert lake.gaps("BTCUSDT", "coinbase", 60).collect() == []


def test_negative_threshold_is_refused(spark):
    with pytest.raises(ValueError, match="negative"):
        market.gaps(with_gap(spark), -1)


def plain_gaps(times, threshold):
    ordered = sorted(times)
    return [(a, b) for a, b in zip(ordered, ordered[1:]) if b - a > threshold]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    times=st.lists(
        st.one_of(
            st.integers(BASE_NS, BASE_NS + 50),
            st.integers(BASE_NS, BASE_NS + 10**12),
            st.integers(-(10**18), 4 * 10**18),
        ),
        min_size=1,
        max_size=40,
    ),
    threshold=st.sampled_from([0, 1, 7, 1_000, 10**9, 60 * 10**9, 10**15]),
)
def test_gaps_equal_a_plain_scan(spark, times, threshold):
    found = market.gaps(ticks_at(spark, times), threshold / 1e9).collect()
    assert sorted((g.gap_start_ns, g.gap_end_ns) for g in found) == plain_gaps(times, threshold)


def test_small_blocks_find_the_same_gaps(spark, monkeypatch):
    """With few slots per block, most gaps lie between blocks of some level."""
    ticks = two_days(spark).where("symbol = 'ETHUSDT' AND pmod(hash(trade_id), 97) < 3")
    times = [r[0] for r in ticks.select("timestamp_ns").collect()]
    monkeypatch.setattr(market, "_FAN_OUT", 16)
    found = market.gaps(ticks, 30.0).collect()
    assert sorted((g.gap_start_ns, g.gap_end_ns) for g in found) == plain_gaps(times, 30 * 10**9)


def wide(rng, digits=(1, 5, 12, 20), places=(0, 2, 8, 9, 18)):
    whole, part = rng.choice(digits), rng.choice(places)
    return Decimal(rng.randrange(1, 10**whole)) + Decimal(rng.randrange(10**part)).scaleb(-part)


def test_exact_vwap_equals_python_decimals(spark):
    rng = random.Random(7)
    with localcontext(prec=300):
        rows = [("x", rng.choice("ABC"), wide(rng), wide(rng), "buy", rng.randrange(2**62), 1, str(i)) for i in range(600)]
        rows += [("x", "DAYS", Decimal("0.1") + i, Decimal("1E-18") * (i + 1), "buy", i * 40 * HOUR_NS, 1, "1") for i in range(50)]
        rows += [("x", "MINUS", -wide(rng), wide(rng), "sell", -5, 1, "1"), ("x", "NONE", Decimal(5), Decimal(0), "buy", 5, 1, "1")]
        rows += [("x", "EVEN", Decimal(1), Decimal(1), "buy", 0, 1, "1"), ("x", "EVEN", Decimal("1.000000000000000001"), Decimal(1), "buy", 0, 1, "2")]
        ticks = spark.createDataFrame(rows, TICK)
        found = {r.symbol: r for r in market.vwap_exact(ticks, *FEED).collect()}
        assert len(found) == 7
        for symbol, got in found.items():
            own = [r for r in rows if r[1] == symbol]
            notional, volume = sum(r[2] * r[3] for r in own), sum(r[3] for r in own)
            assert Decimal(got.notional) == notional and len(got.notional.split(".")[1]) == 36
            assert Decimal(got.volume) == volume and len(got.volume.split(".")[1]) == 18
            assert got.vwap == ((notional / volume).quantize(Decimal("1E-18")) if volume else None)


def test_exact_vwap_of_nothing_and_of_a_day(spark):
    none = spark.createDataFrame([], TICK)
    assert market.vwap_exact(none).collect() == market.vwap_exact(none, "symbol").collect() == []
    ticks = ticks_at(spark, [BASE_NS, BASE_NS + 30 * HOUR_NS])
    by_day = market.vwap_exact(ticks, "symbol", bar_start(24 * HOUR_NS)).collect()
    assert [r.volume for r in by_day] == ["1." + "0" * 18] * 2
    huge = ticks_at(spark, [BASE_NS] * 3, price="9" * 20 + "." + "9" * 18, size="9" * 20 + "." + "9" * 18)
    assert market.vwap_exact(huge).first().vwap == Decimal("9" * 20 + "." + "9" * 18)


def tied(spark):
    """Many trades of equal time, with ids of several kinds and prices that tell them apart."""
    rng = random.Random(3)
    ids = [str(i) for i in range(40)] + [f"t{i}" for i in range(20)] + ["007", "9" * 16, "9" * 17, "12345678901234567890", "é"]
    rows = [
        (exchange, symbol, Decimal(rng.randrange(1, 10**6)), Decimal(1), "buy", BASE_NS + minute * 60_000_000_000, 1, i)
        for exchange in ("a", "b") for symbol in ("X", "Y") for minute in range(3) for i in ids
    ]
    return spark.createDataFrame(rows, TICK), rows


def test_bars_of_tied_trades_do_not_depend_on_partitions(spark):
    ticks, rows = tied(spark)
    results = []
    for parts, seed in ((1, 0), (8, 1), (16, 2), (16, 3)):
        shuffled = ticks.repartition(parts, F.xxhash64("trade_id", F.lit(seed)))
        results.append(sorted(market.bars_by_feed(shuffled, "1m").collect()))
        pooled = market.bars(shuffled.withColumn("date", F.lit(date(2024, 5, 20))), "X", BASE_NS, BASE_NS + HOUR_NS)
        results.append(sorted(pooled.collect()))
    assert results[0] == results[2] == results[4] == results[6]
    assert results[1] == results[3] == results[5] == results[7]
    # The least number opens; what is no short number comes after all that are.
    first = next(r[2] for r in rows if r[:2] == ("a", "X") and r[7] == "0" and r[5] == BASE_NS)
    bar = next(b for b in results[0] if (b.exchange, b.symbol, b.bar_start_ns) == ("a", "X", BASE_NS))
    assert bar.open == float(first)


def test_bars_need_no_sort(spark):
    for rows in (market.bars_by_feed(tied(spark)[0], "1m"), market.vwap_exact(tied(spark)[0], *FEED)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_trades_are_ordered_by_time_then_number(spark):
    ids = ["0", "7", "10", "999", "9" * 16]
    rows = [("a", "X", Decimal(1), Decimal(1), "buy", t, 1, i) for t in (-5, 0, 5, 2**62) for i in ids]
    keys = spark.createDataFrame(rows, TICK).select(market.trade_order().alias("k")).collect()
    assert [r.k for r in keys] == sorted({r.k for r in keys})
    others = spark.createDataFrame([("a", "X", Decimal(1), Decimal(1), "buy", 5, 1, i) for i in ("x", "-1", " 7", "1" * 17, "")], TICK)
    later = [r.k for r in others.select(market.trade_order().alias("k")).collect()]
    assert len(set(later)) == 5 and min(later) > max(r.k for r in keys if r.k < 6 * 10**19)
