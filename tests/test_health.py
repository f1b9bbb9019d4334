import random

import pytest
from pyspark.sql import functions as F

from sparktape.operators import decode, health
from sparktape.schema import WRITE_LOG
from sparktape.sources import tables
from tests.data import BASE_NS, ticks_at

SECOND = 1_000_000_000


def write_log(spark, *latencies):
    rows = [(i, "x", "A", 10, v, BASE_NS + i * SECOND) for i, v in enumerate(latencies)]
    return spark.createDataFrame(rows, WRITE_LOG)


def test_every_frame_has_one_outcome(spark, sf_dir):
    frames = tables.event_frames(spark, sf_dir)
    decoded = decode.decode_frames(frames, tables.AS_OF_NS)
    outcomes = health.frame_outcomes(decoded).collect()
    received = {r.exchange: r.n_frames for r in health.received(frames).collect()}
    for exchange, n in received.items():
        assert sum(o.n_frames for o in outcomes if o.exchange == exchange) == n
    ticks = decode.frame_ticks(decoded)
    assert ticks.count() == sum(o.n_ticks for o in outcomes)
    assert sum(r.n_ticks for r in health.parsed(ticks).collect()) == ticks.count()


def test_histogram_is_cumulative(spark):
    rows = health.latency_histogram(write_log(spark, 0.0005, 0.001, 0.02, 0.3, 99.0)).collect()
    counts = {r.le: r.cumulative for r in rows}
    assert len(rows) == 13
    assert (counts["0.001"], counts["0.025"], counts["0.5"], counts["10"], counts["+Inf"]) == (2, 3, 4, 4, 5)
    assert {r.n_writes for r in rows} == {5}
    assert rows[0].total_s == pytest.approx(99.3215)


def test_quantiles_interpolate(spark):
    row = health.latency_quantiles(write_log(spark, *[0.03] * 50, *[0.07] * 50)).first()
    assert row.p50 == pytest.approx(0.05)  # the upper edge of its bucket
    assert row.p95 == pytest.approx(0.05 + 0.05 * 45 / 50)
    assert health.latency_quantiles(write_log(spark, 50.0)).first().p50 == 10.0
    first = health.latency_quantiles(write_log(spark, 0.0002, 0.0004)).first()
    assert first.p50 == pytest.approx(0.0005)
    assert health.latency_quantiles(write_log(spark)).first().p50 is None


def test_quantiles_per_window(spark):
    rows = health.latency_quantiles(write_log(spark, 0.03, 0.03, 5.0, 5.0), window_s=2)
    assert rows.count() == 2


def test_staleness_levels(spark):
    def level(age_s):
        ticks = ticks_at(spark, [BASE_NS - 5 * SECOND, BASE_NS])
        return health.staleness_level(ticks, BASE_NS + int(age_s * SECOND)).first()

    assert [level(s).level for s in (0, 29.9, 30, 119.9, 120)] == ["green", "green", "yellow", "yellow", "red"]
    assert level(30).age_s == 30.0


def test_rates(spark):
    minute = BASE_NS  # a whole minute
    ticks = ticks_at(spark, [minute, minute + SECOND, minute + 70 * SECOND])
    rows = health.rate(ticks, ["exchange"], "received_ns").collect()
    assert {(r.window_start_ns - minute, r.n) for r in rows} == {(0, 2), (60 * SECOND, 1)}
    assert {r.per_second for r in rows} == {2 / 60, 1 / 60}
    sliding = health.rate(ticks, ["exchange"], "received_ns", 120, 60).collect()
    assert {((r.window_start_ns - minute) // SECOND, r.n) for r in sliding} == {(-60, 2), (0, 3), (60, 1)}
    with pytest.raises(ValueError, match="multiple"):
        health.rate(ticks, [], "received_ns", 60, 7)


def test_summary_per_interval(spark):
    frames = spark.createDataFrame(
        [("binance", "{}", BASE_NS + i * SECOND // 4) for i in range(41)], "source string, raw string, received_ns long"
    )
    rows = {r.window_start_ns: r.msgs_per_sec for r in health.summary(frames).collect()}
    assert rows == {BASE_NS: 4.0, BASE_NS + 10 * SECOND: 0.1}


def test_counters(spark, sf_dir):
    decoded = decode.decode_frames(tables.event_frames(spark, sf_dir), tables.AS_OF_NS)
    log = write_log(spark, 0.1, 0.2)
    totals = {r.counter: r.total for r in health.totals(decoded, log).collect()}
    assert totals["received"] == decoded.count()
    assert totals["parse_errors"] == decoded.where("status = 'error'").count()
    assert totals["written"] == 20
    assert health.written(log).first().n_ticks == 20


def test_feed_latency(spark):
    ticks = ticks_at(spark, [BASE_NS, BASE_NS + 1, BASE_NS + 2]).withColumn(
        "received_ns", F.col("timestamp_ns") + F.expr("(timestamp_ns - %d) * 40000000 - 10000000" % BASE_NS)
    )
    row = health.feed_latency(ticks).first()
    assert (row.n_ticks, row.n_negative) == (3, 1)
    assert (row.min_s, row.max_s) == (-0.01, 0.07)
    assert row.p50 == pytest.approx(0.03)


def test_feed_latency_beyond_the_histogram(spark):
    """Quantiles of a feed a minute late, or half a second early, are those of its ticks."""
    times = [BASE_NS + i for i in range(101)]
    for shift in (60_000_000_000, -500_000_000):
        late = ticks_at(spark, times).withColumn("received_ns", F.col("timestamp_ns") + shift)
        for exact in (False, True):
            row = health.feed_latency(late, exact=exact).first()
            assert (row.p50, row.p99) == (pytest.approx(shift / 1e9), pytest.approx(shift / 1e9))


def test_no_feed_state_grows(spark):
    """Quantile state is a sketch of bounded size unless exact ones are asked for."""
    text = health.feed_latency(ticks_at(spark, [BASE_NS]))._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" in text
    assert "SortAggregate" not in text


def test_quantiles_of_the_values(spark):
    rng = random.Random(5)
    values = [rng.expovariate(3) for _ in range(1001)]
    log = spark.createDataFrame([("x", v) for v in values] + [("y", 0.5), ("z", None)], "exchange string, latency_s double")
    exact = {r.exchange: r for r in health.latency_quantiles_of_values(log, "exchange").collect()}
    ordered = sorted(values)
    assert exact["x"].p50 == ordered[500] and exact["x"].p95 == pytest.approx(ordered[950]) and exact["x"].n_writes == 1001
    assert exact["y"].p99 == 0.5 and exact["z"].p50 is None and exact["z"].n_writes == 0
    near = {r.exchange: r for r in health.latency_quantiles_of_values(log, "exchange", accuracy=100).collect()}
    rank = sum(v <= near["x"].p95 for v in values) / len(values)
    assert abs(rank - 0.95) <= 0.011


def test_sketches_of_panes_merge_to_any_range(spark):
    """Ranks stay within the stated error, however many panes are merged, whatever order."""
    rows = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS feed", "id * 1000000000 AS at_ns",
        "exp(pmod(xxhash64(id), 1000003) / 125000) AS seconds",
    )
    sketches = health.latency_sketches(rows, F.col("seconds"), "at_ns", "feed")
    assert sketches.count() == 2 * 5_000
    assert sketches.agg(F.max(F.octet_length("sketch"))).first()[0] < 50_000
    start, end = 60_000 * 10**9, 240_000 * 10**9
    found = {r.feed: r for r in health.sketch_quantiles(sketches, "feed", start_ns=start, end_ns=end).collect()}
    inside = rows.where(F.col("at_ns").between(start, end - 1))
    for feed, got in found.items():
        values = [r.seconds for r in inside.where(F.col("feed") == feed).collect()]
        assert got.n == len(values)
        for name, q in health.QUANTILES.items():
            rank = sum(v <= got[name] for v in values) / len(values)
            assert abs(rank - q) <= health.SKETCH_RANK_ERROR
    whole = health.sketch_quantiles(sketches).first()
    assert whole.n == 300_000
    none = health.latency_sketches(rows.limit(0), F.col("seconds"), "at_ns", "feed")
    assert health.sketch_quantiles(none, "feed").collect() == []
