import pathlib
import time

import pytest
from pyspark.sql import functions as F

from sparktape import append_ticks, read_ticks
from sparktape.operators import decode, market
from sparktape.plans import queries
from sparktape.schema import FEED, STORED_COLS, STORED_TICK, TICK
from sparktape.sources import frames as sources
from sparktape.sources import lake, snapshots, tables
from sparktape.streaming import events, ticks as streams
from tests.data import BASE_NS, ticks_at, with_gap

SECOND = 1_000_000_000


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture
def landing(spark, sf_dir, tmp_path):
    path = str(tmp_path / "landing")
    tables.event_frames(spark, sf_dir).repartition(6).write.parquet(path)
    return path


def test_stream_equals_batch(spark, landing, tmp_path):
    root = str(tmp_path / "tree")
    stream = streams.tick_stream(sources.stream_frames(spark, landing))
    query = streams.write_tick_stream(stream, root, str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    batch = decode.frame_ticks(decode.decode_frames(sources.read_frames(spark, landing)))
    assert same(read_ticks(spark, root), batch)
    log = streams.progress_log(spark, query).collect()
    assert sum(r.n_ticks for r in log) == batch.count()
    assert all(r.latency_s >= 0 and r.at_ns > BASE_NS for r in log)
    summary = streams.run_summary(query, lake.file_inventory(spark, root)).first()
    assert (summary.n_ticks, summary.n_frames) == (batch.count(), sources.read_frames(spark, landing).count())
    assert summary.files_written == len(list((tmp_path / "tree").rglob("*.parquet")))


def test_two_feeds_become_one_stream(spark, sf_dir, tmp_path):
    feeds = []
    for name in ("binance", "coinbase"):
        path = str(tmp_path / name)
        tables.event_frames(spark, sf_dir).where(F.col("source") == name).write.json(path)
        feeds.append(sources.stream_frames(spark, path, "json"))
    root = str(tmp_path / "tree")
    merged = streams.tick_stream(sources.merge_feeds(*feeds))
    streams.write_tick_stream(merged, root, str(tmp_path / "ck"), available_now=True).awaitTermination()
    ids = read_ticks(spark, root).groupBy("exchange", "trade_id").count()
    assert ids.where("count > 1").count() == 0
    assert {r.exchange for r in ids.select("exchange").distinct().collect()} == {"binance", "coinbase"}
    with pytest.raises(ValueError, match="At least one feed"):
        sources.merge_feeds()


def test_stop_and_restart_loses_and_doubles_nothing(spark, landing, tmp_path):
    root, checkpoint = str(tmp_path / "tree"), str(tmp_path / "ck")
    frames = sources.stream_frames(spark, landing, max_files_per_trigger=1)
    first = streams.write_tick_stream(streams.tick_stream(frames), root, checkpoint, flush_interval="0 seconds")
    while not first.recentProgress:
        first.awaitTermination(0.2)
    first.stop()  # in the middle
    again = streams.write_tick_stream(streams.tick_stream(frames), root, checkpoint, flush_interval="0 seconds")
    streams.drain(again)
    batch = decode.frame_ticks(decode.decode_frames(sources.read_frames(spark, landing)))
    assert same(read_ticks(spark, root), batch)


def test_errors_stream_too(spark, landing, tmp_path):
    failed = decode.frame_errors(decode.decode_frames(sources.stream_frames(spark, landing)))
    out = run_to(failed, str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = decode.frame_errors(decode.decode_frames(sources.read_frames(spark, landing)))
    assert same(out, batch)
    assert out.count() > 0


def test_console_lines(spark, landing):
    stream = streams.tick_stream(sources.stream_frames(spark, landing))
    query = streams.print_tick_stream(stream, available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    assert query.lastProgress.numInputRows > 0


def test_flush_by_size(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "tree")
    append_ticks(ticks_at(spark, list(range(BASE_NS, BASE_NS + 50))), source)
    stream = spark.readStream.schema(STORED_TICK).parquet(source).select(*STORED_COLS)
    streams.write_tick_stream(
        stream, root, str(tmp_path / "ck"), available_now=True, max_records_per_file=20
    ).awaitTermination()
    assert sorted(r.n_rows for r in lake.file_inventory(spark, root).collect()) == [10, 20, 20]


def test_a_stream_tree_takes_no_batch_append(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "tree")
    append_ticks(ticks_at(spark, [BASE_NS]), source)
    stream = spark.readStream.schema(STORED_TICK).parquet(source).select(*STORED_COLS)
    streams.write_tick_stream(stream, root, str(tmp_path / "ck"), available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="written by a stream"):
        append_ticks(ticks_at(spark, [BASE_NS + 1]), root)
    assert read_ticks(spark, source, root).count() == 2


def test_uncommitted_stream_files_are_not_read(spark, tmp_path):
    source, root = str(tmp_path / "in"), tmp_path / "tree"
    append_ticks(ticks_at(spark, [BASE_NS]), source)
    stream = spark.readStream.schema(STORED_TICK).parquet(source).select(*STORED_COLS)
    streams.write_tick_stream(stream, str(root), str(tmp_path / "ck"), available_now=True).awaitTermination()
    (file,) = root.rglob("*.parquet")
    (file.parent / "part-left-behind.zstd.parquet").write_bytes(file.read_bytes())
    assert read_ticks(spark, str(root)).count() == 1
    assert read_ticks(spark, str(root), exchange="test", symbol="GAPUSDT").count() == 1


def run_to(rows, path, checkpoint):
    query = (
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def in_steps(spark, tmp_path, build, *steps):
    """Feed ticks to a stream in steps, one file and one run each, and read its output."""
    source = str(tmp_path / "in")
    for times in steps:
        append_ticks(ticks_at(spark, times), source)
        stream = spark.readStream.schema(STORED_TICK).parquet(source).select(*STORED_COLS)
        out = run_to(build(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    return out


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    minutes = [BASE_NS + i * 7 * SECOND for i in range(100)]
    far = BASE_NS + 3_600 * SECOND
    bars = in_steps(
        spark, tmp_path, lambda t: events.stream_bars(t, "1m", "30 seconds"),
        minutes[50:], minutes[:50][::-1], [far], [far + 1],
    )
    # The second step is older than the watermark left by the first, except its last part.
    batch = market.bars_by_feed(ticks_at(spark, minutes), "1m")
    seen = {r.bar_start_ns: r for r in bars.collect()}
    want = {r.bar_start_ns: r for r in batch.collect()}
    on_time = {start for start in want if start >= minutes[50]}
    assert on_time <= set(seen)
    assert all(seen[s].asDict() == want[s].asDict() for s in on_time)
    assert far not in seen


def test_streamed_gaps_equal_batch_gaps(spark, tmp_path):
    second = [t.timestamp_ns for t in with_gap(spark).select("timestamp_ns").collect()]
    exact = [second[-1] + 60 * SECOND, second[-1] + 120 * SECOND + 1, second[-1] + 4_000 * SECOND]
    end = exact[-1] + 10_000 * SECOND
    times = second + exact
    early, late = times[0:150:2] + times[150:], times[1:150:2]
    gaps = in_steps(
        spark, tmp_path, lambda t: events.stream_gaps(t, 60.0, "2 hours"), early, late, [end], [end + SECOND]
    )
    batch = market.gaps(ticks_at(spark, [*times, end]), 60.0)
    found = {(r.gap_start_ns, r.gap_end_ns, r.gap_seconds) for r in gaps.collect()}
    want = {(r.gap_start_ns, r.gap_end_ns, r.gap_seconds) for r in batch.collect() if r.gap_end_ns < end}
    assert found == want
    assert len(found) == 3
    assert gaps.columns[:2] == FEED


def test_streamed_gaps_of_one_busy_feed(spark, tmp_path):
    """Nearly all ticks are of one feed; its slots, not its ticks, reach the feed's state."""
    source = str(tmp_path / "in")
    rows = spark.range(60_000).selectExpr(
        "'x' AS exchange", "CASE WHEN id % 10 = 0 THEN concat('S', id % 70) ELSE 'HOT' END AS symbol",
        "CAST(1 AS DECIMAL(38,18)) AS price", "CAST(1 AS DECIMAL(38,18)) AS size", "'buy' AS side",
        f"{BASE_NS} + id * 100000000 + IF(id % 9000 > 8000, 90000000000, 0) AS timestamp_ns",
        f"{BASE_NS} AS received_ns", "CAST(id AS STRING) AS trade_id",
    )
    rows.repartition(8).write.parquet(source)
    end = BASE_NS + 10**14
    closing = rows.groupBy("exchange", "symbol").agg(*(F.first(c).alias(c) for c in rows.columns[2:]))
    closing.withColumn("timestamp_ns", F.lit(end)).select(*rows.columns).write.mode("append").parquet(source)
    stream = spark.readStream.schema(TICK).parquet(source)
    out = run_to(events.stream_gaps(stream, 20.0, "1 minute"), str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = market.gaps(rows, 20.0)
    assert same(out.where(F.col("gap_end_ns") < end), batch)
    assert batch.count() > 5
    plan = events.stream_gaps(stream, 20.0)._jdf.queryExecution().analyzed().toString()
    assert plan.index("TransformWithState") < plan.index("Aggregate")
    with pytest.raises(ValueError, match="microsecond"):
        events.stream_gaps(stream, 1e-7)


def test_late_ticks_correct_their_bars(spark, tmp_path):
    """Steps come in any order, one twice as late as the other; no tick is too late."""
    source, root = str(tmp_path / "in"), str(tmp_path / "bars")
    times = [BASE_NS + i * 7 * SECOND for i in range(200)]
    ticks = ticks_at(spark, times).withColumn("price", (F.col("timestamp_ns") % 977).cast("decimal(38,18)"))
    seen = []
    for k in (3, 0, 2, 1):
        ticks.where(F.col("timestamp_ns") / SECOND % 4 == k).select(*STORED_COLS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(STORED_TICK).parquet(source)
        events.publish_bars(stream, root, "1m", available_now=True).awaitTermination()
        seen.append({r.bar_start_ns: r for r in events.corrected_bars(spark, root, "1m").collect()})
    assert same(events.corrected_bars(spark, root, "1m"), market.bars_by_feed(ticks, "1m"))
    assert any(seen[0][s] != seen[3][s] for s in seen[0])
    with pytest.raises(ValueError, match="ahead of the checkpoint"):
        events.publish_bars(stream, root, "1m", str(tmp_path / "other"), available_now=True)


def test_a_bar_batch_counts_once_and_parts_fold(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "in"), str(tmp_path / "bars")
    monkeypatch.setattr(events, "_FOLD_ABOVE", 2)
    advance = events.advance

    def dies(*args):
        advance(*args)
        raise OSError("driver lost")

    for k in range(5):
        append_ticks(ticks_at(spark, [BASE_NS + k]), source)
        stream = spark.readStream.schema(STORED_TICK).parquet(source)
        if k == 3:
            query = events.publish_bars(stream, root, "1m", available_now=True)
            with monkeypatch.context() as m:
                m.setattr(events, "advance", dies)
                with pytest.raises(Exception, match="driver lost"):
                    query.awaitTermination()
        events.publish_bars(stream, root, "1m", available_now=True).awaitTermination()
    assert [r["count"] for r in events.corrected_bars(spark, root, "1m").collect()] == [5]
    assert len(snapshots.latest(spark, root).folders("bars-1m")) <= 3


def test_a_silent_feed_is_noticed_without_data(spark, tmp_path):
    source, out = str(tmp_path / "in"), []
    append_ticks(ticks_at(spark, [BASE_NS], symbol="QUIET"), source)
    append_ticks(ticks_at(spark, [BASE_NS], symbol="LIVELY"), source)
    stream = spark.readStream.schema(STORED_TICK).parquet(source)

    def keep(batch, batch_id):
        out.extend((r.symbol, r.level, r.at_ms - r.since_ms) for r in batch.collect())

    query = (
        events.stream_staleness(stream, 8.0, 20.0).writeStream.foreachBatch(keep).outputMode("update")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="200 milliseconds").start()
    )
    try:
        started = time.time()
        while time.time() - started < 120 and ("QUIET", "red") not in {o[:2] for o in out}:
            assert query.exception() is None
            time.sleep(1)
            append_ticks(ticks_at(spark, [BASE_NS], symbol="LIVELY"), source)
    finally:
        query.stop()
    quiet = [o for o in out if o[0] == "QUIET"]
    # A trigger that takes longer than from one level to the next skips the first.
    assert [o[1] for o in quiet] in (["green", "yellow", "red"], ["green", "red"])
    assert all(age >= {"green": 0, "yellow": 8_000, "red": 20_000}[level] for _, level, age in quiet)
    assert [o[1] for o in out if o[0] == "LIVELY"][-1] == "green"
    assert "red" not in {o[1] for o in out if o[0] == "LIVELY"}


def test_stream_refuses_what_would_lose_ticks(spark, tmp_path):
    from tests.data import ticks_at

    ticks = ticks_at(spark, [1736899200000000000 + i for i in range(20)])
    batch = str(tmp_path / "batch")
    lake.append_ticks(ticks, batch)
    source = spark.readStream.schema(STORED_TICK).parquet(f"{batch}").select(*STORED_COLS)
    with pytest.raises(ValueError, match="batch writes"):
        streams.write_tick_stream(source, batch, available_now=True)
    root = str(tmp_path / "stream")
    streams.write_tick_stream(source, root, available_now=True).awaitTermination()
    assert lake.read_ticks(spark, root).count() == 20
    lake.append_ticks(ticks, batch)
    streams.write_tick_stream(source, root, available_now=True).awaitTermination()
    assert lake.read_ticks(spark, root).count() == 40
    with pytest.raises(ValueError, match="ahead of the checkpoint"):
        streams.write_tick_stream(source, root, str(tmp_path / "other"), available_now=True)


@pytest.mark.parametrize("name", ["stream_published", "stream_restart", "stream_drain", "stream_corrected_bars"])
def test_landed_files_grow_with_the_input(spark, tmp_path, monkeypatch, name):
    """Not one or two files a turn, whatever their size; a turn has two batches at most."""
    rows = spark.range(80).selectExpr(
        "id AS event_id", "timestamp_millis(1704412800000 + id * 3600000) AS ts", "id % 2 AS user_id",
        "'view' AS event_type", "id / 4 AS value", """concat('{"k": ', id, '}') AS props""",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "in" / "events.parquet"))
    made = []

    def scratch(_, folder):
        made.append(str(tmp_path / f"{folder}-{len(made)}"))
        return made[-1]

    monkeypatch.setattr(queries, "scratch_dir", scratch)
    monkeypatch.setattr(queries, "LANDED_ROWS", 10, raising=False)
    found = queries.all_queries()[name](spark, str(tmp_path / "in"))
    landing = next(path for path in made if pathlib.Path(path).name.startswith(("landing", "late-ticks")))
    counts = [spark.read.parquet(str(f)).count() for f in pathlib.Path(landing).glob("*.parquet")]
    assert sum(counts) == 80 and len(counts) >= 8 and max(counts) <= 20
    if name == "stream_corrected_bars":
        want = queries.all_queries()["bars_1h"](spark, str(tmp_path / "in"))
        assert found.count() == want.count()
    else:
        ticks = tables.event_frames(spark, str(tmp_path / "in"))
        want = queries.portable(decode.frame_ticks(decode.decode_frames(ticks, tables.AS_OF_NS)))
        assert sorted(found.collect()) == sorted(want.collect())
