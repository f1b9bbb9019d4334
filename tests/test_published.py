"""Published trees: whole commits, a manifest instead of listings, a write log, compaction."""

from __future__ import annotations

import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparktape import TickLake, append_ticks, read_ticks
from sparktape.operators import decode, health, market
from sparktape.schema import FILE_ENTRY, STORED_COLS
from sparktape.sources import frames as sources
from sparktape.sources import lake, published, snapshots, tables
from sparktape.streaming import ticks as streams
from tests.data import BASE_NS, ticks_at

DAY = 86_400_000_000_000


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "tree")
    published.create_published(spark, path)
    return path


def listed(root):
    return {str(p.relative_to(root)): p.stat().st_size for p in (Path(root) / "data").rglob("*.parquet")}


# -- snapshots --------------------------------------------------------------------------------


def test_nothing_is_published_at_first(spark, tmp_path):
    assert snapshots.latest(spark, str(tmp_path / "none")) is None
    assert not published.is_published(spark, str(tmp_path))
    assert read_ticks(spark, str(tmp_path / "none")).count() == 0


def test_writers_at_once_lose_nothing(spark, root):
    def add(k):
        for i in range(5):
            snapshots.advance(spark, root, lambda now: now.with_folder("t", f"{k}-{i}"))

    threads = [threading.Thread(target=add, args=(k,)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    now = snapshots.latest(spark, root)
    assert sorted(now.folders("t")) == sorted(f"{k}-{i}" for k in range(3) for i in range(5))
    assert now.version == 16


def test_a_taken_number_is_not_overwritten(spark, root):
    now = snapshots.latest(spark, root)
    mine = now._replace(version=now.version + 1).with_fence("a", 1)
    assert snapshots._create(spark, root, mine)
    assert not snapshots._create(spark, root, mine.with_fence("a", 2))
    assert snapshots.latest(spark, root).fences == {"a": 1}
    assert not list(Path(root).rglob("*.tmp"))


def test_old_snapshots_go(spark, root):
    for i in range(snapshots._KEPT + 5):
        snapshots.advance(spark, root, lambda now: now.with_fence("x", i))
    assert len(snapshots._versions(spark, root)) == snapshots._KEPT
    assert snapshots.latest(spark, root).fences == {"x": i}


def test_folds_keep_rows_and_later_folders(spark, root, monkeypatch):
    for i in range(4):
        spark.range(i, i + 1).write.parquet(f"{root}/t/{i}")
        snapshots.advance(spark, root, lambda now: now.with_folder("t", str(i)))
    schema = spark.range(1).schema
    create = snapshots._create

    def beside(spark_, root_, snapshot):
        monkeypatch.setattr(snapshots, "_create", create)
        snapshots.advance(spark_, root_, lambda now: now.with_folder("t", "late"))
        return create(spark_, root_, snapshot)

    spark.range(9, 10).write.parquet(f"{root}/t/late")
    monkeypatch.setattr(snapshots, "_create", beside)
    snapshots.fold(spark, root, "t", schema)
    folders = snapshots.latest(spark, root).folders("t")
    assert len(folders) == 2 and folders[1] == "late"
    rows = snapshots.read_folders(spark, root, "t", schema).collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3, 9]
    snapshots.fold(spark, root, "t", schema, above=2)
    assert snapshots.latest(spark, root).folders("t") == folders


# -- commits ----------------------------------------------------------------------------------


def test_published_ticks_come_back(spark, sf_dir, root):
    ticks = tables.event_ticks(spark, sf_dir)
    append_ticks(ticks, root)
    back = read_ticks(spark, root)
    assert back.columns == STORED_COLS
    assert same(back, ticks)
    inventory = {r.path.removeprefix(f"{root}/"): r.n_bytes for r in lake.file_inventory(spark, root).collect()}
    assert inventory == listed(root)
    append_ticks(ticks.limit(0), root)
    assert same(read_ticks(spark, root), ticks)


def test_awkward_names(spark, root):
    names = ["A/B", "1000", "A_B", "ä b", "a+b", "x%2By", "s=t", "*[q]"]
    for name in names:
        append_ticks(ticks_at(spark, [BASE_NS], symbol=name), root)
    assert sorted(r.symbol for r in read_ticks(spark, root).collect()) == sorted(names)
    for name in names:
        assert read_ticks(spark, root, symbol=name).count() == 1
    assert {s for _, s in lake.tree_feeds(spark, root)} == set(names)


@pytest.mark.parametrize("step", ["write_partitions", "_write_small", "advance"])
def test_a_failed_commit_shows_nothing(spark, root, monkeypatch, step):
    append_ticks(ticks_at(spark, [BASE_NS]), root)
    before = snapshots.latest(spark, root)
    plain = getattr(published, step)

    def fails(*args, **options):
        if step != "advance":
            plain(*args, **options)  # the files are there
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(published, step, fails)
        with pytest.raises(OSError, match="lost"):
            append_ticks(ticks_at(spark, [BASE_NS + 1]), root)
    assert len(listed(root)) == 2
    assert snapshots.latest(spark, root) == before
    assert [r.timestamp_ns for r in read_ticks(spark, root).collect()] == [BASE_NS]
    assert published.write_log(spark, root).count() == 1


def test_readers_during_a_commit_see_all_or_nothing(spark, root, monkeypatch):
    ticks = ticks_at(spark, [BASE_NS + k * DAY for k in range(6)])
    seen = []
    for name in ("write_partitions", "_write_small", "_entries"):
        plain = getattr(published, name)

        def watched(*args, plain=plain, **options):
            seen.append(read_ticks(spark, root).count())
            out = plain(*args, **options)
            seen.append(read_ticks(spark, root).count())
            return out

        monkeypatch.setattr(published, name, watched)
    append_ticks(ticks, root)
    assert set(seen) == {0} and len(seen) >= 6
    assert read_ticks(spark, root).count() == 6


def test_a_batch_counts_once(spark, root):
    for _ in range(2):
        published.publish_ticks(ticks_at(spark, [BASE_NS]), root, commit="s-7", fence=("s", 7))
    assert read_ticks(spark, root).count() == 1
    assert published.write_log(spark, root).count() == published.batch_log(spark, root).count() == 1


# -- pruning ----------------------------------------------------------------------------------


def test_ranges_read_only_their_files(spark, root):
    times = [BASE_NS + k * DAY for k in range(5)]
    append_ticks(ticks_at(spark, times), root)
    append_ticks(ticks_at(spark, times, symbol="OTHER"), root)
    some = read_ticks(spark, root, symbol="GAPUSDT", start=times[1], end=times[3])
    assert len(some.inputFiles()) == 2
    assert sorted(r.timestamp_ns for r in some.collect()) == times[1:3]
    assert read_ticks(spark, root, start=times[4] + 1).count() == 0
    with TickLake(spark, root, own_layout=True) as store:
        assert store.trades("GAPUSDT", times[1], times[3]).count() == 2
        assert store.symbols() == ["test:GAPUSDT", "test:OTHER"]


def test_a_wide_manifest_is_asked_and_not_listed(spark, root):
    """Of 100 000 partitions only the one that holds the range is looked at: the others do not
    even exist on disk."""
    append_ticks(ticks_at(spark, [BASE_NS]), root)
    wide = spark.range(100_000).selectExpr(
        "concat('data/commit=gone/exchange=test/symbol=S', id % 1000, '/date=2020-01-01/', id, '.parquet') AS path",
        "'test' AS exchange", "concat('S', id % 1000) AS symbol", "DATE'2020-01-01' AS date", "1L AS n_rows",
        "100L AS n_bytes", "id AS min_ns", "id + 10 AS max_ns", "false AS removed",
    )
    wide.select(*FILE_ENTRY.fieldNames()).write.parquet(f"{root}/files/wide")
    snapshots.advance(spark, root, lambda now: now.with_folder("files", "wide"))
    assert read_ticks(spark, root, exchange="test", symbol="GAPUSDT").count() == 1
    assert read_ticks(spark, root, start=BASE_NS, end=BASE_NS + 1).count() == 1
    assert len(lake.tree_feeds(spark, root)) == 1001
    assert lake.file_inventory(spark, root).count() == 100_001


# -- compaction -------------------------------------------------------------------------------


def test_compaction_keeps_rows(spark, root):
    for k in range(6):
        append_ticks(ticks_at(spark, [BASE_NS + k, BASE_NS + DAY + k]), root)
    append_ticks(ticks_at(spark, [BASE_NS], symbol="ONE/FILE"), root)
    before = read_ticks(spark, root).collect()
    old = snapshots.latest(spark, root)
    assert published.compact(spark, root) == 12
    assert sorted(read_ticks(spark, root).collect()) == sorted(before)
    assert published.live_files(spark, root).count() == 3
    # A reader that began earlier goes on with the files it knows.
    assert published.read_published(spark, root, old).count() == len(before)
    assert published.compact(spark, root) == 0
    # What was written stays written.
    assert published.write_log(spark, root).agg(F.sum("n_ticks")).first()[0] == len(before)


def test_compaction_bounds_the_size_of_files(spark, root):
    for k in range(8):
        append_ticks(ticks_at(spark, [BASE_NS + 1000 * k + i for i in range(200)]), root)
    size = published.live_files(spark, root).agg(F.max("n_bytes")).first()[0]
    published.compact(spark, root, target_bytes=3 * size, small_bytes=size + 1)
    files = published.live_files(spark, root).collect()
    assert sum(f.n_rows for f in files) == 1600
    assert 2 <= len(files) <= 4 and max(f.n_rows for f in files) <= 800
    assert published.compact(spark, root, target_bytes=10, symbol="NONE") == 0


def test_compaction_beside_a_writer(spark, root, monkeypatch):
    for k in range(3):
        append_ticks(ticks_at(spark, [BASE_NS + k]), root)
    advance = published.advance

    def beside(spark_, root_, change):
        monkeypatch.setattr(published, "advance", advance)
        append_ticks(ticks_at(spark, [BASE_NS + 99]), root)
        return advance(spark_, root_, change)

    monkeypatch.setattr(published, "advance", beside)
    published.compact(spark, root)
    assert sorted(r.timestamp_ns - BASE_NS for r in read_ticks(spark, root).collect()) == [0, 1, 2, 99]


def test_of_two_compactions_one_gives_way(spark, root, monkeypatch):
    for k in range(3):
        append_ticks(ticks_at(spark, [BASE_NS + k]), root)
    advance = published.advance

    def beside(spark_, root_, change):
        monkeypatch.setattr(published, "advance", advance)
        published.compact(spark, root)
        return advance(spark_, root_, change)

    monkeypatch.setattr(published, "advance", beside)
    with pytest.raises(snapshots.Conflict):
        published.compact(spark, root)
    assert read_ticks(spark, root).count() == 3
    assert published.live_files(spark, root).count() == 1


def test_many_commits_fold_their_manifests(spark, root, monkeypatch):
    monkeypatch.setattr(published, "FOLD_ABOVE", 3)
    for k in range(6):
        append_ticks(ticks_at(spark, [BASE_NS + k]), root)
        if k == 3:
            published.compact(spark, root)
    now = snapshots.latest(spark, root)
    assert all(len(now.folders(t)) <= 4 for t in ("files", "writes", "batches"))
    assert read_ticks(spark, root).count() == 6
    assert published.write_log(spark, root).count() == 6


# -- streams ----------------------------------------------------------------------------------


@pytest.fixture
def landing(spark, sf_dir, tmp_path):
    path = str(tmp_path / "landing")
    tables.event_frames(spark, sf_dir).repartition(4).write.parquet(path)
    return path


def test_write_log_over_two_runs(spark, sf_dir, landing, tmp_path):
    root = str(tmp_path / "tree")
    for turn in range(2):
        frames = sources.stream_frames(spark, landing, max_files_per_trigger=2)
        query = streams.publish_tick_stream(frames, root, available_now=True)
        query.awaitTermination()
        assert query.exception() is None
        if not turn:
            tables.event_frames(spark, sf_dir).coalesce(1).write.mode("append").parquet(landing)
    decoded = decode.decode_frames(sources.read_frames(spark, landing))
    ticks = decode.frame_ticks(decoded)
    assert same(read_ticks(spark, root), ticks)
    log = published.write_log(spark, root)
    assert same(health.written(log), health.parsed(ticks))
    assert log.groupBy("batch_id", "exchange", "symbol").count().where("count > 1").count() == 0
    assert all(r.latency_s > 0 and r.at_ns > BASE_NS for r in log.collect())
    assert health.latency_histogram(log).where("le = '+Inf'").first().cumulative == log.count()
    row = streams.published_summary(spark, root).first()
    assert (row.n_batches, row.n_frames, row.n_ticks) == (3, decoded.count(), ticks.count())
    assert row.n_errors == decoded.where("status = 'error'").count()
    assert row.files_written == len(listed(root)) and row.msgs_per_sec > 0


def test_a_batch_that_failed_after_its_commit_is_not_repeated(spark, landing, tmp_path, monkeypatch):
    root = str(tmp_path / "tree")
    publish = published.publish_ticks

    def dies(*args, **options):
        publish(*args, **options)
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(published, "publish_ticks", dies)
        query = streams.publish_tick_stream(sources.stream_frames(spark, landing), root, available_now=True)
        with pytest.raises(Exception, match="driver lost"):
            query.awaitTermination()
    streams.publish_tick_stream(sources.stream_frames(spark, landing), root, available_now=True).awaitTermination()
    ticks = decode.frame_ticks(decode.decode_frames(sources.read_frames(spark, landing)))
    assert same(read_ticks(spark, root), ticks)
    assert published.batch_log(spark, root).count() == 1


def test_another_checkpoint_is_refused(spark, landing, tmp_path):
    root = str(tmp_path / "tree")
    frames = sources.stream_frames(spark, landing, max_files_per_trigger=1)
    streams.publish_tick_stream(frames, root, available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="ahead of the checkpoint"):
        streams.publish_tick_stream(frames, root, str(tmp_path / "new"))
    second = streams.publish_tick_stream(frames, root, str(tmp_path / "new"), name="copy", available_now=True)
    second.awaitTermination()
    ids = market.symbols(read_ticks(spark, root)).count()
    assert ids and read_ticks(spark, root).groupBy(*STORED_COLS).count().where("count % 2 = 1").count() == 0


def test_short_logs_are_refused(spark, landing, tmp_path, monkeypatch):
    frames = sources.stream_frames(spark, landing, max_files_per_trigger=1)
    root = str(tmp_path / "tree")
    first = streams.write_tick_stream(streams.tick_stream(frames), root, available_now=True)
    first.awaitTermination()
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with pytest.raises(ValueError, match="only the last 2"):
            streams.progress_log(spark, first)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    read = sources.read_frames(spark, landing)
    read.limit(5).write.mode("append").parquet(landing)
    again = streams.write_tick_stream(streams.tick_stream(frames), root, available_now=True)
    again.awaitTermination()
    with pytest.raises(ValueError, match="earlier run"):
        streams.run_summary(again, lake.file_inventory(spark, root))
