import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparktape import TickLake, append_ticks, read_ticks
from sparktape.functions.columns import safe_component, split_pair, tick_line
from sparktape.operators import market
from sparktape.schema import STORED_COLS, STORED_TICK
from sparktape.sources import lake, tables
from tests.data import BASE_NS, ticks_at

MIDNIGHT = 1_716_249_600_000_000_000


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tree")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_ticks_come_back(spark, sf_dir, root):
    ticks = tables.event_ticks(spark, sf_dir)
    append_ticks(ticks, root)
    back = read_ticks(spark, root)
    assert back.columns == STORED_COLS
    assert back.exceptAll(ticks).count() == ticks.exceptAll(back).count() == 0
    append_ticks(ticks, root)
    assert read_ticks(spark, root).count() == 2 * ticks.count()


def test_precise_decimals_survive(spark, root):
    one = ticks_at(spark, [BASE_NS], price="67432.12345678901234", size="0.00000000012345678")
    append_ticks(one, root)
    row = read_ticks(spark, root).first()
    assert (row.price, row.size) == (Decimal("67432.12345678901234"), Decimal("0.00000000012345678"))


def test_awkward_names_and_midnight(spark, root):
    parts = [ticks_at(spark, [MIDNIGHT - 600, MIDNIGHT], symbol=s) for s in ("A/B", "1000", "A_B", "ä b")]
    for part in parts:
        append_ticks(part, root)
    back = read_ticks(spark, root).groupBy("symbol", "date").count().collect()
    days = {datetime.date(2024, 5, 20), datetime.date(2024, 5, 21)}
    assert {(r.symbol, r.date) for r in back} == {(s, d) for s in ("A/B", "1000", "A_B", "ä b") for d in days}


def test_files_are_zstd_and_hold_the_schema(spark, root, tmp_path):
    append_ticks(ticks_at(spark, [BASE_NS, BASE_NS + 1]), root)
    (file,) = (tmp_path / "tree").rglob("*.parquet")
    assert file.parent.relative_to(root).as_posix() == "exchange=test/symbol=GAPUSDT/date=2024-05-20"
    assert ".zstd" in file.name
    import pyarrow.parquet as pq

    meta = pq.read_metadata(file).row_group(0).column(0)
    assert meta.compression == "ZSTD"
    assert meta.statistics is not None
    assert not list((tmp_path / "tree").rglob("*.tmp"))


def test_file_size_limit(spark, root):
    append_ticks(ticks_at(spark, list(range(BASE_NS, BASE_NS + 100))), root, max_records_per_file=30)
    sizes = sorted(r.n_rows for r in lake.file_inventory(spark, root).collect())
    assert sizes == [10, 30, 30, 30]
    totals = lake.inventory_totals(lake.file_inventory(spark, root)).first()
    assert (totals.n_files, totals.n_rows) == (4, 100)
    assert totals.n_bytes > 0


def test_one_busy_partition_is_split_over_tasks(spark, root):
    """A rebalance splits a partition too large for one task; its rows are all kept."""
    busy = spark.range(0, 200_000, 1, 16).selectExpr(
        "'x' AS exchange", "'HOT' AS symbol", "CAST(id AS DECIMAL(38,18)) AS price",
        "CAST(1 AS DECIMAL(38,18)) AS size", "'buy' AS side", f"{BASE_NS} + id AS timestamp_ns",
        f"{BASE_NS} + id AS received_ns", "uuid() AS trade_id",
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1m")
        append_ticks(busy, root)
    finally:
        spark.conf.set(key, before)
    files = lake.file_inventory(spark, root).collect()
    assert len(files) > 2
    assert sum(f.n_rows for f in files) == 200_000


def test_nothing_there_yet(spark, root, tmp_path):
    missing = read_ticks(spark, root)
    (tmp_path / "empty").mkdir()
    empty = read_ticks(spark, str(tmp_path / "empty"))
    for ticks in (missing, empty):
        assert ticks.columns == STORED_COLS
        assert [f.dataType for f in ticks.schema] == [f.dataType for f in STORED_TICK]
        assert ticks.count() == 0
    with TickLake(spark, root) as store:
        assert store.symbols() == []
        assert store.trades("X", 0, 10**18).count() == 0
        append_ticks(ticks_at(spark, [BASE_NS]), root)
        assert store.symbols() == ["test:GAPUSDT"]  # seen without reopening
    assert lake.file_inventory(spark, str(tmp_path / "none")).count() == 0


def test_unfinished_files_are_not_read(spark, root, tmp_path):
    append_ticks(ticks_at(spark, [BASE_NS]), root)
    (file,) = (tmp_path / "tree").rglob("*.parquet")
    (file.parent / "half.parquet.tmp").write_bytes(b"half")
    (file.parent / "copy.parquet.tmp").write_bytes(file.read_bytes())
    assert read_ticks(spark, root).count() == 1


def test_a_foreign_tree_with_a_day_off_by_one(spark, tmp_path):
    """Files may also hold exchange and symbol, and place a late tick on the next day."""
    part = tmp_path / "tree" / "exchange=test" / "symbol=GAPUSDT" / "date=2024-05-21"
    tick = ticks_at(spark, [MIDNIGHT - 600]).drop("date")
    tick.coalesce(1).write.parquet(str(part))
    with TickLake(spark, str(tmp_path / "tree")) as store:
        assert store.trades("GAPUSDT", "2024-05-20", "2024-05-21").count() == 1
        assert store.symbols() == ["test:GAPUSDT"]


def test_ranges_prune_partitions_and_columns(spark, sf_dir, root):
    append_ticks(tables.event_ticks(spark, sf_dir), root)
    rows = market.bars(read_ticks(spark, root), "VIEW", "2024-01-05", "2024-01-07", "1h", "binance")
    text = plan(rows)
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(name in filters for name in ("symbol", "exchange", "date"))
    assert "timestamp_ns" in scan.split("PushedFilters:")[1]
    # The id decides between trades of equal time.
    assert not any(name in scan.split("ReadSchema:")[1] for name in ("side", "received_ns"))
    assert "SortAggregate" not in text
    assert text.count("HashAggregate") == 2


def test_named_feeds_list_only_their_directories(spark, root):
    for symbol in ("A/B", "AB", "A_B"):
        append_ticks(ticks_at(spark, [MIDNIGHT - 600, MIDNIGHT], symbol=symbol), root)
        append_ticks(ticks_at(spark, [MIDNIGHT], exchange="other", symbol=symbol), root)
    everything = read_ticks(spark, root)
    for exchange, symbol in [("test", "AB"), (None, "A_B"), (None, "A/B"), ("test", "A/B"), ("other", None),
                             ("none", "AB"), (None, "A*")]:
        some = read_ticks(spark, root, exchange=exchange, symbol=symbol)
        want = everything.where(F.lit(exchange is None) | (F.col("exchange") == exchange)).where(
            F.lit(symbol is None) | (F.col("symbol") == symbol)
        )
        assert some.columns == STORED_COLS
        assert sorted(some.collect()) == sorted(want.collect())
    assert len(read_ticks(spark, root, exchange="test", symbol="AB").inputFiles()) == 2
    assert len(everything.inputFiles()) == 9


def test_symbols_read_no_data_column(spark, sf_dir, root):
    append_ticks(tables.event_ticks(spark, sf_dir), root)
    scan = next(l for l in plan(market.symbols(read_ticks(spark, root))).splitlines() if "FileScan" in l)
    assert scan.rstrip().endswith("ReadSchema: struct<>")


def test_single_partition_projection(spark, sf_dir, root):
    append_ticks(tables.event_ticks(spark, sf_dir), root)
    some = lake.read_partition(spark, root, "binance", "VIEW", "2024-01-03", ["timestamp_ns", "price"])
    assert some.columns == ["timestamp_ns", "price"]
    want = read_ticks(spark, root).where(
        "exchange = 'binance' AND symbol = 'VIEW' AND date = DATE'2024-01-03'"
    )
    assert some.count() == want.count() > 0


def test_sql_over_the_view(spark, sf_dir, root):
    append_ticks(tables.event_ticks(spark, sf_dir), root)
    store = TickLake(spark, root)
    query = "SELECT count(*) AS n FROM ticks WHERE symbol = :symbol"
    assert store.sql(query, symbol="VIEW").first().n == read_ticks(spark, root).where("symbol = 'VIEW'").count()
    store.close()
    store.close()
    with pytest.raises(ValueError, match="closed"):
        store.symbols()
    assert not spark.catalog.tableExists("ticks")


def test_layout_names_the_directories(spark, sf_dir, root, tmp_path):
    ticks = tables.event_ticks(spark, sf_dir)
    append_ticks(ticks, root)
    on_disk = {p.parent.relative_to(root).as_posix() for p in (tmp_path / "tree").rglob("*.parquet")}
    assert {r.partition for r in lake.partition_layout(ticks).collect()} == on_disk


def test_names_and_lines(spark):
    rows = spark.createDataFrame([("BTC/USDT:x é.b-c_1",)], "s string")
    assert rows.select(safe_component(F.col("s"))).first()[0] == "BTC_USDT_x_é.b-c_1"
    exchange, symbol = split_pair(F.lit("test:a:b"))
    assert tuple(rows.select(exchange, symbol).first()) == ("test", "a:b")
    line = ticks_at(spark, [BASE_NS], price="67000.50", size="0.005").select(tick_line()).first()[0]
    assert line == "[test    ] GAPUSDT    BUY               67000.5  ×  0.005               id=t0"


def test_feeds_come_from_paths(spark, tmp_path):
    ticks = ticks_at(spark, [1736899200000000000]).withColumn("symbol", F.lit("A/B 100%"))
    lake.append_ticks(ticks, str(tmp_path / "tree"))
    found = lake.tree_feeds(spark, str(tmp_path / "tree"), str(tmp_path / "none"))
    assert [symbol for _, symbol in found] == ["A/B 100%"]


def test_scratch_needs_a_shared_folder_off_this_machine(spark):
    from sparktape.session import _ONE_MACHINE

    assert all(_ONE_MACHINE.fullmatch(m) for m in ("local", "local[*]", "local[8, 2]"))
    assert not any(_ONE_MACHINE.fullmatch(m) for m in ("", "yarn", "local-cluster[3,2,1024]"))
