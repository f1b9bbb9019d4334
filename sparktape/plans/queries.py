"""Every operator as a query over the test tables; `oracles.py` has the same in SQL.

Results carry decimals and dates as text, so that engines compare them by value.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable
from datetime import UTC, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns
from ..functions.timeargs import parse_interval, to_ns
from ..operators import decode, health, market, validate
from ..sources import frames as frame_sources
from ..sources import lake, published, tables
from ..schema import MONEY, STORED_COLS, STORED_TICK
from ..session import scratch_dir
from ..streaming import events as stream_events
from ..streaming import ticks as stream_ticks
from .store import TickLake

Query = Callable[[SparkSession, str], DataFrame]

# Arguments shared with the SQL.
SYMBOL, EXCHANGE = "VIEW", "binance"
START, END = "2024-01-05T06:30:00Z", "2024-01-20T12:00:00Z"
WHOLE = ("2024-01-01", "2024-02-01")
DAY = "2024-01-15"
GAP_SECONDS = 7_200.0
HEAD = 5
STREAM_DELAY = "10 minutes"
# Rows of a file in a landing directory: the files, and with them a stream's tasks, grow with the input.
LANDED_ROWS = 100_000

_REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        _REGISTRY[name] = run
        return run

    return add


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def portable(rows: DataFrame) -> DataFrame:
    kinds = (T.DecimalType, T.DateType)
    text = {
        f.name: F.col(f.name).cast("string") for f in rows.schema if isinstance(f.dataType, kinds)
    }
    return rows.withColumns(text) if text else rows


def _ticks(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(run(tables.event_ticks(spark, sf_dir)))


def _bulk(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(run(tables.lineitem_ticks(spark, sf_dir)))


def _frames(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(run(tables.event_frames(spark, sf_dir)))


def _decoded(run: Callable[[DataFrame], DataFrame], **options: str) -> Query:
    return _frames(lambda f: run(decode.decode_frames(f, tables.AS_OF_NS, **options)))


def _log(run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(run(tables.event_write_log(spark, sf_dir)))


def rounded(rows: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return rows.withColumns({name: F.round(name, places) for name in names})


def with_long_prices(ticks: DataFrame) -> DataFrame:
    """Ticks whose prices use all eighteen places, with a digit or more that depends on the id."""
    more = (F.col("trade_id").cast("long") * 7_919 + 1).cast("decimal(18,0)") * F.lit(Decimal("1E-18"))
    return ticks.withColumn("price", (F.col("price").cast("decimal(20,2)") + more).cast(MONEY))


def with_ties(ticks: DataFrame) -> DataFrame:
    """Ticks whose times are cut to half days, so that many of a feed are equal."""
    return ticks.withColumn("timestamp_ns", columns.bar_start(43_200_000_000_000))


# -- scans, ranges, aggregates ---------------------------------------------------------------

_REGISTRY |= {
    "scan_ticks": _ticks(lambda t: t),
    "trades_range": _ticks(lambda t: market.trades(t, SYMBOL, START, END)),
    "trades_exchange": _ticks(lambda t: market.trades(t, SYMBOL, START, END, EXCHANGE)),
    "trades_head": _ticks(lambda t: market.trades(t, SYMBOL, START, END).limit(HEAD)),
    "subscribe_filter": _ticks(lambda t: decode.subscribed(t, ["view", "Click"], "coinbase")),
    "format_ticks": _ticks(lambda t: t.select("trade_id", columns.tick_line().alias("line"))),
    "symbols": _ticks(market.symbols),
    "symbol_parts": _ticks(
        lambda t: market.symbols(t).select(
            "pair",
            columns.split_pair(F.col("pair"))[0].alias("exchange"),
            columns.split_pair(F.col("pair"))[1].alias("symbol"),
        )
    ),
    "minute_counts": _ticks(lambda t: rounded(market.minute_counts(t), "avg_price")),
    "vwap": _ticks(lambda t: rounded(market.vwap(t, SYMBOL, *WHOLE), "vwap")),
    "vwap_exchange": _ticks(lambda t: rounded(market.vwap(t, SYMBOL, START, END, EXCHANGE), "vwap")),
    "vwap_by_symbol": _ticks(lambda t: rounded(market.vwap_by_feed(t), "vwap")),
    "vwap_by_bar": _ticks(lambda t: rounded(market.vwap_by_bar(t, "1h"), "vwap")),
    "vwap_exact_parts": _ticks(market.vwap_exact_parts),
    "vwap_exact": _ticks(lambda t: market.vwap_exact_range(with_long_prices(t), SYMBOL, *WHOLE)),
    "vwap_exact_by_symbol": _ticks(lambda t: market.vwap_exact(with_long_prices(t), "exchange", "symbol")),
    "vwap_exact_by_bar": _ticks(
        lambda t: market.vwap_exact(
            with_long_prices(t), "exchange", "symbol", columns.bar_start(86_400_000_000_000)
        ).withColumnRenamed("_key_2", "bar_start_ns")
    ),
    "bars_tied_1d": _ticks(lambda t: market.bars_by_feed(with_ties(t), "1d")),
    "bars_pooled": _ticks(lambda t: market.bars(t, SYMBOL, *WHOLE, interval="15m")),
    "bars_range": _ticks(lambda t: market.bars(t, SYMBOL, START, END, "4h", EXCHANGE)),
    "bars_display": _ticks(
        lambda t: market.with_bar_seconds(market.bars(t, SYMBOL, START, END, "10s"))
    ),
    "gaps": _ticks(lambda t: market.gaps(t, GAP_SECONDS)),
    "gaps_feed": _ticks(lambda t: market.feed_gaps(t, SYMBOL, EXCHANGE, GAP_SECONDS)),
    "gaps_short": _ticks(lambda t: market.gaps(t, 0.5)),
    "gaps_by_day": _ticks(
        lambda t: market.gaps(t, GAP_SECONDS).withColumn(
            "date", columns.utc_date(F.col("gap_start_ns"))
        )
    ),
    "partition_layout": _ticks(lake.partition_layout),
    "bulk_vwap": _bulk(lambda t: rounded(market.vwap_by_feed(t), "vwap")),
    "bulk_bars_1d": _bulk(lambda t: market.bars_by_feed(t, "1d", tie_break=True)),
    "bulk_gaps": _bulk(lambda t: market.gaps(t, 600.0)),
    "bulk_minute_counts": _bulk(lambda t: rounded(market.minute_counts(t), "avg_price")),
}

BAR_INTERVALS = ["1s", "5s", "1m", "5m", "15m", "1h", "1d"]
for _interval in BAR_INTERVALS:
    _REGISTRY[f"bars_{_interval}"] = _ticks(
        lambda t, width=_interval: market.bars_by_feed(t, width)
    )


@query("sql_minute_counts")
def sql_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.event_ticks(spark, sf_dir).createOrReplaceTempView("ticks")
    return spark.sql(
        """
        SELECT unix_seconds(date_trunc('minute', timestamp_micros(timestamp_ns DIV 1000))) AS minute_s,
               exchange, symbol, COUNT(*) AS trade_count,
               ROUND(AVG(CAST(price AS DOUBLE)), 6) AS avg_price
        FROM ticks WHERE symbol = :symbol GROUP BY ALL ORDER BY minute_s
        """,
        args={"symbol": SYMBOL},
    )


# -- the tree on disk ---------------------------------------------------------------------------

_trees: dict[tuple[str, str], str] = {}


def _tree(spark: SparkSession, sf_dir: str) -> str:
    """All ticks written to a tree, once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trees:
        root = scratch_dir(spark, "tree")
        lake.append_ticks(tables.event_ticks(spark, sf_dir), root)
        _trees[key] = root
    return _trees[key]


@query("write_roundtrip")
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(lake.read_ticks(spark, _tree(spark, sf_dir)))


@query("partition_projection")
def partition_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["timestamp_ns", "price", "size", "side"]
    root = _tree(spark, sf_dir)
    return portable(lake.read_partition(spark, root, EXCHANGE, SYMBOL, DAY, wanted))


@query("tree_bars_1h")
def tree_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = lake.read_ticks(spark, _tree(spark, sf_dir))
    return market.bars(ticks, SYMBOL, START, END, "1h", date_margin=0)


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """Files of a tree as a listing has them: path and bytes. No file is opened."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = reader.option("recursiveFileLookup", "true").load(root)
    return files.select(_plain_path().alias("path"), F.col("length").alias("listed_bytes"))


def _plain_path():
    """A path without its scheme, and as a listing writes it."""
    return F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def _against_listing(spark: SparkSession, inventory: DataFrame, root: str) -> DataFrame:
    """Per directory the rows, and whether the inventory has the files and bytes of a listing."""
    both = inventory.withColumn("path", _plain_path()).join(_listed(spark, root), "path", "full_outer")
    directory = F.regexp_extract("path", "(exchange=.*)/[^/]*$", 1).alias("partition")
    equal = F.coalesce(F.col("n_bytes") == F.col("listed_bytes"), F.lit(False))
    return both.groupBy(directory).agg(F.sum("n_rows").alias("n_rows"), F.min(equal).alias("as_listed"))


@query("file_inventory")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    return _against_listing(spark, lake.file_inventory(spark, root), root)


@query("file_totals")
def file_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    listed = _listed(spark, root).agg(F.count("*").alias("files"), F.sum("listed_bytes").alias("bytes"))
    totals = lake.inventory_totals(lake.file_inventory(spark, root)).crossJoin(listed)  # one row each
    return totals.select(
        "n_rows",
        (F.col("n_files") == F.col("files")).alias("files_as_listed"),
        (F.col("n_bytes") == F.col("bytes")).alias("bytes_as_listed"),
    )


@query("scan_empty")
def scan_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree that nothing was written to, and a published one without a commit."""
    empty = scratch_dir(spark, "empty-tree")
    published.create_published(spark, empty)
    return portable(lake.read_ticks(spark, scratch_dir(spark, "no-tree"), empty))


# -- arguments, and the store object -----------------------------------------------------------

# The same range in each form that a bound may have.
TIME_FORMS = {
    "iso_z": (START, END),
    "iso_offset": ("2024-01-05T08:30:00+02:00", "2024-01-20T10:00:00-02:00"),
    "naive": (datetime(2024, 1, 5, 6, 30), datetime(2024, 1, 20, 12)),
    "aware": (datetime(2024, 1, 5, 6, 30, tzinfo=UTC), datetime(2024, 1, 20, 12, tzinfo=UTC)),
    "nanoseconds": (1_704_436_200_000_000_000, 1_705_752_000_000_000_000),
}
REFUSED_INTERVALS = ["0s", "5", "m", "-1m", "1.5h", "1w", ""]


@query("time_forms")
def time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in one range, given in every form of a time."""
    ticks = tables.event_ticks(spark, sf_dir)
    counts = [
        market.in_range(ticks, SYMBOL, *bounds).agg(
            F.lit(form).alias("form"), F.count("*").alias("n_ticks"),
            F.min("timestamp_ns").alias("first_ns"), F.max("timestamp_ns").alias("last_ns"),
        )
        for form, bounds in TIME_FORMS.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


@query("interval_forms")
def interval_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one symbol in intervals of every unit, and how many texts are no interval."""
    ticks = tables.event_ticks(spark, sf_dir).where(F.col("symbol") == SYMBOL)
    refused = 0
    for text in REFUSED_INTERVALS:
        try:
            parse_interval(text)
        except ValueError:
            refused += 1
    counts = [
        ticks.select(columns.bar_start(parse_interval(text)).alias("b")).agg(
            F.lit(text).alias("interval"), F.count_distinct("b").alias("n_bars"), F.lit(refused).alias("n_refused")
        )
        for text in BAR_INTERVALS
    ]
    return functools.reduce(DataFrame.unionByName, counts)


@query("row_count")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a tree, and of the same rows read through its manifest."""
    plain = lake.read_ticks(spark, _tree(spark, sf_dir)).agg(F.count("*").alias("n_rows"))
    listed = lake.inventory_totals(lake.file_inventory(spark, _published(spark, sf_dir)))
    return plain.crossJoin(listed.select(F.col("n_rows").alias("n_listed")))  # one row each


@query("float_refused")
def float_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose price or size is a float are refused as a table; as text they all pass."""
    ticks = tables.event_ticks(spark, sf_dir).where("price > 0")
    refused = 0
    for name in ("price", "size"):
        try:
            validate.check_ticks(ticks.withColumn(name, F.col(name).cast("double")), tables.AS_OF_NS)
        except ValueError:
            refused += 1
    texts = ticks.withColumns({c: F.col(c).cast("string") for c in ("price", "size")})
    good, _ = validate.split_valid(texts, tables.AS_OF_NS)
    return good.agg(F.lit(refused).alias("n_refused"), F.count("*").alias("n_good"))


@query("store_answers")
def store_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store object's answers on a published tree, as one row."""
    with TickLake(spark, _published(spark, sf_dir), view="stored_ticks", own_layout=True) as store:
        answers = (
            ",".join(store.symbols()),
            len(store.trades(SYMBOL, START, END, EXCHANGE).collect()),
            len(store.bars(SYMBOL, START, END, "4h").collect()),
            len(store.gaps(SYMBOL, EXCHANGE, GAP_SECONDS).collect()),
            str(store.vwap(SYMBOL, START, END, exact=True)),
            round(float(store.vwap(SYMBOL, START, END)), 6),
            store.sql("SELECT count(*) FROM stored_ticks WHERE symbol = :symbol", symbol=SYMBOL).first()[0],
        )
    schema = "symbols string, n_trades long, n_bars long, n_gaps long, exact string, vwap double, n_sql long"
    return spark.createDataFrame([answers], schema)


# -- published trees ----------------------------------------------------------------------------


def _published(spark: SparkSession, sf_dir: str) -> str:
    """All ticks in a published tree, in three commits, once per application and folder."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#published")
    if key not in _trees:
        root = scratch_dir(spark, "published-tree")
        published.create_published(spark, root)
        ticks = tables.event_ticks(spark, sf_dir)
        for part in range(3):
            lake.append_ticks(ticks.where(F.col("trade_id").cast("long") % 3 == part), root)
        _trees[key] = root
    return _trees[key]


@query("published_ticks")
def published_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(lake.read_ticks(spark, _published(spark, sf_dir)))


@query("published_range")
def published_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _published(spark, sf_dir)
    ticks = lake.read_ticks(spark, root, exchange=EXCHANGE, symbol=SYMBOL, start=START, end=END)
    return portable(market.trades(ticks, SYMBOL, START, END, EXCHANGE, date_margin=0))


@query("published_inventory")
def published_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _published(spark, sf_dir)
    return _against_listing(spark, lake.file_inventory(spark, root), f"{root}/data")


@query("manifest_ranges")
def manifest_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest alone knows of each partition."""
    files = published.live_files(spark, _published(spark, sf_dir))
    return portable(
        files.groupBy("exchange", "symbol", "date").agg(
            F.sum("n_rows").alias("n_rows"), F.min("min_ns").alias("min_ns"), F.max("max_ns").alias("max_ns")
        )
    )


@query("atomic_publish")
def atomic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits and one that is lost between its files and its snapshot."""
    root = scratch_dir(spark, "published-tree")
    published.create_published(spark, root)
    ticks = tables.event_ticks(spark, sf_dir)
    for part in range(2):
        lake.append_ticks(ticks.where(F.col("trade_id").cast("long") % 3 == part), root)
    lost = ticks.where(F.col("trade_id").cast("long") % 3 == 2)
    published.write_partitions(lost, f"{root}/data/commit=lost", "overwrite")
    return portable(lake.read_ticks(spark, root))


@query("compacted_ticks")
def compacted_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three commits after compaction, next to the number of files of their day."""
    root = scratch_dir(spark, "published-tree")
    published.create_published(spark, root)
    ticks = tables.event_ticks(spark, sf_dir)
    for part in range(3):
        lake.append_ticks(ticks.where(F.col("trade_id").cast("long") % 3 == part), root)
    published.compact(spark, root)
    days = published.live_files(spark, root).groupBy("exchange", "symbol", "date").agg(F.count("*").alias("n_files"))
    return portable(lake.read_ticks(spark, root).join(days, ["exchange", "symbol", "date"]))


# -- frames, decoding, rules -----------------------------------------------------------------------


def read_binance(text: str) -> list[dict]:
    """The Binance decoder again, as a feed read by Python."""
    try:
        frame = json.loads(text)
    except json.JSONDecodeError:
        raise ValueError(decode.MALFORMED) from None
    trade = frame.get("data", frame)
    if trade.get("e") != "trade":
        return []
    return [
        {
            "symbol": trade["s"],
            "price": trade["p"],
            "size": trade["q"],
            "side": "sell" if trade["m"] else "buy",
            "timestamp_ns": trade["T"] * 1_000_000,
            "trade_id": str(trade["t"]),
        }
    ]


def _feed_ticks(exchange: str) -> Callable[[DataFrame], DataFrame]:
    return lambda d: decode.frame_ticks(d.where(F.col("source") == exchange))


_REGISTRY |= {
    "frames_raw": _frames(lambda f: f),
    "frames_source": _frames(lambda f: f.groupBy("source").agg(F.count("raw").alias("n_frames"))),
    "decode_binance": _decoded(_feed_ticks("binance")),
    "decode_coinbase": _decoded(_feed_ticks("coinbase")),
    "decode_python_feed": lambda spark, sf_dir: portable(
        decode.frame_ticks(
            decode.decode_frames(
                tables.event_frames(spark, sf_dir).where(F.col("source") == "binance"),
                tables.AS_OF_NS,
                python_feeds={"binance": read_binance},
            )
        )
    ),
    "decode_per_trade": _decoded(decode.frame_ticks, on_error="per_trade"),
    "parse_errors": _decoded(
        lambda d: decode.frame_errors(d)
    ),
    "frame_filter": _decoded(health.frame_outcomes),
    "iso_to_ns": lambda spark, sf_dir: tables.event_times(spark, sf_dir).select(
        "event_id", columns.iso_to_ns("iso_time").alias("timestamp_ns")
    ),
    "safe_component": lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", columns.safe_component(F.col("url")).alias("component")
    ),
    "validate_ticks": lambda spark, sf_dir: portable(
        validate.split_valid(tables.event_candidates(spark, sf_dir), tables.AS_OF_NS)[0]
    ),
    "quarantine_counts": lambda spark, sf_dir: validate.quarantine_counts(
        validate.check_ticks(tables.event_candidates(spark, sf_dir), tables.AS_OF_NS)
    ),
}

def sketched_ranks(ticks: DataFrame) -> DataFrame:
    """Quantiles of a range from sketches of its hours, and whether the rank of each among the
    values themselves is as close as stated."""
    seconds = (F.col("received_ns") - F.col("timestamp_ns")) / F.lit(1e9)
    sketches = health.latency_sketches(ticks, seconds, "timestamp_ns", "exchange", "symbol", pane_s=3_600)
    start, end = to_ns(WHOLE[0]), to_ns(DAY)
    found = health.sketch_quantiles(sketches, "exchange", "symbol", start_ns=start, end_ns=end)
    inside = ticks.where(F.col("timestamp_ns").between(start, end - 1)).select("exchange", "symbol", seconds.alias("v"))
    values = inside.join(found, ["exchange", "symbol"])

    def close(name: str, q: float):
        below, upto = F.avg((F.col("v") < F.col(name)).cast("int")), F.avg((F.col("v") <= F.col(name)).cast("int"))
        wide = health.SKETCH_RANK_ERROR
        return ((below <= q + wide) & (upto >= q - wide)).alias(f"{name}_close")

    checks = [close(name, q) for name, q in health.QUANTILES.items()]
    return values.groupBy("exchange", "symbol").agg(F.max("n").alias("n"), *checks)


# -- feed health --------------------------------------------------------------------------------

_REGISTRY |= {
    "m_received": _frames(health.received),
    "m_parsed": _decoded(lambda d: health.parsed(decode.frame_ticks(d))),
    "m_errors": _decoded(health.parse_errors),
    "m_written": _log(health.written),
    "m_latency_hist": _log(lambda w: rounded(health.latency_histogram(w), "total_s")),
    "m_latency_q": _log(
        lambda w: rounded(health.latency_quantiles(w), *health.QUANTILES, places=12)
    ),
    "m_latency_q_5m": _log(
        lambda w: rounded(health.latency_quantiles(w, window_s=300), *health.QUANTILES, places=12)
    ),
    "m_latency_exact": _log(
        lambda w: rounded(health.latency_quantiles_of_values(w, "exchange"), *health.QUANTILES, places=9)
    ),
    "m_latency_approx": _log(
        lambda w: health.latency_quantiles_of_values(w, "exchange", accuracy=10_000)
    ),
    "m_latency_sketch": _ticks(lambda t: sketched_ranks(t)),
    "m_staleness": _ticks(lambda t: health.staleness(t, tables.AS_OF_NS)),
    "m_staleness_level": _ticks(
        # Seen a minute after the last receipt of the whole table's final day.
        lambda t: health.staleness_level(t, 1_706_659_200_000_000_000)
    ),
    "m_rate_1m": _ticks(
        lambda t: rounded(health.rate(t, ["exchange"], "received_ns", 60), "per_second")
    ),
    "m_rate_5m": _ticks(
        lambda t: rounded(
            health.rate(t, ["exchange", "symbol"], "received_ns", 300, 60), "per_second"
        )
    ),
    "m_write_rate": _log(
        lambda w: rounded(
            health.rate(w, ["exchange", "symbol"], "at_ns", 300, 60, F.col("n_ticks")), "per_second"
        )
    ),
    "m_error_rate": _decoded(
        lambda d: rounded(
            health.rate(
                d.where(F.col("status") == "error").withColumnRenamed("source", "exchange"),
                ["exchange"],
                "received_ns",
                60,
            ),
            "per_second",
        )
    ),
    "m_summary": _frames(health.summary),
    "m_feed_latency": _ticks(
        lambda t: rounded(health.feed_latency(t, exact=True), *health.QUANTILES, places=9)
    ),
}


@query("m_totals")
def m_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode.decode_frames(tables.event_frames(spark, sf_dir), tables.AS_OF_NS)
    return health.totals(decoded, tables.event_write_log(spark, sf_dir))


# -- streams ------------------------------------------------------------------------------------


def _landing(spark: SparkSession, sf_dir: str, source: str) -> str:
    """Frames of one exchange as files in a landing directory."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#{source}")
    if key not in _trees:
        path = scratch_dir(spark, f"landing-{source}")
        tables.event_frames(spark, sf_dir).where(F.col("source") == source).write.parquet(path)
        _trees[key] = path
    return _trees[key]


def _spread(rows: DataFrame) -> int:
    """Files of about `LANDED_ROWS` for the rows, which are counted without computing them."""
    return max(1, -(-rows.count() // LANDED_ROWS))


def _in_turns(rows: DataFrame, second: Column) -> list[DataFrame]:
    """Rows of a first and of a second turn, worked out once, in as many tasks as they need."""
    path = scratch_dir(rows.sparkSession, "turns")
    rows.withColumn("turn", second.cast("int")).write.partitionBy("turn").parquet(path)
    kept = rows.sparkSession.read.schema(T.StructType([*rows.schema, T.StructField("turn", T.IntegerType())])).parquet(path)
    return [kept.where(F.col("turn") == turn).drop("turn") for turn in range(2)]


def _frames_in_turns(spark: SparkSession, sf_dir: str, second: Column) -> list[DataFrame]:
    files = _spread(tables.event_frames(spark, sf_dir))
    return _in_turns(tables.event_frames(spark, sf_dir, spread=files), second)


def _land(rows: DataFrame, path: str, batches: int = 1) -> int:
    """Add rows to a landing directory, as files of about `LANDED_ROWS`; returns how many of
    them a trigger has to take for the stream to need `batches` of them."""
    per_batch = -(-_spread(rows) // batches)
    rows.repartition(per_batch * batches).write.mode("append").parquet(path)
    return per_batch


def _run_feeds(spark: SparkSession, sf_dir: str):
    """Both feeds merged, decoded and written; returns the ended query and its tree."""
    feeds = [
        frame_sources.stream_frames(spark, _landing(spark, sf_dir, name))
        for name in ("binance", "coinbase")
    ]
    root = scratch_dir(spark, "stream-tree")
    ticks = stream_ticks.tick_stream(frame_sources.merge_feeds(*feeds))
    run = stream_ticks.write_tick_stream(ticks, root, available_now=True)
    run.awaitTermination()
    return run, root


@query("stream_decode")
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frames of a landing directory with both exchanges mixed in its files."""
    landing = scratch_dir(spark, "landing-mixed")
    tables.event_frames(spark, sf_dir).write.parquet(landing)
    root = scratch_dir(spark, "stream-tree")
    ticks = stream_ticks.tick_stream(frame_sources.stream_frames(spark, landing))
    stream_ticks.write_tick_stream(ticks, root, available_now=True).awaitTermination()
    return portable(lake.read_ticks(spark, root))


@query("stream_restart")
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over half the files, ended, then started again with the same arguments once
    the others have come: every tick is there once."""
    landing, root = scratch_dir(spark, "landing-restart"), scratch_dir(spark, "stream-tree")
    for part in _frames_in_turns(spark, sf_dir, F.xxhash64("raw") % 2 == 0):
        per_batch = _land(part, landing, batches=2)
        arrived = frame_sources.stream_frames(spark, landing, max_files_per_trigger=per_batch)
        ticks = stream_ticks.tick_stream(arrived)
        stream_ticks.write_tick_stream(ticks, root, available_now=True).awaitTermination()
    return portable(lake.read_ticks(spark, root))


@query("stream_union")
def stream_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _run_feeds(spark, sf_dir)
    return portable(lake.read_ticks(spark, root))


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Frames streamed into a published tree in two runs, those of even days in the first."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}#streamed")
    if key not in _trees:
        landing, root = scratch_dir(spark, "landing-runs"), scratch_dir(spark, "published-tree")
        odd = columns.floor_slot(F.col("received_ns"), 86_400_000_000_000) % 2
        for part in _frames_in_turns(spark, sf_dir, odd):
            _land(part, landing)
            run = stream_ticks.publish_tick_stream(
                frame_sources.stream_frames(spark, landing), root, available_now=True
            )
            run.awaitTermination()
        _trees[key] = root
    return _trees[key]


@query("stream_published")
def stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(lake.read_ticks(spark, _streamed(spark, sf_dir)))


@query("m_run_summary")
def m_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _streamed(spark, sf_dir)
    files = lake.inventory_totals(lake.file_inventory(spark, root)).first().n_files
    return stream_ticks.published_summary(spark, root).select(
        "n_batches", "n_frames", "n_errors", "n_ticks",
        (F.col("files_written") == files).alias("files_as_listed"),
        (F.col("msgs_per_sec") > 0).alias("has_rate"),
    )


@query("m_stream_written")
def m_stream_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.written(published.write_log(spark, _streamed(spark, sf_dir)))


@query("m_stream_latency")
def m_stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes per feed from the log of the runs: the last bucket holds all of them, each took
    some time, and both quantiles lie between the least and the greatest."""
    log = published.write_log(spark, _streamed(spark, sf_dir))
    buckets = health.latency_histogram(log, "exchange", "symbol").where("le = '+Inf'")
    q = health.latency_quantiles_of_values(log, "exchange", "symbol").drop("n_writes")
    return buckets.join(q, ["exchange", "symbol"]).select(
        "exchange", "symbol", "n_writes", "cumulative",
        ((F.col("total_s") > 0) & (F.col("p50") > 0) & (F.col("p50") <= F.col("p99"))).alias("timed"),
    )


def _tick_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream of the ticks in the batch tree."""
    reader = spark.readStream.schema(STORED_TICK).option("pathGlobFilter", "*.parquet")
    return reader.parquet(_tree(spark, sf_dir)).select(*STORED_COLS)


@query("stream_write")
def stream_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream-tree")
    run = stream_ticks.write_tick_stream(_tick_source(spark, sf_dir), root, available_now=True)
    run.awaitTermination()
    return portable(lake.read_ticks(spark, root))


@query("stream_drain")
def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running query drained and stopped, and one that goes on from its checkpoint with
    the frames that have come meanwhile."""
    root, checkpoint = scratch_dir(spark, "stream-tree"), scratch_dir(spark, "checkpoint")
    landing = scratch_dir(spark, "landing-drain")

    def run(part: DataFrame):
        per_batch = _land(part, landing, batches=2)
        arrived = frame_sources.stream_frames(spark, landing, max_files_per_trigger=per_batch)
        return stream_ticks.write_tick_stream(
            stream_ticks.tick_stream(arrived), root, checkpoint, flush_interval="0 seconds"
        )

    for part in _frames_in_turns(spark, sf_dir, F.xxhash64("raw") % 2 == 0):
        stream_ticks.drain(run(part))
    return portable(lake.read_ticks(spark, root))


def _to_files(rows: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over what there is and read its output back."""
    spark = rows.sparkSession
    out = scratch_dir(spark, name)
    run = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query("stream_bars")
def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _tick_source(spark, sf_dir)
    return _to_files(stream_events.stream_bars(ticks, "1h", STREAM_DELAY), "stream-bars")


@query("stream_gaps")
def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _tick_source(spark, sf_dir)
    return _to_files(stream_events.stream_gaps(ticks, GAP_SECONDS, STREAM_DELAY), "stream-gaps")


@query("stream_corrected_bars")
def stream_corrected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of all ticks, half of which come only after the others."""
    source, root = scratch_dir(spark, "late-ticks"), scratch_dir(spark, "bar-parts")
    for part in _in_turns(tables.event_ticks(spark, sf_dir), F.xxhash64("trade_id") % 2 == 0):
        per_batch = _land(part, source, batches=2)
        arrived = spark.readStream.schema(STORED_TICK).option("maxFilesPerTrigger", per_batch).parquet(source)
        stream_events.publish_bars(arrived, root, "1h", available_now=True).awaitTermination()
    return stream_events.corrected_bars(spark, root, "1h")
