"""Queries over ticks: range scans, volume-weighted prices, bars, symbols and gaps.

Each takes a DataFrame of stored ticks and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from decimal import Decimal, localcontext
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    as_double,
    bar_start,
    floor_slot,
    long_div,
    ns_to_timestamp,
    pair_label,
)
from ..functions.timeargs import (
    NS_PER_DAY,
    NS_PER_SECOND,
    TimeInput,
    clamp_long,
    parse_interval,
    to_ns,
)
from ..schema import FEED, MONEY, STORED_COLS

BAR_COLS = ["bar_start_ns", "open", "high", "low", "close", "volume", "count"]

# Slots per window group in gap search; bounds the rows any one group can hold.
_FAN_OUT = 1 << 16


# -- row selection -----------------------------------------------------------------------


def in_range(
    ticks: DataFrame,
    symbol: str,
    start: TimeInput,
    end: TimeInput,
    exchange: str | None = None,
    *,
    date_margin: int = 1,
) -> DataFrame:
    """Ticks of a symbol in `[start, end)`; all exchanges are pooled unless one is named.

    The range also becomes a filter on `date`, so only the partitions it touches are listed
    and read. Other writers may place a tick near midnight one day off; `date_margin`
    widens the day filter by that many days (0 is enough for trees this package wrote).
    """
    start_ns, end_ns = clamp_long(to_ns(start)), clamp_long(to_ns(end))
    rows = ticks.where(
        (F.col("symbol") == symbol)
        & (F.col("timestamp_ns") >= F.lit(start_ns).cast("long"))
        & (F.col("timestamp_ns") < F.lit(end_ns).cast("long"))
    )
    if exchange is not None:
        rows = rows.where(F.col("exchange") == exchange)
    epoch = date(1970, 1, 1)
    first = epoch + timedelta(days=start_ns // NS_PER_DAY - date_margin)
    last = epoch + timedelta(days=max(end_ns - 1, start_ns) // NS_PER_DAY + date_margin)
    return rows.where(F.col("date").between(F.lit(first), F.lit(last)))


def trades(
    ticks: DataFrame,
    symbol: str,
    start: TimeInput,
    end: TimeInput,
    exchange: str | None = None,
    **options: int,
) -> DataFrame:
    """Every trade in the range, in time order (equal times by trade id)."""
    rows = in_range(ticks, symbol, start, end, exchange, **options)
    return rows.select(*STORED_COLS).orderBy("timestamp_ns", "exchange", "trade_id")


# -- volume-weighted average price --------------------------------------------------------


def vwap_column() -> Column:
    """sum(price x size) / sum(size) in doubles; NULL without volume."""
    price, size = as_double("price"), as_double("size")
    return F.sum(price * size) / F.nullif(F.sum(size), F.lit(0.0))


def vwap(
    ticks: DataFrame,
    symbol: str,
    start: TimeInput,
    end: TimeInput,
    exchange: str | None = None,
    **options: int,
) -> DataFrame:
    """One row `vwap`, NULL when nothing traded."""
    return in_range(ticks, symbol, start, end, exchange, **options).agg(vwap_column().alias("vwap"))


def vwap_by_feed(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy(*FEED).agg(vwap_column().alias("vwap"))


def vwap_by_bar(ticks: DataFrame, interval: str = "1h") -> DataFrame:
    slot = bar_start(parse_interval(interval)).alias("bar_start_ns")
    return ticks.groupBy(*FEED, slot).agg(vwap_column().alias("vwap"))


# -- the same, exactly --------------------------------------------------------------------

# Prices and sizes are whole numbers of 10^-18. They are cut into limbs of nine digits, whose
# products fit a long; a total of products is a whole number of 10^-36.
_LIMB = 1_000_000_000
_LIMBS = 5
_PRICE_SCALE, _NOTIONAL_SCALE = 18, 36


# Numbers below 10^6 with at most eight decimal places, which is nearly all: a sum of their
# products fits a decimal for ten thousand million ticks a day.
_SHORT, _SHORT_SCALE = "decimal(14,8)", 8


def _limbs(value: Column) -> list[Column]:
    """The limbs of a decimal(38,18), lowest first; the highest carries the sign."""
    billion = F.lit(_LIMB).cast("decimal(10,0)")
    whole = F.floor(value)
    part = F.pmod(value, F.lit(1).cast("decimal(1,0)")).cast("decimal(18,18)")
    part = (part * F.lit(10**18).cast("decimal(19,0)")).cast("long")
    upper = F.floor(whole / billion)
    rest, upper = (whole - upper * billion).cast("long"), upper.cast("long")
    upper_limbs = [F.pmod(upper, F.lit(_LIMB)), floor_slot(upper, _LIMB)]
    return [part % _LIMB, floor_slot(part, _LIMB), rest, *upper_limbs]


def _spread(values: list[Column], base: str) -> list[Column]:
    """Sums of longs of any size as two columns each: nine digits, and what is above them."""
    parts = []
    for k, value in enumerate(values):
        parts.append(F.sum(F.pmod(value, F.lit(_LIMB))).alias(f"{base}_{k}_low"))
        parts.append(F.sum(floor_slot(value, _LIMB)).alias(f"{base}_{k}_high"))
    return parts


def _sum_or_fail(value: Column) -> Column:
    """A sum that fails where it overflows, also in a session that would make it NULL."""
    fault = F.raise_error(F.lit("a total is too large to be exact"))
    return F.when(F.count(value) > 0, F.coalesce(F.sum(value), fault))


def _exact_udf():
    """Notional, volume and their quotient from the totals of the limbs, one group a row."""

    def total(parts: list[str], quick: str, scale: int) -> int:
        pairs = zip(parts[::2], parts[1::2], strict=True)
        limbs = sum((int(low) + int(high) * _LIMB) * _LIMB**k for k, (low, high) in enumerate(pairs))
        with localcontext(prec=100):
            return limbs + int(Decimal(quick).scaleb(scale))

    def text(value: int, places: int) -> str:
        digits = str(abs(value)).rjust(places + 1, "0")
        return f"{'-' if value < 0 else ''}{digits[:-places]}.{digits[-places:]}"

    def quotient(notional: int, volume: int) -> Decimal | None:
        if not volume:
            return None
        sign = -1 if (notional < 0) != (volume < 0) else 1
        whole, rest = divmod(abs(notional), abs(volume))
        whole += 2 * rest > abs(volume) or (2 * rest == abs(volume) and whole % 2)
        return Decimal(f"{sign * whole}E-{_PRICE_SCALE}") if whole < 10**38 else None

    kind = pa.struct([("notional", pa.string()), ("volume", pa.string()), ("vwap", pa.decimal128(38, 18))])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for totals in batch.to_pylist():
                cut = 2 * (2 * _LIMBS - 1)
                *totals, quick_n, quick_v = totals
                notional = total(totals[:cut], quick_n, _NOTIONAL_SCALE)
                volume = total(totals[cut:], quick_v, _PRICE_SCALE)
                value = quotient(notional, volume)
                rows.append(
                    {
                        "notional": text(notional, _NOTIONAL_SCALE),
                        "volume": text(volume, _PRICE_SCALE),
                        "vwap": value,
                    }
                )
            yield pa.array(rows, kind)

    return F.arrow_udf(run, f"struct<notional:string,volume:string,vwap:{MONEY.simpleString()}>")


def vwap_exact(ticks: DataFrame, *keys: str | Column) -> DataFrame:
    """`notional`, `volume` and `vwap` per group, exact for all that decimal(38,18) holds.

    Products of wide decimals lose scale in Spark, so they are added up as longs, first per
    day, where no sum can overflow, then per group as wide decimals. Only the groups' totals
    go through Python, which divides once: `vwap` is rounded half to even at its 18th
    place, NULL without volume. `notional` (36 places) and `volume` (18) are text, since no
    decimal type holds them all. Without keys and without ticks there is no row.
    """
    names = [k if isinstance(k, str) else f"_key_{i}" for i, k in enumerate(keys)]
    columns = [F.col(k) if isinstance(k, str) else k.alias(f"_key_{i}") for i, k in enumerate(keys)]
    day = floor_slot(F.col("timestamp_ns"), NS_PER_DAY).alias("_day")
    short = {f"_{c}": F.expr(f"try_cast({c} AS {_SHORT})") for c in ("price", "size")}
    rows = ticks.select(*columns, day, "price", "size").withColumns(short)
    rows = rows.withColumn("_short", (F.col("_price") == F.col("price")) & (F.col("_size") == F.col("size")))
    rows = rows.withColumn("_short", F.coalesce("_short", F.lit(False)))
    quick = [F.when(F.col("_short"), F.col("_price") * F.col("_size")), F.when(F.col("_short"), F.col("_size"))]
    for name in ("price", "size"):
        wide = F.when(~F.col("_short"), F.col(name))
        rows = rows.withColumns({f"_{name}_{i}": limb for i, limb in enumerate(_limbs(wide))})
    products = [
        reduce(
            Column.__add__,
            [F.col(f"_price_{i}") * F.col(f"_size_{k - i}") for i in range(_LIMBS) if 0 <= k - i < _LIMBS],
        )
        for k in range(2 * _LIMBS - 1)
    ]
    parts = [*_spread(products, "n"), *_spread([F.col(f"_size_{i}") for i in range(_LIMBS)], "v")]
    parts += [_sum_or_fail(q).alias(c) for q, c in zip(quick, ("quick_n", "quick_v"), strict=True)]
    daily = rows.groupBy(*names, "_day").agg(*parts)
    sums = [c for c in daily.columns if c not in (*names, "_day", "quick_n", "quick_v")]
    scales = {"quick_n": 2 * _SHORT_SCALE, "quick_v": _SHORT_SCALE}
    totals = [_sum_or_fail(F.col(c).cast("decimal(19,0)")) for c in sums]
    totals += [_sum_or_fail(F.col(c)).cast(f"decimal(38,{scale})") for c, scale in scales.items()]
    totals = [F.coalesce(t.cast("string"), F.lit("0")) for t in totals]
    found = daily.groupBy(*names).agg(F.array(*totals).alias("_totals"), F.count("*").alias("_n")).where("_n > 0")
    return found.select(*names, _exact_udf()(F.col("_totals")).alias("_exact")).select(*names, "_exact.*")


def vwap_exact_parts(ticks: DataFrame) -> DataFrame:
    """Exact notional and volume per feed, as text."""
    return vwap_exact(ticks, *FEED).drop("vwap")


def vwap_exact_range(
    ticks: DataFrame,
    symbol: str,
    start: TimeInput,
    end: TimeInput,
    exchange: str | None = None,
    **options: int,
) -> DataFrame:
    """One row `notional, volume, vwap`, or none when nothing traded."""
    return vwap_exact(in_range(ticks, symbol, start, end, exchange, **options))


# -- bars ----------------------------------------------------------------------------------


def trade_order() -> Column:
    """When a trade happened, as one number that orders all trades: by time, then by id.

    Ids of at most 16 digits go by value (equal ones by exchange), all others after them by a
    hash. A decimal(38,0) has a fixed width, so an aggregate over it stays a hash
    aggregate, and its result does not depend on how rows are partitioned.
    """
    id_ = F.col("trade_id")
    # A pattern first: a cast that fails costs far more than one that succeeds.
    number = F.when(F.length(id_).between(1, 16) & ~id_.rlike("[^0-9]"), id_.cast("long"))
    by_value = number * 800 + F.pmod(F.xxhash64("exchange"), F.lit(800))
    by_hash = F.lit(8 * 10**18) + F.pmod(F.xxhash64("exchange", "trade_id"), F.lit(12 * 10**17))
    tie = F.coalesce(by_value, by_hash).cast("decimal(19,0)")
    return F.col("timestamp_ns").cast("decimal(19,0)") * F.lit(Decimal(10**19)) + tie


def bar_columns(*, tie_break: bool = False) -> list[Column]:
    """Open, high, low, close, volume and count of one bar.

    Trades of equal time go by `trade_order`, so the same trades always make the same bar;
    every aggregate stays in a hash aggregate. With `tie_break` they go by the text of the
    trade id instead, at the cost of a sort.
    """
    price = as_double("price")
    when = F.struct("timestamp_ns", "trade_id") if tie_break else trade_order()
    return [
        F.min_by(price, when).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, when).alias("close"),
        F.sum(as_double("size")).alias("volume"),
        F.count("*").alias("count"),
    ]


def bars(
    ticks: DataFrame,
    symbol: str,
    start: TimeInput,
    end: TimeInput,
    interval: str = "1m",
    exchange: str | None = None,
    *,
    tie_break: bool = False,
    **options: int,
) -> DataFrame:
    """Bars of one symbol in time order; bars without trades are absent."""
    width = parse_interval(interval)
    rows = in_range(ticks, symbol, start, end, exchange, **options)
    return (
        rows.groupBy(bar_start(width).alias("bar_start_ns"))
        .agg(*bar_columns(tie_break=tie_break))
        .orderBy("bar_start_ns")
    )


def bars_by_feed(ticks: DataFrame, interval: str = "1m", *, tie_break: bool = False) -> DataFrame:
    """Bars of every feed at once, unordered."""
    slot = bar_start(parse_interval(interval)).alias("bar_start_ns")
    return ticks.groupBy(*FEED, slot).agg(*bar_columns(tie_break=tie_break))


def with_bar_seconds(bar_rows: DataFrame) -> DataFrame:
    """Bars with their start in whole seconds, for display."""
    seconds = long_div(F.col("bar_start_ns"), NS_PER_SECOND).alias("bar_start_s")
    others = [c for c in bar_rows.columns if c != "bar_start_ns"]
    return bar_rows.select(seconds, *others)


# -- symbols and ad-hoc aggregates ----------------------------------------------------------


def symbols(ticks: DataFrame) -> DataFrame:
    """Distinct `exchange:symbol` pairs in order. On a stored tree no data column is read."""
    pairs = ticks.select(*FEED).distinct().orderBy(*FEED)
    return pairs.select(pair_label().alias("pair"))


def minute_counts(ticks: DataFrame) -> DataFrame:
    """Trades and mean price per minute and feed; the minute as epoch seconds."""
    minute = F.unix_seconds(F.date_trunc("minute", ns_to_timestamp(F.col("timestamp_ns"))))
    return ticks.groupBy(minute.alias("minute_s"), *FEED).agg(
        F.count("*").alias("trade_count"), F.avg(as_double("price")).alias("avg_price")
    )


# -- gaps -------------------------------------------------------------------------------------


def gap_threshold_ns(max_gap_seconds: float) -> int:
    if max_gap_seconds < 0:
        raise ValueError("max_gap_seconds must not be negative")
    return int(max_gap_seconds * NS_PER_SECOND)


def gaps(ticks: DataFrame, max_gap_seconds: float = 60.0) -> DataFrame:
    """Stretches strictly longer than the threshold without a trade, for every feed.

    Two neighbouring trades inside one slot of `threshold + 1` ns cannot be a gap apart, so
    each slot shrinks to its first and last time in a partial aggregate. Gaps lie between
    neighbouring slots. These are compared inside blocks of `_FAN_OUT` slots, each block
    shrinks to its first and last time in turn, and so on until a feed has few blocks.
    No group ever holds more rows than slots in a block, however busy the feed.
    """
    threshold = gap_threshold_ns(max_gap_seconds)
    width = threshold + 1
    time = F.col("timestamp_ns")
    edges = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    spans = (
        ticks.groupBy(*FEED, floor_slot(time, width).alias("slot"))
        .agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
        .drop("slot")
    )

    def between(rows: DataFrame, *group: str) -> DataFrame:
        before = F.lag("hi").over(Window.partitionBy(*group).orderBy("lo"))
        pairs = rows.select(*FEED, before.alias("gap_start_ns"), F.col("lo").alias("gap_end_ns"))
        return pairs.where(F.col("gap_end_ns") - F.col("gap_start_ns") > F.lit(threshold))

    found = []
    while width * _FAN_OUT < 2**62:
        width *= _FAN_OUT
        # One shuffle serves both the comparison and the next level.
        block = spans.withColumn("block", floor_slot(F.col("lo"), width)).repartition(*FEED, "block")
        found.append(between(block, *FEED, "block"))
        spans = block.groupBy(*FEED, "block").agg(*edges).drop("block")
    found.append(between(spans, *FEED))
    length = (F.col("gap_end_ns") - F.col("gap_start_ns")) / F.lit(1e9)
    return reduce(DataFrame.unionByName, found).withColumn("gap_seconds", length)


def feed_gaps(
    ticks: DataFrame, symbol: str, exchange: str, max_gap_seconds: float = 60.0
) -> DataFrame:
    """Gaps of one feed in time order."""
    one = ticks.where((F.col("symbol") == symbol) & (F.col("exchange") == exchange))
    return gaps(one, max_gap_seconds).drop(*FEED).orderBy("gap_start_ns")
