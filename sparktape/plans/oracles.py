"""The queries of `queries.py` as SQL for DuckDB over the same tables."""

from __future__ import annotations

from ..operators import health
from ..sources import tables
from ..streaming.events import slot_micros
from . import queries as q

# Ticks of `events`; `kind` picks the frame shape and the broken rows.
EVENTS = """
raw_events AS (
  SELECT event_id, ts,
    CASE WHEN user_id % 2 = 0 THEN 'binance' ELSE 'coinbase' END AS exchange,
    upper(event_type) AS symbol,
    CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price,
    CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS DECIMAL(38,18)) AS size,
    CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
    epoch_us(ts) * 1000 AS timestamp_ns,
    epoch_us(ts) * 1000 + (event_id % 500) * 1000000 AS received_ns,
    CAST(event_id AS VARCHAR) AS trade_id
  FROM events),
ticks AS (
  SELECT exchange, symbol, price, size, side, timestamp_ns, received_ns, trade_id,
         CAST(make_timestamp(timestamp_ns // 1000) AS DATE) AS date, event_id
  FROM raw_events)
"""
BULK = """
ticks AS (
  SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'coinbase' ELSE 'binance' END AS exchange,
    l_returnflag || l_linestatus AS symbol,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(l_quantity AS DECIMAL(18,2)) AS size,
    epoch_us(l_shipdate) * 1000
      + ((l_orderkey * 7 + l_linenumber) % 86400) * 1000000000 AS timestamp_ns,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS trade_id
  FROM lineitem)
"""
# The raw text of each frame, by the rules of the test data, and what JSON functions read from
# it: the trades in order, the reason of each that breaks a rule, and those before the first.
FRAMES = """
texts AS (
  SELECT event_id, exchange, received_ns, event_id % 50 AS kind, symbol, side, trade_id,
    CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
    CAST(CAST(size AS BIGINT) AS VARCHAR) AS size_text,
    CAST(epoch_us(ts) // 1000 AS VARCHAR) AS millis, replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' AS iso_time
  FROM raw_events),
shapes AS (
  SELECT *,
    '{"e":"trade","E":' || millis || ',"s":"' || symbol || '","t":' || trade_id || ',"p":"' AS head,
    '","q":"' || size_text || '","T":' || millis || ',"m":'
      || CASE side WHEN 'sell' THEN 'true' ELSE 'false' END || ',"M":true}' AS tail,
    list_transform(
      CASE kind WHEN 1 THEN ['a', 'b', 'c'] WHEN 3 THEN ['a', 'b'] ELSE [''] END,
      lambda part: '{"trade_id":"' || trade_id || part || '","product_id":"' || symbol
        || '","price":"' || price_text || '","size":"' || CASE part WHEN 'b' THEN CASE kind WHEN 1 THEN '0' ELSE size_text END ELSE size_text END
        || '","side":"' || CASE kind WHEN 4 THEN 'LONG' ELSE upper(side) END || '","time":"' || iso_time || '"}') AS parts
  FROM texts),
frames AS (
  SELECT event_id, exchange, received_ns,
    CASE WHEN exchange = 'binance' THEN
      CASE kind WHEN 0 THEN substring(head || price_text || tail, 1, 40)
           WHEN 1 THEN head || '-1' || tail
           WHEN 2 THEN '{"e":"depthUpdate","s":"' || symbol || '"}'
           WHEN 3 THEN '{"stream":"' || lower(symbol) || '@trade","data":' || head || price_text || tail || '}'
           WHEN 4 THEN '{"stream":"' || lower(symbol) || '@trade","data":' || head || price_text || tail || '}'
           ELSE head || price_text || tail END
    ELSE
      CASE kind WHEN 0 THEN substring(whole, 1, 60)
           WHEN 2 THEN '{"channel":"subscriptions","events":[{"subscriptions":{}}]}' ELSE whole END
    END AS raw
  FROM (SELECT *, '{"channel":"market_trades","sequence_num":0,"events":['
      || CASE kind WHEN 5 THEN '{"type":"l2_data","trades":[{"side":"LONG"}]},' ELSE '' END
      || '{"type":"' || CASE kind WHEN 3 THEN 'snapshot' ELSE 'update' END || '","trades":['
      || array_to_string(parts, ',') || ']}]}' AS whole FROM shapes)),
bodies AS (
  SELECT *, CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS body FROM frames),
read_frames AS (
  SELECT event_id, exchange, received_ns, raw, body IS NULL AS malformed,
    CASE WHEN body IS NULL THEN []
      WHEN exchange = 'binance' THEN list_transform(
        list_filter([coalesce(json_extract(body, '$.data'), body)], lambda t: json_extract_string(t, '$.e') = 'trade'),
        lambda t: {'symbol': json_extract_string(t, '$.s'), 'price': json_extract_string(t, '$.p'),
          'size': json_extract_string(t, '$.q'),
          'side': CASE json_extract_string(t, '$.m') WHEN 'true' THEN 'sell' ELSE 'buy' END,
          'ns': CAST(json_extract_string(t, '$.T') AS BIGINT) * 1000000, 'id': json_extract_string(t, '$.t')})
      WHEN json_extract_string(body, '$.channel') = 'market_trades' THEN list_transform(
        flatten(list_transform(
          list_filter(json_extract(body, '$.events[*]'), lambda e: json_extract_string(e, '$.type') IN ('snapshot', 'update')),
          lambda e: json_extract(e, '$.trades[*]'))),
        lambda t: {'symbol': json_extract_string(t, '$.product_id'), 'price': json_extract_string(t, '$.price'),
          'size': json_extract_string(t, '$.size'), 'side': lower(json_extract_string(t, '$.side')),
          'ns': epoch_us(CAST(json_extract_string(t, '$.time') AS TIMESTAMP)) * 1000,
          'id': json_extract_string(t, '$.trade_id')})
      ELSE [] END AS trades
  FROM bodies),
judged AS (
  SELECT *, list_transform(trades, lambda t:
    CASE WHEN CAST(t.price AS DECIMAL(38,18)) <= 0 THEN 'price must be > 0'
         WHEN CAST(t.size AS DECIMAL(38,18)) <= 0 THEN 'size must be > 0'
         WHEN t.side NOT IN ('buy', 'sell') THEN 'Unknown side' END) AS faults
  FROM read_frames),
decoded AS (
  SELECT *, CASE WHEN malformed THEN 'malformed JSON' ELSE list_filter(faults, lambda f: f IS NOT NULL)[1] END AS reason,
    coalesce(nullif(list_position(list_transform(faults, lambda f: f IS NOT NULL), true), 0) - 1, len(trades)) AS n_ticks
  FROM judged),
good_trades AS (
  SELECT event_id, exchange, received_ns, n_ticks, place, trades[place] AS t
  FROM (SELECT *, unnest(range(1, len(trades) + 1)) AS place FROM decoded) WHERE faults[place] IS NULL),
all_good_ticks AS (
  SELECT exchange, t.symbol AS symbol, CAST(t.price AS DECIMAL(38,18)) AS price, CAST(t.size AS DECIMAL(38,18)) AS size,
    t.side AS side, t.ns AS timestamp_ns, received_ns, t.id AS trade_id,
    CAST(make_timestamp(t.ns // 1000) AS DATE) AS date, event_id, place <= n_ticks AS in_prefix
  FROM good_trades),
frame_ticks AS (SELECT * FROM all_good_ticks WHERE in_prefix)
"""
WRITE_LOG = """
write_log AS (
  SELECT min(event_id) AS batch_id, exchange, symbol, count(*) AS n_ticks,
         ((min(event_id) * 7919) % 12000) / 1000.0 AS latency_s, max(received_ns) AS at_ns
  FROM ticks GROUP BY exchange, symbol, date)
"""
TICK_OUT = (
    "exchange, symbol, CAST(price AS VARCHAR) AS price, CAST(size AS VARCHAR) AS size, side, "
    "timestamp_ns, received_ns, trade_id, CAST(date AS VARCHAR) AS date"
)
BAR_AGGREGATES = """
arg_min(CAST(price AS DOUBLE), timestamp_ns) AS open, max(CAST(price AS DOUBLE)) AS high,
min(CAST(price AS DOUBLE)) AS low, arg_max(CAST(price AS DOUBLE), timestamp_ns) AS close,
sum(CAST(size AS DOUBLE)) AS volume, count(*) AS count
"""
TIED_AGGREGATES = BAR_AGGREGATES.replace("DOUBLE), timestamp_ns)", "DOUBLE), {'a': timestamp_ns, 'b': trade_id})")
VWAP = "round(sum(CAST(price AS DOUBLE) * CAST(size AS DOUBLE)) / nullif(sum(CAST(size AS DOUBLE)), 0), 6) AS vwap"

_NS = {"START": 1_704_436_200_000_000_000, "END": 1_705_752_000_000_000_000}
RANGE = f"symbol = '{q.SYMBOL}' AND timestamp_ns >= {_NS['START']} AND timestamp_ns < {_NS['END']}"
POOL = f"symbol = '{q.SYMBOL}'"
FEED = f"exchange = '{q.EXCHANGE}'"


def _events(select: str, *more: str) -> str:
    return f"WITH {', '.join([EVENTS, *more])} {select}"


def _bulk(select: str) -> str:
    return f"WITH {BULK} {select}"


def _bars(width_ns: int, keys: str = "exchange, symbol, ", where: str = "TRUE") -> str:
    return _events(
        f"SELECT {keys}timestamp_ns // {width_ns} * {width_ns} AS bar_start_ns, {BAR_AGGREGATES} "
        f"FROM ticks WHERE {where} GROUP BY {keys}bar_start_ns"
    )


def _exact(keys: str, where: str = "TRUE") -> str:
    """Exact notional, volume and average of `with_long_prices`, in whole numbers of 10^-18."""
    group = ", ".join(k.split(" AS ")[-1].strip() for k in keys.split(",") if k.strip())
    text = "CAST({0} // {1}::HUGEINT AS VARCHAR) || '.' || lpad(CAST({0} % {1}::HUGEINT AS VARCHAR), 18, '0')"
    one = 10**18
    even = "(n // v + CASE WHEN 2 * (n % v) + (n // v) % 2 > v THEN 1 ELSE 0 END)"
    return _events(
        f"""SELECT {group + "," if group else ""} {text.format("n", one)} || repeat('0', 18) AS notional,
              CAST(v AS VARCHAR) || '.' || repeat('0', 18) AS volume,
              {text.format(even, one)} AS vwap
            FROM (SELECT {keys} sum(unit * CAST(size AS HUGEINT)) AS n, CAST(sum(CAST(size AS HUGEINT)) AS HUGEINT) AS v
                  FROM (SELECT *, CAST(price * 100 AS HUGEINT) * {10**16}::HUGEINT + event_id * 7919 + 1 AS unit FROM ticks)
                  WHERE {where} {"GROUP BY " + group if group else ""})"""
    )


def _gaps(ticks: str, select: str, seconds: float, where: str = "TRUE", more: str = "") -> str:
    return f"""WITH {ticks}, lagged AS (
        SELECT exchange, symbol, timestamp_ns AS gap_end_ns,
          lag(timestamp_ns) OVER (PARTITION BY exchange, symbol ORDER BY timestamp_ns) AS gap_start_ns
        FROM ticks WHERE {where})
      SELECT {select} gap_start_ns, gap_end_ns, (gap_end_ns - gap_start_ns) / 1e9 AS gap_seconds
      FROM lagged WHERE gap_end_ns - gap_start_ns > {int(seconds * 1_000_000_000)} {more}"""


def _bounds() -> str:
    """Histogram buckets as rows: number, lower and upper bound, label."""
    lows = [0.0, *health.LATENCY_BOUNDS[:-1]]
    rows = ", ".join(
        f"({i}, {low}::DOUBLE, {high}::DOUBLE, '{high:g}')"
        for i, (low, high) in enumerate(zip(lows, health.LATENCY_BOUNDS, strict=True))
    )
    return f"bounds(i, lower_s, upper_s, le) AS (VALUES {rows})"


def _quantiles(observed: str, keys: str) -> str:
    """Quantiles of `v` in `observed` per group, linear inside buckets."""
    by = f"{keys}," if keys else ""
    picked = ", ".join(
        f"""round(coalesce(first(
              CASE WHEN cum = below THEN lower_s
                   ELSE lower_s + (upper_s - lower_s) * ({p} * total - below) / (cum - below) END
              ORDER BY i) FILTER (cum >= {p} * total), {health.LATENCY_BOUNDS[-1]}), 12) AS {name}"""
        for name, p in health.QUANTILES.items()
    )
    return f"""
      {_bounds()},
      observed AS ({observed}),
      cumulated AS (
        SELECT {by} i, lower_s, upper_s, count(*) AS total, count(*) FILTER (v <= upper_s) AS cum
        FROM observed CROSS JOIN bounds GROUP BY ALL),
      stepped AS (
        SELECT *, coalesce(lag(cum) OVER ({f"PARTITION BY {keys}" if keys else ""} ORDER BY i), 0)
          AS below FROM cumulated),
      quantiles AS (SELECT {by} {picked} FROM stepped {f"GROUP BY {keys}" if keys else ""})
    """


def _rate(source: str, keys: str, time: str, amount: str, window_s: int, slide_s: int) -> str:
    width = slide_s * 1_000_000_000
    return f"""
      SELECT {keys}, {time} // {width} * {width} - step * {width} AS window_start_ns,
             CAST({amount} AS BIGINT) AS n,
             round({amount} / {window_s}.0::DOUBLE, 6) AS per_second
      FROM {source}, unnest(range(0, {window_s // slide_s})) AS steps(step)
      GROUP BY {keys}, window_start_ns"""


_MINUTES = (
    "SELECT timestamp_ns // 60000000000 * 60 AS minute_s, exchange, symbol, "
    "count(*) AS trade_count, round(avg(CAST(price AS DOUBLE)), 6) AS avg_price "
    "FROM ticks {where} GROUP BY minute_s, exchange, symbol"
)
_SYMBOLS = "SELECT DISTINCT exchange || ':' || symbol AS pair{more} FROM ticks ORDER BY pair"
_SPANS = {"s": 1, "m": 60, "h": 3_600, "d": 86_400}


def _width(interval: str) -> int:
    return int(interval[:-1]) * _SPANS[interval[-1]] * 1_000_000_000


# The watermark at the end of a drained stream, in nanoseconds.
_WATERMARK = "(SELECT (max(timestamp_ns) // 1000000 - 600000) * 1000000 FROM ticks)"


def all_oracles() -> dict[str, str]:
    hour, slot = _width("1h"), slot_micros(q.GAP_SECONDS) * 1_000
    _listing = _events(
        "SELECT 'exchange=' || exchange || '/symbol=' || symbol || '/date=' || CAST(date AS VARCHAR) "
        "AS partition, count(*) AS n_rows, true AS as_listed FROM ticks GROUP BY ALL"
    )
    sql = {
        "scan_ticks": _events(f"SELECT {TICK_OUT} FROM ticks"),
        "trades_range": _events(f"SELECT {TICK_OUT} FROM ticks WHERE {RANGE}"),
        "trades_exchange": _events(f"SELECT {TICK_OUT} FROM ticks WHERE {RANGE} AND {FEED}"),
        "trades_head": _events(
            f"SELECT {TICK_OUT} FROM ticks WHERE {RANGE} "
            f"ORDER BY timestamp_ns, exchange, trade_id LIMIT {q.HEAD}"
        ),
        "subscribe_filter": _events(
            f"SELECT {TICK_OUT} FROM ticks "
            "WHERE exchange = 'coinbase' AND symbol IN ('VIEW', 'CLICK')"
        ),
        "format_ticks": _events(
            "SELECT trade_id, '[' || rpad(exchange, 8, ' ') || '] ' || rpad(symbol, 10, ' ') || ' ' "
            "|| rpad(upper(side), 4, ' ') || ' ' "
            "|| lpad(regexp_replace(CAST(price AS VARCHAR), '[.]?0+$', ''), 20, ' ') || '  ×  ' "
            "|| rpad(regexp_replace(CAST(size AS VARCHAR), '[.]?0+$', ''), 18, ' ') || '  id=' "
            "|| trade_id AS line FROM ticks"
        ),
        "symbols": _events(_SYMBOLS.format(more="")),
        "symbol_parts": _events(_SYMBOLS.format(more=", exchange, symbol")),
        "minute_counts": _events(_MINUTES.format(where="")),
        "sql_minute_counts": _events(_MINUTES.format(where=f"WHERE {POOL}")),
        "vwap": _events(f"SELECT {VWAP} FROM ticks WHERE {POOL}"),
        "vwap_exchange": _events(f"SELECT {VWAP} FROM ticks WHERE {RANGE} AND {FEED}"),
        "vwap_by_symbol": _events(f"SELECT exchange, symbol, {VWAP} FROM ticks GROUP BY ALL"),
        "vwap_by_bar": _events(
            f"SELECT exchange, symbol, timestamp_ns // {_width('1h')} * {_width('1h')} AS bar_start_ns, "
            f"{VWAP} FROM ticks GROUP BY exchange, symbol, bar_start_ns"
        ),
        "vwap_exact_parts": _events(
            "SELECT exchange, symbol, "
            "CAST(CAST(sum(CAST(price AS DECIMAL(18,2)) * CAST(size AS DECIMAL(18,0))) AS DECIMAL(38,2)) AS VARCHAR) "
            "|| repeat('0', 34) AS notional, "
            "CAST(CAST(sum(CAST(size AS DECIMAL(18,0))) AS DECIMAL(38,0)) AS VARCHAR) || '.' || repeat('0', 18) AS volume "
            "FROM ticks GROUP BY exchange, symbol"
        ),
        "vwap_exact": _exact("", POOL),
        "vwap_exact_by_symbol": _exact("exchange, symbol,"),
        "vwap_exact_by_bar": _exact("exchange, symbol, timestamp_ns // 86400000000000 * 86400000000000 AS bar_start_ns,"),
        "bars_tied_1d": _events(
            f"SELECT exchange, symbol, timestamp_ns // {_width('1d')} * {_width('1d')} AS bar_start_ns, "
            + BAR_AGGREGATES.replace("DOUBLE), timestamp_ns)", "DOUBLE), {'a': timestamp_ns, 'b': event_id})")
            + " FROM (SELECT * REPLACE (timestamp_ns // 43200000000000 * 43200000000000 AS timestamp_ns) FROM ticks) "
            "GROUP BY exchange, symbol, bar_start_ns"
        ),
        "bars_pooled": _bars(_width("15m"), "", POOL),
        "bars_range": _bars(_width("4h"), "", f"{RANGE} AND {FEED}"),
        "bars_display": _events(
            f"SELECT timestamp_ns // 10000000000 * 10 AS bar_start_s, {BAR_AGGREGATES} "
            f"FROM ticks WHERE {RANGE} GROUP BY bar_start_s"
        ),
        "tree_bars_1h": _bars(_width("1h"), "", RANGE),
        "gaps": _gaps(EVENTS, "exchange, symbol,", q.GAP_SECONDS),
        "gaps_feed": _gaps(EVENTS, "", q.GAP_SECONDS, f"{POOL} AND {FEED}"),
        "gaps_short": _gaps(EVENTS, "exchange, symbol,", 0.5),
        "gaps_by_day": _gaps(
            EVENTS,
            "exchange, symbol, "
            "CAST(CAST(make_timestamp(gap_start_ns // 1000) AS DATE) AS VARCHAR) AS date,",
            q.GAP_SECONDS,
        ),
        "partition_layout": _events(
            "SELECT 'exchange=' || exchange || '/symbol=' || symbol || '/date=' || CAST(date AS VARCHAR) "
            "AS partition, count(*) AS n_rows FROM ticks GROUP BY ALL"
        ),
        "write_roundtrip": _events(f"SELECT {TICK_OUT} FROM ticks"),
        "partition_projection": _events(
            "SELECT timestamp_ns, CAST(price AS VARCHAR) AS price, CAST(size AS VARCHAR) AS size, side "
            f"FROM ticks WHERE {POOL} AND {FEED} AND date = DATE '{q.DAY}'"
        ),
        "file_totals": "SELECT count(*) AS n_rows, true AS files_as_listed, true AS bytes_as_listed FROM events",
        "file_inventory": _listing,
        "scan_empty": _events(f"SELECT {TICK_OUT} FROM ticks WHERE false"),
        "time_forms": _events(
            f"SELECT form, count(*) AS n_ticks, min(timestamp_ns) AS first_ns, max(timestamp_ns) AS last_ns FROM ticks, "
            f"(SELECT unnest({list(q.TIME_FORMS)}) AS form) WHERE {RANGE} GROUP BY form"
        ),
        "interval_forms": _events(
            " UNION ALL ".join(
                f"SELECT '{i}' AS interval, count(DISTINCT timestamp_ns // {_width(i)}) AS n_bars, "
                f"{len(q.REFUSED_INTERVALS)} AS n_refused FROM ticks WHERE {POOL}"
                for i in q.BAR_INTERVALS
            )
        ),
        "row_count": "SELECT count(*) AS n_rows, count(*) AS n_listed FROM events",
        "float_refused": _events("SELECT 2 AS n_refused, count(*) AS n_good FROM ticks WHERE price > 0"),
        "store_answers": _events(
            f"""SELECT (SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT DISTINCT exchange || ':' || symbol AS p FROM ticks)) AS symbols,
              (SELECT count(*) FROM ticks WHERE {RANGE} AND {FEED}) AS n_trades,
              (SELECT count(DISTINCT timestamp_ns // {_width("4h")}) FROM ticks WHERE {RANGE}) AS n_bars,
              (SELECT count(*) FROM (SELECT timestamp_ns - lag(timestamp_ns) OVER (ORDER BY timestamp_ns) AS d
                 FROM ticks WHERE {POOL} AND {FEED}) WHERE d > {int(q.GAP_SECONDS * 1e9)}) AS n_gaps,
              (SELECT CAST(w // {10**18}::HUGEINT AS VARCHAR) || '.' || lpad(CAST(w % {10**18}::HUGEINT AS VARCHAR), 18, '0')
                 FROM (SELECT n // v + CASE WHEN 2 * (n % v) + (n // v) % 2 > v THEN 1 ELSE 0 END AS w
                   FROM (SELECT sum(CAST(price * 100 AS HUGEINT) * {10**16}::HUGEINT * CAST(size AS HUGEINT)) AS n,
                           CAST(sum(CAST(size AS HUGEINT)) AS HUGEINT) AS v FROM ticks WHERE {RANGE}))) AS exact,
              (SELECT {VWAP} FROM ticks WHERE {RANGE}) AS vwap, (SELECT count(*) FROM ticks WHERE {POOL}) AS n_sql"""
        ),
        "published_ticks": _events(f"SELECT {TICK_OUT} FROM ticks"),
        "published_range": _events(f"SELECT {TICK_OUT} FROM ticks WHERE {RANGE} AND {FEED}"),
        "published_inventory": _listing,
        "manifest_ranges": _events(
            "SELECT exchange, symbol, CAST(date AS VARCHAR) AS date, count(*) AS n_rows, "
            "min(timestamp_ns) AS min_ns, max(timestamp_ns) AS max_ns FROM ticks GROUP BY exchange, symbol, date"
        ),
        "atomic_publish": _events(f"SELECT {TICK_OUT} FROM ticks WHERE event_id % 3 <> 2"),
        "compacted_ticks": _events(f"SELECT {TICK_OUT}, 1 AS n_files FROM ticks"),
        "bulk_vwap": _bulk(f"SELECT exchange, symbol, {VWAP} FROM ticks GROUP BY ALL"),
        "bulk_bars_1d": _bulk(
            f"SELECT exchange, symbol, timestamp_ns // {_width('1d')} * {_width('1d')} AS bar_start_ns, "
            f"{TIED_AGGREGATES} FROM ticks GROUP BY exchange, symbol, bar_start_ns"
        ),
        "bulk_gaps": _gaps(BULK, "exchange, symbol,", 600.0),
        "bulk_minute_counts": _bulk(_MINUTES.format(where="")),
        "decode_binance": _events(
            f"SELECT {TICK_OUT} FROM frame_ticks WHERE exchange = 'binance'", FRAMES
        ),
        "decode_coinbase": _events(
            f"SELECT {TICK_OUT} FROM frame_ticks WHERE exchange = 'coinbase'", FRAMES
        ),
        "decode_python_feed": _events(
            f"SELECT {TICK_OUT} FROM frame_ticks WHERE exchange = 'binance'", FRAMES
        ),
        "decode_per_trade": _events(f"SELECT {TICK_OUT} FROM all_good_ticks", FRAMES),
        "frames_raw": _events("SELECT exchange AS source, raw, received_ns FROM frames", FRAMES),
        "frames_source": _events("SELECT exchange AS source, count(*) AS n_frames FROM ticks GROUP BY ALL"),
        "parse_errors": _events(
            "SELECT exchange AS source, received_ns, reason, substring(raw, 1, 300) AS excerpt "
            "FROM decoded WHERE reason IS NOT NULL",
            FRAMES,
        ),
        "frame_filter": _events(
            """SELECT exchange,
                 CASE WHEN reason IS NOT NULL THEN 'error' WHEN n_ticks = 0 THEN 'ignored'
                      ELSE 'parsed' END AS status,
                 count(*) AS n_frames, CAST(sum(n_ticks) AS BIGINT) AS n_ticks
               FROM decoded GROUP BY exchange, status""",
            FRAMES,
        ),
        "iso_to_ns": "SELECT event_id, epoch_us(ts) * 1000 AS timestamp_ns FROM events",
        "safe_component": (
            r"SELECT page_id, regexp_replace(url, '[^\p{L}\p{N}_\-.]', '_', 'g') AS component FROM pages"
        ),
        "validate_ticks": _events(
            f"SELECT {TICK_OUT} FROM ticks WHERE event_id % 20 NOT BETWEEN 1 AND 9 AND price > 0"
        ),
        "quarantine_counts": _events(
            """SELECT CASE
                 WHEN kind = 3 THEN 'missing or empty field'
                 WHEN kind = 2 OR (kind <> 7 AND price = 0) THEN 'price must be > 0'
                 WHEN kind = 7 THEN 'scale_overflow'
                 WHEN kind = 6 THEN 'Cannot convert price or size to a decimal'
                 WHEN kind = 8 THEN 'size must be > 0'
                 WHEN kind = 1 THEN 'Unknown side'
                 WHEN kind = 4 THEN 'time is before 2010-01-01'
                 WHEN kind = 9 THEN 'time is more than 10 years in the future'
                 WHEN kind = 5 THEN 'received before the trade, check clock sync' END AS reason,
                 count(*) AS n_rows
               FROM (SELECT *, event_id % 20 AS kind FROM ticks) WHERE kind BETWEEN 1 AND 9 OR price = 0
               GROUP BY reason"""
        ),
        "m_received": _events("SELECT exchange, count(*) AS n_frames FROM ticks GROUP BY ALL"),
        "m_parsed": _events(
            "SELECT exchange, symbol, count(*) AS n_ticks FROM frame_ticks GROUP BY ALL", FRAMES
        ),
        "m_errors": _events(
            "SELECT exchange, count(reason) AS n_errors FROM decoded GROUP BY ALL", FRAMES
        ),
        "m_written": _events(
            "SELECT exchange, symbol, CAST(sum(n_ticks) AS BIGINT) AS n_ticks FROM write_log "
            "GROUP BY exchange, symbol",
            WRITE_LOG,
        ),
        "m_totals": _events(
            """SELECT 'received' AS counter, count(*) AS total FROM decoded
               UNION ALL SELECT 'parse_errors', count(reason) FROM decoded
               UNION ALL SELECT 'written', CAST(sum(n_ticks) AS BIGINT) FROM write_log""",
            FRAMES,
            WRITE_LOG,
        ),
        "m_staleness": _events(
            f"SELECT exchange, symbol, ({tables.AS_OF_NS} - max(received_ns)) / 1e9 AS age_s "
            "FROM ticks GROUP BY ALL"
        ),
        "m_staleness_level": _events(
            """SELECT exchange, symbol, age_s, CASE WHEN age_s >= 120 THEN 'red'
                 WHEN age_s >= 30 THEN 'yellow' ELSE 'green' END AS level
               FROM (SELECT exchange, symbol, (1706659200000000000 - max(received_ns)) / 1e9 AS age_s
                     FROM ticks GROUP BY ALL)"""
        ),
        "m_summary": _events(
            """SELECT exchange, received_ns // 10000000000 * 10000000000 AS window_start_ns,
                 round(count(*) / 10.0::DOUBLE, 1) AS msgs_per_sec
               FROM ticks GROUP BY exchange, window_start_ns"""
        ),
        "stream_write": _events(f"SELECT {TICK_OUT} FROM ticks"),
        "stream_decode": _events(f"SELECT {TICK_OUT} FROM frame_ticks", FRAMES),
        "stream_drain": _events(f"SELECT {TICK_OUT} FROM frame_ticks", FRAMES),
        "stream_published": _events(f"SELECT {TICK_OUT} FROM frame_ticks", FRAMES),
        "m_run_summary": _events(
            """SELECT count(DISTINCT received_ns // 86400000000000 % 2) AS n_batches, count(*) AS n_frames,
                 count(reason) AS n_errors, CAST(sum(n_ticks) AS BIGINT) AS n_ticks,
                 true AS files_as_listed, true AS has_rate FROM decoded""",
            FRAMES,
        ),
        "m_stream_written": _events(
            "SELECT exchange, symbol, count(*) AS n_ticks FROM frame_ticks GROUP BY ALL", FRAMES
        ),
        "m_stream_latency": _events(
            """SELECT exchange, symbol, count(DISTINCT received_ns // 86400000000000 % 2) AS n_writes,
                 count(DISTINCT received_ns // 86400000000000 % 2) AS cumulative, true AS timed
               FROM frame_ticks GROUP BY exchange, symbol""",
            FRAMES,
        ),
        "stream_corrected_bars": _bars(_width("1h")),
        "stream_restart": _events(f"SELECT {TICK_OUT} FROM frame_ticks", FRAMES),
        "stream_union": _events(f"SELECT {TICK_OUT} FROM frame_ticks", FRAMES),
        "stream_bars": _events(
            f"SELECT exchange, symbol, timestamp_ns // {hour} * {hour} AS bar_start_ns, "
            f"{BAR_AGGREGATES} FROM ticks GROUP BY exchange, symbol, bar_start_ns "
            f"HAVING bar_start_ns + {hour} <= {_WATERMARK}"
        ),
        # A gap is out once the watermark has passed the slot its end lies in.
        "stream_gaps": _gaps(
            EVENTS, "exchange, symbol,", q.GAP_SECONDS,
            more=f"AND (gap_end_ns // {slot} + 1) * {slot} <= {_WATERMARK}",
        ),
        "m_latency_hist": _events(
            f"""SELECT le, cumulative, n_writes, total_s FROM (
                  SELECT le, count(*) FILTER (latency_s <= upper_s) AS cumulative,
                         count(*) AS n_writes, round(sum(latency_s), 6) AS total_s
                  FROM write_log CROSS JOIN bounds GROUP BY le
                  UNION ALL
                  SELECT '+Inf', count(*), count(*), round(sum(latency_s), 6) FROM write_log)""",
            WRITE_LOG, _bounds(),
        ),
        "m_latency_q": _events(
            "SELECT * FROM quantiles",
            WRITE_LOG, _quantiles("SELECT latency_s AS v FROM write_log", ""),
        ),
        "m_latency_q_5m": _events(
            "SELECT * FROM quantiles",
            WRITE_LOG,
            _quantiles(
                "SELECT at_ns // 300000000000 * 300000000000 AS window_start_ns, latency_s AS v "
                "FROM write_log", "window_start_ns",
            ),
        ),
        "m_latency_exact": _events(
            "SELECT exchange, count(*) AS n_writes, "
            + ", ".join(f"round(quantile_cont(CAST(latency_s AS DOUBLE), {p}), 9) AS {n}" for n, p in health.QUANTILES.items())
            + " FROM write_log GROUP BY exchange",
            WRITE_LOG,
        ),
        "m_latency_approx": _events(
            "SELECT exchange, count(*) AS n_writes, "
            + ", ".join(f"quantile_disc(CAST(latency_s AS DOUBLE), {p}) AS {n}" for n, p in health.QUANTILES.items())
            + " FROM write_log GROUP BY exchange",
            WRITE_LOG,
        ),
        "m_latency_sketch": _events(
            "SELECT exchange, symbol, count(*) AS n, true AS p50_close, true AS p95_close, true AS p99_close "
            f"FROM ticks WHERE date < DATE '{q.DAY}' GROUP BY exchange, symbol"
        ),
        "m_feed_latency": _events(
            "SELECT exchange, symbol, count(*) AS n_ticks, count(*) FILTER (v < 0) AS n_negative, "
            "min(v) AS min_s, max(v) AS max_s, CAST(sum(ns) AS DOUBLE) / count(*) / 1e9 AS mean_s, "
            + ", ".join(
                f"round(quantile_cont(v, {p}), 9) AS {name}" for name, p in health.QUANTILES.items()
            )
            + " FROM (SELECT exchange, symbol, received_ns - timestamp_ns AS ns, "
            "(received_ns - timestamp_ns) / 1e9 AS v FROM ticks) GROUP BY exchange, symbol"
        ),
        "m_rate_1m": _events(_rate("ticks", "exchange", "received_ns", "count(*)", 60, 60)),
        "m_rate_5m": _events(_rate("ticks", "exchange, symbol", "received_ns", "count(*)", 300, 60)),
        "m_write_rate": _events(
            _rate("write_log", "exchange, symbol", "at_ns", "sum(n_ticks)", 300, 60), WRITE_LOG
        ),
        "m_error_rate": _events(
            _rate("(FROM decoded WHERE reason IS NOT NULL) AS failed", "exchange", "received_ns",
                  "count(*)", 60, 60),
            FRAMES,
        ),
    }
    for interval in q.BAR_INTERVALS:
        sql[f"bars_{interval}"] = _bars(_width(interval))
    return sql
