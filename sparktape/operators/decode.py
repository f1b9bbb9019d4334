"""Raw exchange frames -> ticks, as column expressions inside the row (no shuffle).

A decoder turns the text of one frame into `struct(bad, trades)`:

* `bad`: why the frame as a whole cannot be read, else NULL;
* `trades`: the candidate trades of the frame, in order; empty for a frame without trades.

Everything after that is common to all feeds: the tick rules, and what a bad trade does to
the rest of its frame. Such a frame is either `parsed`, `ignored` (no trade in it) or an
`error`; an error frame still yields the trades before the first bad one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import excerpt, iso_to_ns_sql, utc_date
from ..schema import STORED_COLS, TICK_COLS
from .validate import clock_sql, money_sql, tick_reason

CANDIDATE_FIELDS = ["symbol", "price", "size", "side", "timestamp_ns", "trade_id"]
CANDIDATES = (
    "ARRAY<STRUCT<symbol:STRING,price:STRING,size:STRING,side:STRING,"
    "timestamp_ns:BIGINT,trade_id:STRING>>"
)
_NOTHING = f"CAST(array() AS {CANDIDATES})"
MALFORMED = "malformed JSON"
NOT_OBJECT = "frame is not an object"
NOT_UTF8 = "frame is not UTF-8"
NO_DECODER = "no decoder for this source"

_JSON = "map('allowSingleQuotes', 'false')"


@dataclass(frozen=True)
class Decoder:
    """`stages` parse the frame, each from the one before; `read` shapes the last one.

    The functions get column names and return columns: a stage that of the stage before
    (the frame text for the first), `read` that of the last stage and of the text. Each
    stage becomes a column of its own, so the JSON text is parsed once however often
    `read` refers to it.
    """

    name: str
    stages: tuple[Callable[[str], Column], ...]
    read: Callable[[str, str], Column]


_DECODERS: dict[str, Decoder] = {}


def register_decoder(decoder: Decoder) -> Decoder:
    """Make a feed known under its exchange name; a later one of that name replaces it."""
    _DECODERS[decoder.name] = decoder
    return decoder


def decoders() -> dict[str, Decoder]:
    return dict(_DECODERS)


def candidate_sql(**fields: str) -> str:
    """SQL for one candidate trade; a field left out is missing."""
    missing = {c: f"CAST(NULL AS {'BIGINT' if c == 'timestamp_ns' else 'STRING'})" for c in CANDIDATE_FIELDS}
    return f"struct({', '.join(f'{sql} AS {c}' for c, sql in (missing | fields).items())})"


def outcome_sql(bad: str, trades: str) -> str:
    return f"struct(CAST({bad} AS STRING) AS bad, {trades} AS trades)"


def strict_json(text: str, schema: str) -> Column:
    """Parse a whole frame into `struct(f, z)`; NULL unless the text is one JSON value.

    An array of the text and its own hash must have just these two elements: whatever
    follows the value in the text breaks the array or adds to it, and no text can contain
    its own hash.
    """
    wrapped = f"""'{{"f":' || {text} || ',"z":1}}'"""
    mark = f"CAST(xxhash64({text}) AS STRING)"
    alone = f"""from_json('[' || {text} || ',"' || {mark} || '"]', 'array<string>', {_JSON})"""
    whole = f"from_json({wrapped}, 'f {schema}, z int', {_JSON})"
    return F.expr(
        f"transform(array({alone}), a -> CASE WHEN size(a) = 2 AND a[1] = {mark} THEN {whole} END)[0]"
    )


def root_fault(parsed: str) -> str:
    return (
        f"CASE WHEN {parsed}.z IS NULL THEN '{MALFORMED}' "
        f"WHEN {parsed}.f IS NULL THEN '{NOT_OBJECT}' END"
    )


# -- Binance: one trade per frame; key names differ only in case, hence a map ------------


def _binance_trade(parsed: str) -> Column:
    """(fault, fields): the trade object, bare or under `data` on combined streams."""
    return F.expr(
        f"""struct({root_fault(parsed)} AS fault,
          CASE WHEN map_contains_key({parsed}.f, 'data')
               THEN from_json({parsed}.f['data'], 'map<string,string>', {_JSON})
               ELSE {parsed}.f END AS fields)"""
    )


def _binance_read(trade: str, text: str) -> Column:
    maker = f"{trade}.fields['m']"
    one = candidate_sql(
        symbol=f"{trade}.fields['s']",
        price=f"{trade}.fields['p']",
        size=f"{trade}.fields['q']",
        side=f"CASE WHEN {maker} IN ('false', '0', '') THEN 'buy' WHEN {maker} IS NOT NULL THEN 'sell' END",
        timestamp_ns=f"try_multiply(try_cast({trade}.fields['T'] AS BIGINT), 1000000L)",
        trade_id=f"{trade}.fields['t']",
    )
    bad = f"CASE WHEN {trade}.fields IS NULL THEN '{NOT_OBJECT}' END"
    is_trade = f"{trade}.fault IS NULL AND {trade}.fields['e'] = 'trade'"
    return F.expr(
        outcome_sql(
            f"coalesce({trade}.fault, {bad})",
            f"CASE WHEN {is_trade} THEN array({one}) ELSE {_NOTHING} END",
        )
    )


# -- Coinbase: events with any number of trades each -------------------------------------

_COINBASE_FRAME = (
    "struct<channel:string,events:array<struct<type:string,trades:array<struct<"
    "trade_id:string,product_id:string,price:string,size:string,side:string,time:string>>>>>"
)


def _not_a_list(text: str, key: str) -> str:
    """The key is there but holds no list. Looked up only where decoding found nothing."""
    return rf"""{text} RLIKE r'"{key}"\s*:\s*[^\[\s]'"""


def _coinbase_read(parsed: str, text: str) -> Column:
    # Breaks the first rule, so the frame becomes an error at this trade.
    unreadable = f"array({candidate_sql()})"
    trade = candidate_sql(
        symbol="t.product_id",
        price="t.price",
        size="t.size",
        side="lower(t.side)",
        timestamp_ns=iso_to_ns_sql("t.time"),
        trade_id="t.trade_id",
    )
    event_trades = f"""
      CASE WHEN e IS NULL THEN {unreadable}
           WHEN NOT coalesce(e.type IN ('update', 'snapshot'), false) THEN {_NOTHING}
           WHEN e.trades IS NOT NULL THEN transform(e.trades, t -> {trade})
           WHEN {_not_a_list(text, "trades")} THEN {unreadable}
           ELSE {_NOTHING} END"""
    trades = f"""
      CASE WHEN {parsed}.z IS NULL OR NOT coalesce({parsed}.f.channel = 'market_trades', false)
                THEN {_NOTHING}
           WHEN {parsed}.f.events IS NOT NULL
                THEN flatten(transform({parsed}.f.events, e -> {event_trades}))
           WHEN {_not_a_list(text, "events")} THEN {unreadable}
           ELSE {_NOTHING} END"""
    return F.expr(outcome_sql(root_fault(parsed), trades))


BINANCE = register_decoder(
    Decoder(
        "binance",
        (lambda text: strict_json(text, "map<string,string>"), _binance_trade),
        _binance_read,
    )
)
COINBASE = register_decoder(
    Decoder("coinbase", (lambda text: strict_json(text, _COINBASE_FRAME),), _coinbase_read)
)


# -- feeds read by Python -----------------------------------------------------------------

# Text of a frame -> its trades, as mappings with `CANDIDATE_FIELDS`; raises `ValueError`, whose
# text becomes the reason, where the frame cannot be read.
FrameReader = Callable[[str], Iterable[Mapping[str, object]]]


def _reader_udtf(parse: FrameReader, unreadable: str):
    """A table function of one row per frame: `bad` and `trades`, as a SQL decoder gives them."""

    class ReadFrame:
        def eval(self, raw: str):
            if raw is None:
                yield unreadable, []
                return
            try:
                found = [tuple(trade.get(c) for c in CANDIDATE_FIELDS) for trade in parse(raw)]
            except ValueError as error:
                yield str(error) or MALFORMED, []
                return
            yield None, found

    return F.udtf(ReadFrame, returnType=f"bad STRING, trades {CANDIDATES}")


# -- common part --------------------------------------------------------------------------


def decode_frames(
    frames: DataFrame,
    now_ns: int | None = None,
    on_error: str = "prefix",
    python_feeds: Mapping[str, FrameReader] | None = None,
) -> DataFrame:
    """Frames with `status`, `reason` and the good `trades` of each, in one narrow pass.

    `on_error="prefix"` drops the trades after the first bad one of a frame;
    `"per_trade"` drops only the bad ones. Works on tables and on streams.

    `python_feeds` names sources whose frames no SQL expression can read, each with a Python
    function. Their frames alone go through Python workers, by a table function; tick rules
    and all that follows are the same. Such a source takes the place of a SQL decoder of its
    name, and makes for one more scan of the frames.
    """
    if on_error not in ("prefix", "per_trade"):
        raise ValueError(f"on_error must be 'prefix' or 'per_trade', not {on_error!r}")
    binary = isinstance(frames.schema["raw"].dataType, T.BinaryType)
    known = list(_DECODERS.values())
    text = F.expr("try_validate_utf8(CAST(raw AS STRING))") if binary else F.col("raw")
    rows = frames.select("source", "raw", "received_ns", text.alias("_text"))

    unreadable = NOT_UTF8 if binary else MALFORMED
    by_python = dict(python_feeds or {})
    read_by_python = [
        rows.where(F.col("source") == name)
        .lateralJoin(_reader_udtf(parse, unreadable)(F.col("_text").outer()))
        .select("source", "raw", "received_ns", F.struct("bad", "trades").alias("_read"))
        for name, parse in by_python.items()
    ]
    if by_python:
        rows = rows.where(~F.coalesce(F.col("source").isin(list(by_python)), F.lit(False)))

    # One chain of parse columns per feed; a row runs only the chain of its own source.
    for depth in range(max(len(decoder.stages) for decoder in known)):
        stage_columns = {}
        for decoder in known:
            if depth < len(decoder.stages):
                before = f"_{decoder.name}_{depth - 1}" if depth else "_text"
                stage_columns[f"_{decoder.name}_{depth}"] = F.when(
                    F.col("source") == decoder.name, decoder.stages[depth](before)
                )
        rows = rows.withColumns(stage_columns)

    def failed(reason: str) -> Column:
        return F.expr(outcome_sql(f"'{reason}'", _NOTHING))

    read = F.when(F.col("_text").isNull(), failed(unreadable))
    for decoder in known:
        outcome = decoder.read(f"_{decoder.name}_{len(decoder.stages) - 1}", "_text")
        read = read.when(F.col("source") == decoder.name, outcome)

    clock = clock_sql(now_ns)

    def reason_of(trade: str) -> str:
        fields = {c: f"{trade}.{c}" for c in CANDIDATE_FIELDS}
        return tick_reason(fields | {"exchange": "source", "received_ns": "received_ns"}, clock)

    # Most frames hold one trade. Its rules run as generated code; array functions do not.
    reasons = f"""
      CASE WHEN size(_read.trades) = 1 THEN array({reason_of("get(_read.trades, 0)")})
           ELSE transform(_read.trades, t -> {reason_of("t")}) END"""
    first_reason = """
      CASE WHEN size(_reasons) <= 1 THEN get(_reasons, 0)
           ELSE get(filter(_reasons, r -> r IS NOT NULL), 0) END"""
    first_bad = "CAST(array_position(transform(_reasons, r -> r IS NOT NULL), true) AS INT)"
    kept = {
        "prefix": f"slice(_read.trades, 1, {first_bad} - 1)",
        "per_trade": "filter(_read.trades, (t, i) -> _reasons[i] IS NULL)",
    }[on_error]
    rows = rows.withColumn("_read", read.otherwise(failed(NO_DECODER)))
    for part in read_by_python:
        rows = rows.select("source", "raw", "received_ns", "_read").unionByName(part)
    staged = (
        rows.withColumn("_reasons", F.expr(reasons))
        .withColumn("_bad", F.expr(first_reason))
        .selectExpr(
            "source", "raw", "received_ns",
            f"CASE WHEN _bad IS NULL THEN _read.trades ELSE {kept} END AS trades",
            "coalesce(_read.bad, _bad) AS reason",
        )
    )
    # A one-element generator: filters on the outcome stay above it. Pushed down to the scan
    # they would repeat the whole decoding once more for every row.
    return staged.selectExpr(
        "source", "raw", "received_ns",
        """explode(array(struct(
             CASE WHEN reason IS NOT NULL THEN 'error' WHEN size(trades) = 0 THEN 'ignored'
                  ELSE 'parsed' END AS status, reason, trades))) AS _out""",
    ).select("source", "raw", "received_ns", "_out.status", "_out.reason", "_out.trades")


def frame_ticks(decoded: DataFrame) -> DataFrame:
    """The ticks of decoded frames, 0..n per frame. Text becomes decimals here, once per tick."""
    typed = {c: f"t.{c}" for c in CANDIDATE_FIELDS} | {"exchange": "exchange"}
    typed |= {c: money_sql(f"t.{c}") for c in ("price", "size")} | {"received_ns": "received_ns"}
    return (
        decoded.selectExpr("source AS exchange", "received_ns", "explode(trades) AS t")
        .selectExpr(*(f"{typed[c]} AS {c}" for c in TICK_COLS))
        .withColumn("date", utc_date(F.col("timestamp_ns")))
        .select(*STORED_COLS)
    )


def frame_errors(decoded: DataFrame) -> DataFrame:
    """Frames that failed, with the reason and the start of the frame."""
    binary = isinstance(decoded.schema["raw"].dataType, T.BinaryType)
    return decoded.where(F.col("status") == "error").select(
        "source", "received_ns", "reason", excerpt(F.col("raw"), binary=binary).alias("excerpt")
    )


def subscribed(ticks: DataFrame, symbols: list[str], exchange: str) -> DataFrame:
    """Ticks of a feed's subscribed symbols, which users may write in any case.

    Subscriptions are lower-case on Binance and upper-case on Coinbase; stored symbols
    are compared in that same form.
    """
    if not symbols:
        raise ValueError("At least one symbol must be provided")
    fold, wanted = (
        (F.lower, [s.lower() for s in symbols])
        if exchange == "binance"
        else (F.upper, [s.upper() for s in symbols])
    )
    return ticks.where((F.col("exchange") == exchange) & fold("symbol").isin(wanted))
