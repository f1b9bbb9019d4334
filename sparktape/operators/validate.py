"""Tick rules: every row either is a tick or carries the reason why it is not.

Rules are SQL expressions over named fields, so the same text checks table rows, array
elements inside a frame, and streams. `now_ns` is an argument; only its default reads the
clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import utc_date
from ..schema import MONEY, STORED_COLS, TICK_COLS

# Earliest plausible time (2010-01-01 UTC), furthest future, clock tolerance.
MIN_TIME_NS = 1_262_304_000_000_000_000
MAX_FUTURE_NS = 3_650 * 86_400 * 1_000_000_000
CLOCK_TOLERANCE_NS = 1_000_000_000

MISSING = "missing or empty field"
NOT_DECIMAL = "Cannot convert price or size to a decimal"
PRICE_SIGN = "price must be > 0"
SIZE_SIGN = "size must be > 0"
SCALE = "scale_overflow"
SIDE = "Unknown side"
TIME = "time is not readable"
TOO_OLD = "time is before 2010-01-01"
TOO_LATE = "time is more than 10 years in the future"
CLOCK = "received before the trade, check clock sync"

# Plain positive numbers that fit: at most 20 and 18 digits, one of them not zero.
_PLAIN = r"^(?=.*[1-9])\d{1,20}([.]\d{1,18})?$"
_NUMBER = r"^([+-]?)(\d*)[.]?(\d*)(?:[eE]([+-]?\d{1,9}))?$"

def clock_sql(now_ns: int | None) -> str:
    """The given time, or the wall clock, fixed once per batch query or micro-batch."""
    return "unix_micros(current_timestamp()) * 1000" if now_ns is None else f"{now_ns}L"


def money_sql(text: str) -> str:
    return f"try_cast({text} AS DECIMAL(38,18))"


def _text_money_reason(text: str, sign_reason: str) -> str:
    """Reason why number text is no positive decimal(38,18), or NULL.

    Nearly all text takes the first branch. The rest is judged by its digits, so text with
    an exponent or with too many digits gets the right reason without a lossy cast.
    """
    bare = f"trim({text})"
    whole, part, exponent = (f"regexp_extract({bare}, r'{_NUMBER}', {i})" for i in (2, 3, 4))
    exponent = f"coalesce(try_cast({exponent} AS INT), 0)"
    digits = f"({whole} || {part})"
    significant = f"trim(LEADING '0' FROM {digits})"
    trailing = f"(length({digits}) - length(trim(TRAILING '0' FROM {digits})))"
    leading = f"(length({digits}) - length({significant}))"
    return f"""
      CASE WHEN {text} RLIKE r'{_PLAIN}' THEN NULL
           WHEN {text} IS NULL THEN '{MISSING}'
           WHEN NOT {bare} RLIKE r'{_NUMBER}' OR {digits} = '' THEN '{NOT_DECIMAL}'
           WHEN {significant} = '' OR startswith({bare}, '-') THEN '{sign_reason}'
           WHEN length({part}) - {trailing} - {exponent} > 18 THEN '{SCALE}'
           WHEN length({whole}) - {leading} + {exponent} > 20 THEN '{SCALE}' END"""


def _typed_money_reason(value: str, sign_reason: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '{MISSING}' WHEN {value} <= 0 THEN '{sign_reason}' END"


def tick_reason(fields: dict[str, str], now: str, *, text: bool = True) -> str:
    """SQL for the first broken rule of a candidate tick, or NULL.

    `fields` maps the eight tick columns to SQL; `text` says that price and size are text.
    """
    money_reason = _text_money_reason if text else _typed_money_reason
    blank = " OR ".join(
        f"coalesce(length({fields[c]}) < 1, true)" for c in ("exchange", "symbol", "trade_id")
    )
    side, traded, received = fields["side"], fields["timestamp_ns"], fields["received_ns"]
    latest = f"({now} + {MAX_FUTURE_NS}L)"
    return f"""
      coalesce(
        CASE WHEN {blank} THEN '{MISSING}' END,
        {money_reason(fields["price"], PRICE_SIGN)},
        {money_reason(fields["size"], SIZE_SIGN)},
        CASE WHEN {side} IS NULL THEN '{MISSING}'
             WHEN {side} NOT IN ('buy', 'sell') THEN '{SIDE}'
             WHEN {traded} IS NULL OR {received} IS NULL THEN '{TIME}'
             WHEN {traded} < {MIN_TIME_NS}L OR {received} < {MIN_TIME_NS}L THEN '{TOO_OLD}'
             WHEN {traded} > {latest} OR {received} > {latest} THEN '{TOO_LATE}'
             WHEN {received} < {traded} - {CLOCK_TOLERANCE_NS}L THEN '{CLOCK}' END)"""


def check_ticks(candidates: DataFrame, now_ns: int | None = None) -> DataFrame:
    """Add `reason` (NULL for a good row) to rows that have the eight tick columns.

    Price and size may be text, integers or decimals; floating point is refused outright.
    """
    money_types = [candidates.schema[name].dataType for name in ("price", "size")]
    if any(isinstance(kind, (T.FloatType, T.DoubleType)) for kind in money_types):
        raise ValueError("float is not allowed for price or size: use text or decimals")
    fits = all(kind == MONEY for kind in money_types)
    rows = candidates
    if not fits:
        # Any other exact type is judged by its digits.
        rows = rows.withColumns({c: F.col(c).cast("string") for c in ("price", "size")})
    reason = tick_reason({c: c for c in TICK_COLS}, clock_sql(now_ns), text=not fits)
    return rows.withColumn("reason", F.expr(reason))


def good_ticks(checked: DataFrame) -> DataFrame:
    """Typed ticks among checked rows."""
    return (
        checked.where(F.col("reason").isNull())
        .withColumns({c: F.expr(money_sql(c)) for c in ("price", "size")})
        .withColumn("date", utc_date(F.col("timestamp_ns")))
        .select(*STORED_COLS)
    )


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows that broke a rule, with the reason."""
    return checked.where(F.col("reason").isNotNull())


def split_valid(
    candidates: DataFrame, now_ns: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(ticks, quarantine) of a table or stream of candidate rows."""
    checked = check_ticks(candidates, now_ns)
    return good_ticks(checked), quarantined(checked)


def quarantine_counts(checked: DataFrame) -> DataFrame:
    return quarantined(checked).groupBy("reason").agg(F.count("*").alias("n_rows"))
