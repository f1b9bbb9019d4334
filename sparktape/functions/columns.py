"""Column expressions shared by batch and streaming jobs. All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeargs import NS_PER_DAY

# Fixed value: characters kept in a path component (letters, digits, underscore, hyphen, dot).
UNSAFE_PATH_CHARS = r"[^\p{L}\p{N}_\-.]"
_ISO_UTC = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d*)?Z*$"


def long_div(value: Column, width: int) -> Column:
    """Integer quotient of two longs, truncating like SQL `div`."""
    return F.call_function("div", value, F.lit(width))


def floor_slot(value: Column, width: int) -> Column:
    """Index of the `width`-wide slot that holds `value`; exact below zero as well."""
    return long_div(value - F.pmod(value, F.lit(width).cast("long")), width)


def bar_start(interval_ns: int, time: str = "timestamp_ns") -> Column:
    """Start of the epoch-aligned bar that holds a tick."""
    return long_div(F.col(time), interval_ns) * F.lit(interval_ns).cast("long")


def as_double(name: str) -> Column:
    """A decimal(38,18) column as the nearest double.

    The JVM turns a wide decimal into a double by way of text. Numbers that fit
    decimal(18,8) without loss, which is nearly all prices and sizes, take a short cut with
    the same result.
    """
    narrow = f"try_cast({name} AS DECIMAL(18,8))"
    return F.expr(
        f"CASE WHEN {narrow} = {name} THEN CAST({narrow} AS DOUBLE) ELSE CAST({name} AS DOUBLE) END"
    )


def utc_date(ns: Column) -> Column:
    """UTC calendar day of a nanosecond time, by integer arithmetic."""
    return F.date_from_unix_date(floor_slot(ns, NS_PER_DAY).cast("int"))


def ns_to_timestamp(ns: Column) -> Column:
    """Microsecond timestamp for windows and watermarks; the long stays the exact time."""
    return F.timestamp_micros(long_div(ns, 1_000))


def iso_to_ns_sql(text: str) -> str:
    """SQL for ISO-8601 UTC text -> nanoseconds; fraction cut or padded to nine digits."""
    return rf"""
      CASE WHEN {text} RLIKE r'{_ISO_UTC}' THEN try_add(
        try_multiply(
          CAST(try_cast(substr({text}, 1, 19) AS TIMESTAMP_NTZ)
               - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS BIGINT), 1000000000L),
        CAST(rpad(substr(regexp_extract({text}, r'[.](\d*)', 1), 1, 9), 9, '0') AS BIGINT))
      END"""


def iso_to_ns(name: str) -> Column:
    """ISO-8601 text column -> nanoseconds, NULL where the text is no UTC time."""
    return F.expr(iso_to_ns_sql(name))


def safe_component(text: Column) -> Column:
    """Path-safe form of a name; every other character becomes an underscore."""
    return F.regexp_replace(text, UNSAFE_PATH_CHARS, "_")


def pair_label() -> Column:
    return F.concat_ws(":", "exchange", "symbol")


def split_pair(pair: Column) -> tuple[Column, Column]:
    """Exchange and symbol of a pair label; the symbol may hold further colons."""
    parts = F.split(pair, ":", 2)
    return parts[0], parts[1]


def plain_number(value: Column) -> Column:
    """Decimal as text without trailing zeros."""
    return F.regexp_replace(value.cast("string"), r"[.]?0+$", "")


def excerpt(raw: Column, *, binary: bool = False) -> Column:
    """First 300 characters of a frame, or the first 300 bytes in hex."""
    return F.lower(F.hex(F.substring(raw, 1, 300))) if binary else F.substring(raw, 1, 300)


def tick_line() -> Column:
    """One fixed-width console line per tick."""
    return F.format_string(
        "[%-8s] %-10s %-4s %20s  ×  %-18s  id=%s",
        "exchange",
        "symbol",
        F.upper("side"),
        plain_number(F.col("price")),
        plain_number(F.col("size")),
        "trade_id",
    )
