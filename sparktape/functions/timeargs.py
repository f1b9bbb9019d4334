"""Driver-side arguments: time bounds and bar intervals become plain integers."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

TimeInput = datetime | str | int

NS_PER_SECOND = 1_000_000_000
NS_PER_DAY = 86_400 * NS_PER_SECOND
MIN_LONG, MAX_LONG = -(2**63), 2**63 - 1

# Seconds per interval unit.
_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3_600, "d": 86_400}
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)


def to_ns(when: TimeInput) -> int:
    """Nanoseconds since the epoch; naive datetimes are UTC, integers pass through."""
    if isinstance(when, int):
        return when
    moment = datetime.fromisoformat(when) if isinstance(when, str) else when
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=UTC)
    return (moment - _EPOCH) // timedelta(microseconds=1) * 1_000


def parse_interval(interval: str) -> int:
    """`'5m'` -> nanoseconds. Units are s, m, h and d; the count must be positive."""
    parts = re.fullmatch(r"([0-9]+)([smhd])", interval)
    if parts is None or int(parts[1]) == 0:
        raise ValueError(f"Invalid interval {interval!r}: use a positive count and s, m, h or d")
    return int(parts[1]) * _UNIT_SECONDS[parts[2]] * NS_PER_SECOND


def clamp_long(ns: int) -> int:
    """Keep a bound inside BIGINT; every stored time lies inside anyway."""
    return max(MIN_LONG, min(MAX_LONG, ns))
