from datetime import UTC, datetime, timedelta, timezone

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sparktape.functions.timeargs import clamp_long, parse_interval, to_ns


@pytest.mark.parametrize(
    "given_time",
    [
        "2024-05-20T00:00:00Z",
        "2024-05-20T00:00:00+00:00",
        "2024-05-20",
        "2024-05-20T02:00:00+02:00",
        datetime(2024, 5, 20),
        datetime(2024, 5, 20, tzinfo=UTC),
        datetime(2024, 5, 19, 20, tzinfo=timezone(timedelta(hours=-4))),
        1_716_163_200_000_000_000,
    ],
)
def test_forms_of_one_time(given_time):
    assert to_ns(given_time) == 1_716_163_200_000_000_000


def test_microseconds_are_kept_and_finer_digits_cut():
    assert to_ns("2024-05-20T00:00:00.123456789Z") == 1_716_163_200_123_456_000
    assert to_ns(datetime(1969, 12, 31, 23, 59, 59, 500_000)) == -500_000_000


@pytest.mark.parametrize(
    ("text", "seconds"), [("1s", 1), ("5m", 300), ("15m", 900), ("1h", 3600), ("2d", 172_800)]
)
def test_intervals(text, seconds):
    assert parse_interval(text) == seconds * 1_000_000_000


@pytest.mark.parametrize("text", ["60", "invalid", "", "1w", "-1m", "0s", "1.5h", "m"])
def test_bad_intervals(text):
    with pytest.raises(ValueError, match="Invalid interval"):
        parse_interval(text)


@given(st.integers())
def test_bounds_stay_inside_a_long(ns):
    assert -(2**63) <= clamp_long(ns) < 2**63
