"""Every registered query against its SQL, and the rules that all of them keep."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, sf_dir, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ["gaps", "gaps_feed", "bars_1m", "minute_counts", "decode_coinbase"])
def test_plans_scale(spark, sf_dir, name):
    """No Python in the tasks, no cross join, no window or sort that takes in all rows."""
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Cartesian", "BroadcastNestedLoop", "SinglePartition"):
        assert node not in text


def test_frames_are_parsed_once(spark, sf_dir):
    """Filters on the outcome of decoding must not pull a second copy of it to the scan."""
    for name in ("decode_binance", "parse_errors", "frame_filter"):
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        # Per feed the frame and the check that nothing follows it, and one inner object.
        assert text.count("from_json(") <= 5
