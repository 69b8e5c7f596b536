"""Every registered query against its DuckDB twin on the smallest scale
(the driver repeats this at sf0.01)."""

import pytest

from oracle_harness import compare, duck

from __spark_entry__ import entry
from moodwatch.plans.registry import oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(spark, sf_small, name, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["monitor_id", "hour", "positive", "negative", "neutral"]
    assert df.count() > 0
