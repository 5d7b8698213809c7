"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as spark_entry
from checks.compare import differences, views
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return views(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries())


@pytest.mark.parametrize("key", QUERIES)
def test_matches_sql(spark, sf_dir, con, key):
    df = QUERIES[key](spark, sf_dir)
    assert differences(df, con, ORACLE[key]) == []


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows
