"""Every registered query against its SQL twin, on the small tables."""

import oracle
import pytest

import __spark_entry__ as entry
from echolex.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"sentiment_label", "n"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, sf_dir, con, name):
    got, expected, types, expected_types = oracle.compare(
        entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]
    )
    assert types == expected_types
    assert got == expected
