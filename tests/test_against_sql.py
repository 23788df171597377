"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as registered
from balcao.checks.oracle import oracle_texts
from balcao.checks.queries import QUERIES as RETAIL
from balcao.checks.queries import bind

# Queries of other subpackages are tested in their own folder.
QUERIES = {name: bind(query) for name, query in RETAIL.items()}
ORACLES = oracle_texts()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
