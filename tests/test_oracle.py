"""Every named query against its SQL, on the smallest tables."""

import pytest

from compare import connect, difference, oracle_rows, spark_rows
from tidemark.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, folder, name):
    assert difference(spark_rows(QUERIES[name](spark, folder)), oracle_rows(con, ORACLE[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
