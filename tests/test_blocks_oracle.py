"""The named window queries with every group cut into blocks, against their SQL."""

import pytest

from compare import connect, difference, oracle_rows, spark_rows
from tidemark.operators import windows
from tidemark.operators.blocks import Limits, split_by_group_size
from tidemark.queries import ORACLE, QUERIES

NAMES = [n for n in ORACLE if n.startswith(("win_0", "win_13", "win_14", "win_15", "agg_10", "scl_07", "prd_06", "prd_07"))]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(NAMES))
def test_query_in_blocks_equals_sql(spark, con, folder, name, monkeypatch):
    cut = Limits(one_task_bytes=0, group_rows=12)
    monkeypatch.setattr(windows, "split_by_group_size", lambda df, keys, limits: split_by_group_size(df, keys, cut))
    monkeypatch.setattr("tidemark.operators.history.may_broadcast", lambda df: False)
    assert difference(spark_rows(QUERIES[name](spark, folder)), oracle_rows(con, ORACLE[name])) is None
