"""Numbered queries against their SQL, on the smallest tables and on made-up texts."""

import duckdb
import pytest

from compare import connect, difference, oracle_rows, spark_rows
from test_texts import ACCOUNTS, CONTEXTS, PERSONAL, SECRETS
from tidemark.llm import queries
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, name):
    assert difference(spark_rows(QUERIES[name](spark, folder)), oracle_rows(connect(folder), ORACLE[name])) is None


def test_every_numbered_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", ["op3_secrets", "op5_personal_data", "op8_quality_rules", "op9_near_duplicates", "op13_fill_in_middle"])
def test_query_equals_sql_on_made_up_texts(spark, monkeypatch, name):
    texts = [*SECRETS, *PERSONAL, *CONTEXTS, *ACCOUNTS, None, "", "a\n\na\nb", "x y z w v x y z w v x", "SHOUT LOUD!! " * 8]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(queries, "read_table", lambda spark, folder, table: docs)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert difference(spark_rows(QUERIES[name](spark, "")), oracle_rows(con, ORACLE[name])) is None
