"""Every registered query with SQL gives what the SQL gives."""

import pytest
from compare import database, difference

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, small, connection, name):
    df = queries()[name](spark, small)
    wanted = {r[0]: r[1] for r in connection.execute("DESCRIBE " + oracle_sql()[name]).fetchall()}
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == wanted
    got = df.toPandas()
    assert len(got) > 0
    assert difference(got, connection.execute(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_queries_without_sql_run(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry(spark).columns == ["query_id", "rank", "key", "score"]


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
