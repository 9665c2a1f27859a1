import pytest

import __spark_entry__ as contract
from meshfeed import catalog
from tests import oracle

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, oracle.SF_DIR)
    described = duck.execute(f"describe {SQL[name]}").fetchall()
    assert {n: DUCK_TYPES[t] for n, t in df.dtypes} == {row[0]: row[1] for row in described}
    columns, rows = oracle.actual(df)
    sql_columns, sql_rows = oracle.expected(duck, SQL[name])
    assert columns == sql_columns
    assert rows
    assert len(rows) == len(sql_rows)
    assert rows == sql_rows


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["value"]
    assert df.count() > 0
