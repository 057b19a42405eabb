"""The queries against their SQL counterparts."""

from pathlib import Path

import duckdb
import pytest

from cohortscope.llm import oracles, queries

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", oracles.oracle_sql())
def test_query_matches_sql(spark, sf_dir, oracle, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = oracle.execute(oracles.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == types
    columns = list(types)
    expected = sorted(map(repr, result.fetchall()))
    assert expected
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == expected
