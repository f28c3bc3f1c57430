import pytest

from __spark_entry__ import entry
from workload.oracles import ORACLES
from workload.queries import QUERIES
from compare import duck, spark_rows, spark_types, sql_rows, sql_types
from conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    assert spark_types(result) == sql_types(con, ORACLES[name])
    columns, rows = spark_rows(result)
    expected_columns, expected = sql_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows


def test_entry_has_stable_schema(spark):
    df = entry(spark)
    assert {"batch_id", "entity_id", "sparql_url", "concept_uri"} <= set(df.columns)
    assert not df.isEmpty()
