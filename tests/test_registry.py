import duckdb
import pytest

import __spark_entry__ as contract
from amperline.plans.registry import ORACLES, REGISTRY
from check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    """Queries of the training-data operators, where their folder is present, have tests of their own."""
    assert set(ORACLES) == set(REGISTRY)
    assert set(REGISTRY) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == 5 and "pressure_score" in frame.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF)
    ours = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    answer = duck.execute(contract.oracle_sql()[name])
    columns = [item[0] for item in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert ours == rows_of(columns, answer.fetchall())
