"""The registered queries on the small tables against their SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tallyframe.schema import RESULT_SCHEMA
from tools.check_oracles import open_engine, rows_of
from workloads.queries import all_queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    return open_engine(FOLDER)


def test_every_query_has_sql():
    assert all_queries().keys() <= contract.queries().keys()
    assert all_queries().keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, engine, name):
    frame = contract.queries()[name](spark, FOLDER)
    answer = engine.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, answer.fetchall())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.schema.simpleString() == RESULT_SCHEMA.simpleString()
    assert frame.count() == 10
