"""Queries of the training-data operators against their SQL, on the generated tables."""

import pytest
from comparing import connect, oracle_bag, spark_bag

from tillmark.llm.oracle import ORACLE
from tillmark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, connection, name):
    assert spark_bag(QUERIES[name](spark, FOLDER)) == oracle_bag(connection, ORACLE[name])
