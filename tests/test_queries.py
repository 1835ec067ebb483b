"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    mine = queries()[name](spark, FOLDER).toArrow()
    assert compare(mine, con.sql(oracle_sql()[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", ["train_lr", "score_batch"])
def test_model_queries_run(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
