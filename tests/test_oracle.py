"""Every registered query against DuckDB at the smallest scale."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from keyfold.plans.oracles import ORACLES
from keyfold.plans.queries import QUERIES
from tests.oracle_check import compare, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, differing = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert rows > 0
    assert differing == []


def test_entry(spark):
    assert entry(spark).columns == ["id", "field", "val"]
