"""Queries on training text that have SQL, on the smallest test tables."""

import os

import pytest

from tessera.llm import catalogue
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", catalogue.queries())
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER, catalogue.queries()[name], catalogue.oracle_sql().get(name)) == ""
