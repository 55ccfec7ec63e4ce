"""Every registered query against the SQL that states its result."""

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry_module

FOLDER = os.environ.get("LEXFLUME_TESTDATA", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() == 3


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
