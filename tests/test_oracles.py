"""Every registered query against its SQL, on the smallest of the given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from verification.compare import difference, oracle_connection
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(QUERIES) & set(entry.oracle_sql())


def test_sql_takes_nothing_from_the_library():
    source = (Path(entry.__file__).parent / "verification" / "oracles.py").read_text()
    assert "hazeline" not in source


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    _, found = difference(df, con, entry.oracle_sql()[name])
    assert not found
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
