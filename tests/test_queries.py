"""Every registered query with SQL gives the SQL's rows, on the smallest tables."""

import pytest
from compare import differences, duck

from quarrymill.plans import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), con.sql(ORACLES[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_runs_on_the_smallest_tables(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
