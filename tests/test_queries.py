"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.oracle import duck, rows_of_duck, rows_of_spark, type_issues
from workload.catalog import QUERIES, run

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = run(name, spark, SF)
    sql = QUERIES[name].sql
    assert sql is not None
    cols, got = rows_of_spark(df)
    want_cols, want = rows_of_duck(con, sql)
    assert cols == want_cols
    assert got == want
    assert type_issues(df, con, sql) == []


def test_registry_and_entry_agree():
    import __spark_entry__ as entry

    # the optional subpackage adds queries of its own
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
