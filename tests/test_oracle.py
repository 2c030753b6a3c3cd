"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import pytest
from compare import check, connect
from conftest import SMALL

import __spark_entry__ as entry

#: Queries of packages that may be absent have tests of their own.
QUERIES = {n: q for n, q in entry.queries().items() if n in entry._registered}
SQL = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    folder, con = SMALL, duck
    if name == "run_story_errors":  # the last run of the smallest scale happens to have none
        folder = SMALL.replace("sf0.001", "sf0.01")
        con = connect(folder)
    count, problems = check(spark, con, folder, name, QUERIES[name], SQL[name])
    assert not problems
    assert count > 0


def test_sql_holds_only_the_tables_it_needs():
    assert "items_raw" not in SQL["stories_ranks"] and "items_raw" in SQL["parse_items"]
    assert "lrank" not in SQL["merge_instances"]
