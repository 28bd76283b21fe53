"""Every registered query against the oracle, on whole tables."""

import duckdb
import pytest
from compare import TABLES, in_order, run_oracle, run_spark

import __spark_entry__ as entry_points
from skytally.checks.oracle import ORDERED
from skytally.plans.registry import QUERIES

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) == set(QUERIES) & set(entry_points.oracle_sql())


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name, sf_dir):
    types, rows = run_spark(entry_points.queries()[name](spark, sf_dir))
    want_types, want_rows = run_oracle(entry_points.oracle_sql()[name], sf_dir)
    assert types == want_types
    assert in_order(rows) == in_order(want_rows)
    if name in ORDERED:
        assert rows == want_rows


@pytest.fixture(scope="module")
def undated(tmp_path_factory):
    """The smallest tables with one order in fifty without ship dates."""
    folder = tmp_path_factory.mktemp("undated")
    con = duckdb.connect()
    for table in TABLES:
        columns = "* REPLACE (CASE WHEN l_orderkey % 50 > 0 THEN l_shipdate END AS l_shipdate)" if table == "lineitem" else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{SF001}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_without_some_dates(spark, name, undated):
    _, rows = run_spark(entry_points.queries()[name](spark, undated))
    _, want_rows = run_oracle(entry_points.oracle_sql()[name], undated)
    assert in_order(rows) == in_order(want_rows)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 35
