"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

from tools.compare import canon, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    """The library's own queries; the optional subpackage has tests of its own."""
    from oracle import oracle_queries_all
    from tillroll.plans import queries, reports

    assert {*reports.REPORTS, *queries.QUERIES} == set(oracle_queries_all())
    return sorted(oracle_queries_all())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(df.columns, srows) == canon(dcols, drows)


def test_entry_runs(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["year", "month", "month_name", "monthly_revenue"]
