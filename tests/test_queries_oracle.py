"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tools.check_oracle import digest  # noqa: E402

SF = "/root/testdata/sf0.001"
E.queries()  # registers them
from tidewater.plans.catalog import QUERIES  # noqa: E402
from tidewater.plans.oracle import ORACLE  # noqa: E402
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from tidewater.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "revenue", "o_orderdate", "o_shippriority"]
    rows = df.collect()
    # the query's own order: revenue descending, then order date
    assert rows and rows == sorted(rows, key=lambda r: (-r.revenue, r.o_orderdate))
