"""Driver contract: entry() smoke, and every registered query equal to its DuckDB oracle on
the smallest driver data set (same compare as scripts/check_oracle.py)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns[:2] == ["area_name", "count"]


def test_every_query_has_an_oracle():
    from labormart.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]
