"""Every registered query against its DuckDB oracle on sf0.001 (same check
the driver runs at sf0.01): row count, column names, value hash."""

import duckdb
import pytest

import __spark_entry__ as E
from relayplan.plans import ORACLES, QUERIES
from relayplan.plans.check import digest, duck_views
from relayplan.sources.tables import TABLES


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    duck_views(con, sf_small, TABLES)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_them():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["request_id", "action", "files", "bytes"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(ocols, orows)
