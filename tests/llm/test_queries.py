"""Registered queries against their SQL twins; queries without one by contract."""

import duckdb
import pytest

from relayplan.llm.queries import ORACLES, QUERIES
from relayplan.plans.check import digest, duck_views
from relayplan.sources.tables import TABLES


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    duck_views(con, sf_small, TABLES)
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    want, columns = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want) > 0
    assert digest(df.columns, rows) == digest(columns, want)


def test_names():
    assert sorted(k.split("_")[0] for k in QUERIES if k != "pipeline") == sorted(f"op{n}" for n in range(1, 14))
    assert set(QUERIES) - set(ORACLES) == {"op5_ordinal_quality", "op9_pieces", "op13_token_align", "pipeline"}


@pytest.mark.parametrize("name", ["op5_ordinal_quality", "op9_pieces", "op13_token_align"])
def test_one_row_per_document(spark, sf_small, name):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = QUERIES[name](spark, sf_small)
    assert got.count() == docs.count() and got.select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
