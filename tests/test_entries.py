"""Registered queries against their SQL, over the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as registered
from lettermill.entries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SOME = ("a12_response_store", "b9_validate_jobs", "c3_enrich", "c11_url_ok", "d2_rewrite", "e4_substitute", "f7_match_phrases", "g4_concat_per", "i3_topk", "k1_case_records", "k9_chunk")

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", SOME)
def test_query_equals_its_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, want = QUERIES[name](spark, SF), db.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, want.fetchall())


def test_all_queries_are_registered_once():
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(QUERIES)
    assert set(registered.oracle_sql()) <= set(registered.queries())
