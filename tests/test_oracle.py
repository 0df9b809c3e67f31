"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the same comparison the driver makes at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_every_query_has_oracle_or_brute_force_test():
    """The training-data queries without SQL are tested in tests/llm."""
    assert {n for n in set(QUERIES) - set(ORACLE) if not n.startswith("op") and n != "pipeline"} == set()
