"""The driver's correctness gate in miniature: every registered query with an
oracle must equal its DuckDB SQL on the sf0.001 tables."""
import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES
from tools.check_oracle import frame_digest

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
SLOW_ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    s = frame_digest(E.queries()[name](spark, SF).toPandas())
    o = frame_digest(con.execute(ORACLES[name]).df())
    assert s[0] == o[0]
    assert len(s[1]) == len(o[1])
    assert s[2] == o[2]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLES) - SLOW_ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["description", "industry"]
