"""The SQL twins of the training-data queries."""

import duckdb
import pytest

from conftest import SF_SMALL
from llm_cases import shipped  # noqa: F401
from stratum.llm.queries import QUERIES, SQL
from stratum.sources.tables import TABLES
from tools.check_oracle import rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    names, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    told, want = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(names) == sorted(told) and len(rows) == len(want) > 0
    assert rows_of(names, rows, True) == rows_of(told, want, True)
