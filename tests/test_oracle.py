"""Every query with a twin equals its DuckDB twin at sf0.001 (exactly, or to
9 significant digits for float sums); every query without one runs."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stratum.sources.tables import TABLES
from tools.check_oracle import rows_of

LLM = E._training_data()  # these have their own tests, in tests/llm
QUERIES = {k: f for k, f in E.queries().items() if k not in LLM[0]}
TWINS = {k: q for k, q in E.oracle_sql().items() if k not in LLM[1]}
TRAINED = {"train_fare", "train_tip", "train_tip_report"}  # forests: checked by their metrics below


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_twin(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(TWINS[name])
    d_cols, d_rows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_cols, s_rows, True) == rows_of(d_cols, d_rows, True)


def test_forests_learn(spark):
    rows = {r.name: r.value for r in QUERIES["train_fare"](spark, SF_SMALL).collect()}
    assert rows["r2"] > 0.9 and rows["trip_distance"] == max(v for k, v in rows.items() if k not in ("mae", "rmse", "r2"))
    tips = QUERIES["train_tip"](spark, SF_SMALL).collect()
    assert tips and all(abs(sum(r.probabilities) - 1) < 1e-6 for r in tips)


def test_every_query_has_a_name_in_both_or_is_rows_only():
    assert set(TWINS) <= set(QUERIES)
    assert set(QUERIES) - set(TWINS) == TRAINED


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "trend_signal" in df.columns
