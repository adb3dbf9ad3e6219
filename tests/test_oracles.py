"""Every registered query against its independent DuckDB oracle (sf0.001),
and every rows-only query must run and return rows."""

import pytest

import __spark_entry__ as se
from quire.testing.compare import same_result
from tests.conftest import SF_SMALL

QUERIES = se.queries()
ORACLES = se.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    ok, msg = same_result(df.columns, srows, ocols, cur.fetchall())
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_runs(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert set(df.columns) == {"accuracy", "precision", "recall", "f1_score", "n_valid", "n_hallucinated",
                               "coverage"}


def test_every_query_has_unique_name():
    assert len(QUERIES) == len(set(QUERIES))
