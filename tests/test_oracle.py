"""Every registered query with an oracle equals its DuckDB SQL on sf0.001;
every registered query without one runs and yields rows."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, int) and not isinstance(v, bool):
        return repr(float(v))
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(ocols, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["UserId", "TagId", "TotalScore"]
    assert df.count() > 0
