"""Every registered query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from support import SF_SMALL
from spendlens.plans import registry

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return v.date()
    return v


def _rows(records, cols):
    out = []
    for r in records:
        vals = [_norm(r[c]) for c in cols]
        out.append(vals)
    key = lambda vals: tuple((0, repr(v)) if not isinstance(v, float) else (1, round(v, 6)) for v in vals)
    return sorted(out, key=key)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ("part", "orders", "lineitem", "supplier", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srecs = [r.asDict() for r in sdf.collect()]
    res = con.execute(ORACLE[key])
    ocols = [c[0] for c in res.description]
    assert sorted(ocols) == cols
    orecs = [dict(zip(ocols, r)) for r in res.fetchall()]
    assert len(srecs) == len(orecs)
    a, b = _rows(srecs, cols), _rows(orecs, cols)
    for ra, rb in zip(a, b):
        for c, x, y in zip(cols, ra, rb):
            if isinstance(x, float) or isinstance(y, float):
                assert x is not None and y is not None and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (key, c, ra, rb)
            else:
                assert x == y, (key, c, ra, rb)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "budget_logic" in df.columns
