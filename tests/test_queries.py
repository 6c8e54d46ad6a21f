"""Every query with a SQL twin is compared with DuckDB on the smallest tables; the others must give rows."""

import math

import duckdb
import pytest

from check import TABLES
from obsledger import queries as Q

Q.load_all()
# these fit models for several seconds each; their parts have their own tests
SLOW = {"predict_wide", "forecast_on_demand", "kernel_svr", "kmeans_fit"}


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.01e-2 if abs(a) > 1e6 else 2e-4)
    return a == b


def ordered(rel):
    names = sorted(rel.column_names)
    rows = list(zip(*[rel.column(n).to_pylist() for n in names]))
    return names, sorted(rows, key=lambda r: tuple((v is None, round(v, 2) if isinstance(v, float) else v) if v is not None else (True, 0) for v in r))


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_same_as_sql(spark, sf, con, name):
    names, got = ordered(Q.QUERIES[name](spark, sf).toArrow())
    want_names, want = ordered(con.sql(Q.ORACLES[name]).to_arrow_table())
    assert names == want_names
    assert len(got) == len(want)
    wrong = [(a, b) for a, b in zip(got, want) if not all(map(close, a, b))]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLES) - SLOW))
def test_gives_rows(spark, sf, name):
    assert Q.QUERIES[name](spark, sf).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).columns == ["run_id", "city", "climate_risk_index"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
