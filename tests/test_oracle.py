"""Every registered query against its DuckDB oracle (the driver's check) at sf0.001."""

import math
from pathlib import Path

import duckdb
import pytest

from tallystar.plans.registry import load_all

QUERIES = load_all()
TABLES = ["part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir) / (t + '.parquet')}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_matches_oracle(spark, sf_dir, duck, name):
    q = QUERIES[name]
    df = q.build(spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(q.sql)
    cols = [d[0] for d in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_runs_without_oracle(spark, sf_dir, name):
    df = QUERIES[name].build(spark, sf_dir)
    assert df.count() >= 0
