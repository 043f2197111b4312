"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
check runs the same comparison at sf0.01)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from shipcast import registry
from shipcast.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    registry.load_all()
    approximate = {"approx_profile"}  # held to its bounds in test_sketches.py
    assert set(registry.ORACLE) == set(registry.QUERIES) - approximate
    assert len(registry.QUERIES) >= 57
    assert set(registry.QUERIES) <= set(E.queries())


registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and "roc_auc" in df.columns
