"""Every registered query against its DuckDB statement on the smallest tables; the others run."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from tesserine.plans import endpoints, models, roundtrips  # noqa: F401  register their queries
from tesserine.plans.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "~"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    return f"{float(v):.6f}" if isinstance(v, (int, float, np.integer, np.floating)) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SMALL}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert len(got) > 0 or name in ORACLES
    if name in ORACLES:
        want = con.sql(ORACLES[name]).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        tidy = lambda df: df[cols].map(cell).sort_values(cols).to_numpy().tolist()
        assert tidy(got) == tidy(want)


def test_entry_imports_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as e

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        bare = importlib.reload(e)
        assert set(bare.queries()) == set(QUERIES) and set(bare.oracle_sql()) == set(ORACLES)
    finally:
        monkeypatch.undo()
        importlib.reload(e)
