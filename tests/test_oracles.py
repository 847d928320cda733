"""Every query of the catalogue that has an oracle against it, on the smallest tables (the corpus queries: tests/llm)."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from retentia.plans import registry
from retentia.sources.testdata import TABLES
from tests.conftest import SF_SMALL

NAMES = sorted(registry.ORACLES)


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (int, float, str)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    ours = _rows(pd.DataFrame(sdf.collect(), columns=sdf.columns))
    theirs = _rows(con.execute(E.oracle_sql()[name]).df())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    assert ours[1] == theirs[1]
