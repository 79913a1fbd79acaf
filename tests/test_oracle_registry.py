"""Every registered query with an oracle equals its DuckDB SQL (sf0.001), and
the driver contract holds."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if not isinstance(v, (list, dict, str)) and pd.isna(v):
            return None
    except Exception:
        pass
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_contract_shapes():
    qs = E.queries()
    assert set(ORACLE) <= set(qs) and len(qs) >= 100


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "threshold" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.execute(ORACLE[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er
