"""Every registered query against its SQL counterpart, on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(df: pd.DataFrame) -> pd.DataFrame:
    out = df[sorted(df.columns)].copy()
    for name in out.columns:
        if name == "day":
            out[name] = pd.to_datetime(out[name])
        if out[name].dtype.kind == "f" and (out[name].dropna() % 1 == 0).all():
            out[name] = out[name].astype("Int64")
        if out[name].dtype.kind == "M":
            out[name] = out[name].astype("datetime64[us]")
        out[name] = out[name].astype("string").fillna("null")
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    got = contract.queries()[name](spark, str(SF_DIR)).toPandas()
    assert len(got) > 0
    if name not in contract.oracle_sql():
        return
    want = database.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    pd.testing.assert_frame_equal(comparable(got), comparable(want))


def test_entry_returns_rows(spark):
    assert contract.entry(spark).columns == ["item_id", "window_end", "cnt", "row_num"]


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)
