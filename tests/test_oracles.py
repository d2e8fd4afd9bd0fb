"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tandemlake.plans import catalogue

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(df: pd.DataFrame) -> list[str]:
    def plain(v):
        v = v.item() if hasattr(v, "item") else v
        return None if v is None or v is pd.NA or v != v else v

    return sorted(repr(tuple(plain(v) for v in r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(spark, db, name):
    ours, theirs = catalogue.QUERIES[name](spark, DATA).toPandas(), db.sql(catalogue.ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
