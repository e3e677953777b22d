"""Every registered query of the library against its SQL, on the smallest tables that the driver gives."""

import os

import pytest

from trackloom.plans import catalog

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(TABLES):
        pytest.skip("no tables here")
    con = duckdb.connect()
    for name in os.listdir(TABLES):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{TABLES}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, tmp_path, name):
    catalog.QUERIES[name](spark, TABLES).write.parquet(str(tmp_path / "got"))
    want = duck.execute(catalog.ORACLES[name]).df()
    got = duck.execute(f"SELECT * FROM '{tmp_path}/got/*.parquet'").df()
    assert sorted(want.columns) == sorted(got.columns)
    columns = sorted(want.columns)
    rows = lambda df: sorted(map(str, df[columns].astype(str).itertuples(index=False, name=None)))
    assert rows(want) == rows(got)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
