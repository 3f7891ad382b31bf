"""Every registered query of the two planes against its SQL in DuckDB."""

import math

import duckdb
import pytest

from tilewright.plans import catalog, operations  # noqa: F401

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    clean = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("<NA>", "NaT") else v
    return sorted((tuple(clean(v) for v in r) for r in frame.itertuples(index=False)), key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got, expected = catalog.QUERIES[name](spark, DATA).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_flagship_counts_are_those_of_the_grid(spark):
    found = {r.z: (r.instances, r.tiles) for r in catalog.QUERIES["tile_count_by_zoom"](spark, "/root/testdata/sf0.01").collect()}
    assert found[0] == (1500, 1) and found[3] == (1885, 64) and found[8] == (1904, 1904)
