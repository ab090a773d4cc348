"""Every catalogue query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tidewell.plans import catalog_world
from tidewell.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def db(data):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module", autouse=True)
def one_plan():
    """The fleet is planned once for all queries on it; its tables are written ones."""
    made, real = {}, catalog_world.fleet_plan

    def once(spark, sf_dir, all_rows=False):
        if (sf_dir, all_rows) not in made:
            made[sf_dir, all_rows] = real(spark, sf_dir, all_rows)
        return made[sf_dir, all_rows]

    catalog_world.fleet_plan = once
    yield
    catalog_world.fleet_plan = real


def rows(names, records):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(str([names[k] for k in order]) + str([r[k] for k in order]) for r in records)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, data, db, name):
    run, sql = CATALOG[name]
    got = run(spark, data)
    records = [tuple(r) for r in got.collect()]
    if sql is None:
        assert got.columns
        return
    want = db.sql(sql)
    assert rows(got.columns, records) == rows(want.columns, want.fetchall())
