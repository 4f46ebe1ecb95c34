"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest
from docloom.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    try:
        return round(float(value), 9) if not isinstance(value, str) else value
    except (TypeError, ValueError):
        return str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(frame.columns), sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, db, name):
    assert rows_of(registry.QUERIES[name](spark, DATA).toPandas()) == rows_of(db.execute(registry.ORACLES[name]).df())


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_merge_upsert_of_any_keys(spark, tmp_path):
    rows = [(1, "a", 30), (-1, "b", 40), (0, "c", 50), (2, "d", 26), (2, "d", 26), (2, "e", 1), (None, "f", 30), (3, None, 30), (4, "g", None)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    sql = registry.ORACLES["merge_upsert"].replace("from part", f"from '{tmp_path}/part.parquet/*.parquet'")
    found = [tuple(r) for r in registry.QUERIES["merge_upsert"](spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(duckdb.sql(sql).fetchall(), key=str)
