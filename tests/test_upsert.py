"""Partition upserts, stopped at every step."""

import os

import pytest
from docloom.sources import io, upsert

SCHEMA = "id int, n int, p string, q int"
ROWS = [(1, 1, "a", 1), (2, 2, "a", 1), (3, 3, "b c/d#1", 1), (4, 4, "b c/d#1", 2), (5, 5, None, 2), (None, 6, "z", 3), (7, 7, "01", 7)]
CHANGES = [(1, 10, "a", 1), (3, 30, "new", 9), (None, 60, "z", 3), (8, 80, "a", 5), (5, 50, None, 2)]
WANT = sorted([(1, 10, "a", 1), (2, 2, "a", 1), (3, 30, "new", 9), (4, 4, "b c/d#1", 2), (5, 50, None, 2), (None, 60, "z", 3), (7, 7, "01", 7), (8, 80, "a", 5)], key=str)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_partitions(spark, path, spark.createDataFrame(ROWS, SCHEMA), ["id"], ["p", "q"])
    return path


def rows(spark, path):
    return sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).select("id", "n", "p", "q").collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_only_touched_partitions_are_rewritten(spark, table):
    before = files(table)
    touched = upsert.upsert_partitions(spark, table, spark.createDataFrame(CHANGES, SCHEMA), ["id"], ["p", "q"])
    assert rows(spark, table) == WANT
    after = files(table)
    same = {f for f in before if after.get(f) == before[f]}
    assert {os.path.relpath(os.path.dirname(f), table).split("/")[0] for f in same} == {"p=01", "p=b c%2Fd%231"} and len(same) == 2  # of the latter q=2 alone
    assert len(touched) == 6 and not os.path.exists(os.path.join(table, "p=b c%2Fd%231", "q=1"))
    assert sorted(os.listdir(os.path.dirname(table))) == ["t"]


@pytest.mark.parametrize("stop", range(1, 14))
def test_stopped_anywhere(spark, table, monkeypatch, stop):
    """After each number of renames a crash; the next call makes the table whole, before or after the change and never between."""
    moved, calls = io._moved, []

    def failing(fs, here, there):
        calls.append(1)
        if len(calls) == stop:
            raise OSError("stopped")
        moved(fs, here, there)

    source = spark.createDataFrame(CHANGES, SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(io, "_moved", failing)
        try:
            upsert.upsert_partitions(spark, table, source, ["id"], ["p", "q"])
            ended = True
        except OSError:
            ended = False
    upsert.recover_partitions(spark, table)
    assert rows(spark, table) == (sorted(ROWS, key=str) if stop == 1 else WANT)
    assert sorted(os.listdir(os.path.dirname(table))) == ["t"]
    assert ended == (len(calls) < stop)


def test_defined_results(spark, table):
    empty = spark.createDataFrame([], SCHEMA)
    assert upsert.upsert_partitions(spark, table, empty, ["id"], ["p", "q"]) == [] and rows(spark, table) == sorted(ROWS, key=str)
    with pytest.raises(ValueError, match="more than once"):
        upsert.upsert_partitions(spark, table, spark.createDataFrame([(1, 1, "a", 1)] * 2, SCHEMA), ["id"], ["p", "q"])
    upsert.upsert_partitions(spark, table, spark.createDataFrame([(2, 99, "ignored", 0)], SCHEMA), ["id"], ["p", "q"], update=["n"])
    assert (2, 99, "a", 1) in rows(spark, table)
