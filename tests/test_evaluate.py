"""Exact splits, comparisons of models, pooling, and dynamic overwrites, on literals."""

import hashlib
import os

import numpy as np
import pytest
from docloom.functions import embedding
from docloom.operators import evaluate
from docloom.sources import io


@pytest.mark.parametrize("percent", [0, 1, 50, 80, 100])
@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_exact_split(spark, n, percent):
    keys = [None, *range(n - 1)] if n else []
    rows = spark.createDataFrame([(k, i) for k in keys for i in range(1 if k is None or k % 5 else 3)], "k int, i int").repartition(3)
    out = evaluate.split_exactly(rows, "k", percent).collect()
    assert len(out) == rows.count()
    sides = {k: {r.training for r in out if r.k == k} for k in keys}
    assert all(len(s) == 1 for s in sides.values())
    code = lambda k: hashlib.md5(f"42:{'' if k is None else k}".encode()).hexdigest()[:15]
    assert {k for k in keys if sides[k] == {True}} == set(sorted(keys, key=code)[: n * percent // 100])


def test_keys_of_one_hash_are_settled(spark, monkeypatch):
    monkeypatch.setattr(evaluate, "_DIGITS", 1)
    monkeypatch.setattr(evaluate, "_WIDTH", 1)
    rows = spark.createDataFrame([(k,) for k in [*range(99), None]], "k int")
    out = {r.k for r in evaluate.split_exactly(rows, "k", 80).collect() if r.training}
    code = lambda k: hashlib.md5(f"42:{'' if k is None else k}".encode()).hexdigest()[:1]
    assert out == set(sorted([*range(99), None], key=lambda k: (code(k), k is not None, k or 0))[:80])


def test_models_by_case_type(spark):
    rows = [("x", "x", 0.9, "y", 0.5, "short"), ("x", "y", 0.8, "x", 0.6, "short"), ("y", "y", 0.7, None, 0.1, "long"), ("y", "x", 0.2, "x", 0.3, None)]
    df = spark.createDataFrame(rows, "t string, a string, ca double, b string, cb double, kind string")
    got = {(r.model, r.case_type, r.n): r for r in evaluate.compared(df, "t", {"a": ("a", "ca"), "b": ("b", "cb")}, "a", "kind").collect()}
    assert got["a", "short", 2].accuracy == 50 and got["b", "short", 2].difference == 0 and got["b", "long", 1].difference == -100
    assert abs(got["a", None, 4].mean_confidence - 0.8) < 1e-12 and got["b", "long", 1].mean_confidence is None and got["b", None, 4].correct == 1


def test_pooling():
    tokens, mask = np.arange(24.0).reshape(3, 4, 2), np.array([[1, 1, 0, 0], [0, 0, 1, 1], [0, 0, 0, 0]])
    assert embedding.first_pooled(tokens, mask).tolist() == [[0, 1], [12, 13], [0, 0]]
    assert embedding.mean_pooled(tokens, mask).tolist() == [[1, 2], [13, 14], [0, 0]]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    io.overwrite(spark.range(3000).selectExpr("id", "case when id < 2400 then 'hot' else 'p' || id % 5 end p"), path, ["p"], most_rows=700)
    before = files(path)
    assert len([f for f in before if "p=hot" in f]) >= 4 and len([f for f in before if "p=p1" in f]) == 1
    io.overwrite(spark.createDataFrame([(1, "p1"), (2, "new")], "id long, p string"), path, ["p"], dynamic=True)
    after = files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f for f in before if "p=p1" not in f} == same
    assert sorted(r.id for r in spark.read.parquet(path).filter("p in ('p1', 'new')").collect()) == [1, 2]
    assert not io.overwrite(spark.range(0).selectExpr("id", "'p2' p"), path, ["p"], skip_empty=True, dynamic=True) and files(path) == after
    with pytest.raises(ValueError, match="partitions"):
        io.overwrite(spark.range(1), path, dynamic=True)
