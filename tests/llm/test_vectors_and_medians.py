"""Exact clustering, exact top-k and rolling medians against brute force and SQL, on small and awkward tables."""

import datetime
import hashlib
import os
import random
import statistics

import duckdb
import numpy as np
import pytest
from docloom.llm import centroids, exact_topk, rolling_median, vector_blocks
from docloom.llm.oracles import ORACLES
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, distance string, id string, cluster string, rank string"


def awkward(seed, n=300, d=64):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=d).round(2).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [rows[3], rows[50]]  # equal vectors, repeated rows
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * d), (2003, [float("inf")] + [0.0] * (d - 1)), (2004, [None] + [1.0] * (d - 1)), (2050, [0.5] * 3), (2051, [0.25] * 3), (2100, [0.0] * d)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "d", "x", "c", "r") for i, v in rows], VECTORS).repartition(3)


def taking_part(rows, scale):
    return [(i, [int(np.floor(scale * x)) if abs(x) < 1e15 else int(x) * scale for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def brute_clusters(rows, k=8, rounds=10, size=64):
    rows = [(i, v) for i, v in taking_part(rows, 1024) if len(v) == size]
    starts = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)[:k]
    c = [v for _, v in starts]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, y, strict=True)), j) for j, y in enumerate(c))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in rows]
        for j in range(len(c)):
            mine = [v for (_, v), a in zip(rows, of, strict=True) if a == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, *near(v)[::-1]) for i, v in rows]
    total = sum(d for _, _, d in out)
    digest = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    fit = lambda x: x if x < 2**63 else None
    return sorted(((i, a, fit(d), fit(sum(e for _, b, e in out if b == a)), fit(total), digest[a]) for i, a, d in out), key=str)


def clusters(df, **how):
    found = centroids.cluster(df, **how).described()
    return sorted(map(tuple, found.select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def test_centroids(spark):
    rows = awkward(1) + [(None, [0.125] * 64)]
    df = frame(spark, rows)
    assert clusters(df) == brute_clusters(rows)
    assert clusters(df.limit(0)) == []
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert clusters(frame(spark, few)) == brute_clusters(few)


def test_centroids_beyond_doubles(spark, monkeypatch):
    """Magnitudes for which a matrix product of doubles would round: Python's integers answer, here for some rows and for all."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=64) * (1e5 if i % 3 else 1)).tolist()) for i in range(60)]
    assert clusters(frame(spark, rows)) == brute_clusters(rows)
    huge = [(i, [1e30 * ((i % 3) - 1)] + [0.0] * 63) for i in range(12)]
    assert clusters(frame(spark, huge)) == brute_clusters(huge)
    monkeypatch.setattr(centroids, "EXACT", 0.0)
    x = np.floor(1024 * rng.normal(size=(50, 8)))
    c = [[int(v) for v in row] for row in x[:5]]
    near, far = centroids.nearest(x, c)
    monkeypatch.setattr(centroids, "EXACT", vector_blocks.EXACT)
    again = centroids.nearest(x, c)
    assert near.tolist() == again[0].tolist() and far == again[1]


def brute_top(rows, k=5, every=50):
    rows = [(i, v) for i, v in taking_part(rows, 256) if i is not None]
    asked = {}
    for i, v in rows:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s if abs(s) < 2**63 else None) for r, (s, j) in enumerate(best)]
    return sorted(out)


def top(df, **how):
    return sorted(map(tuple, exact_topk.top_k(df, F.col("id") % 50 == 0, **how).select("query_id", "rank", "vec_id", "score").collect()))


def test_top_k(spark):
    rows = awkward(2)
    df = frame(spark, [*rows, (None, [1.0] * 64)])
    count = spark.sparkContext.accumulator(0)
    assert top(df, count=count) == brute_top(rows)
    assert 0 < count.value < 0.5 * 9 * len(rows)  # the bounds spare exact vectors
    assert top(df.limit(0)) == []
    assert top(frame(spark, rows[:1])) == []


def test_top_k_in_groups(spark, monkeypatch):
    rows = awkward(5, 700)
    monkeypatch.setattr(exact_topk, "GROUP", 4)
    monkeypatch.setattr(vector_blocks, "ROWS", 64)
    assert top(frame(spark, rows)) == brute_top(rows)


def test_top_k_beyond_doubles(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=4) * (10.0 ** (i % 30))).tolist()) for i in range(200)]
    assert top(frame(spark, rows)) == brute_top(rows)


@pytest.mark.parametrize("values", [[5.0] * 500, list(range(500)), [0.0, 1e6] * 250, [3.5]])
def test_cells_hold_their_members(values):
    x = np.array(values, np.float64)[:, None]
    cells, least, greatest = exact_topk.approximate(x)
    assert (least[cells[:, 0], 0] <= x[:, 0]).all() and (x[:, 0] <= greatest[cells[:, 0], 0]).all()


EPOCH = datetime.datetime(2024, 1, 1)
HOUR = 3_600_000_000


def clicks(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        us = rng.choice([rng.randrange(5 * HOUR), rng.randrange(50) * HOUR // 10, rng.randrange(HOUR // 100)])
        rows.append((i, us, rng.choice(["a", "b", None, ""]), rng.choice([None, rng.randrange(-500, 500) / 100, 7.0, 0.005, rng.random() * 1e6])))
    rows += rng.sample(rows, 20)  # repeated rows
    rows += [(9_000, None, "a", 1.0), (9_001, 5, "a", float("nan")), (9_002, 5, "b", float("inf")), (9_003, -HOUR - 1, "a", 2.0), (9_004, -1, "a", 3.0), (9_005, HOUR, "alone", 1.0)]
    return rows


def clicks_frame(spark, rows):
    made = [(i, None if us is None else EPOCH + datetime.timedelta(microseconds=us), kind, value, "x", "y") for i, us, kind, value in rows]
    return spark.createDataFrame(made, "click_id long, ts timestamp_ntz, kind string, value double, n string, us string").repartition(3)


def brute_medians(rows):
    once = {r[0]: r for r in rows if r[1] is not None}
    cents = {i: int(np.floor(100 * v + 0.5)) if v is not None and np.isfinite(v) else None for i, _, _, v in once.values()}
    out = []
    for i, us, kind, _ in once.values():
        inside = [cents[j] for j, t, k, _ in once.values() if k == kind and us - HOUR <= t <= us and cents[j] is not None]
        if len(inside) < 2:
            out.append((i, kind, len(inside), None, None, None))
            continue
        median2 = int(2 * statistics.median(inside))
        mad4 = int(2 * statistics.median([abs(2 * c - median2) for c in inside]))
        out.append((i, kind, len(inside), median2, mad4, None if cents[i] is None else 2 * abs(2 * cents[i] - median2) > 3 * mad4))
    return sorted(out)


def medians(df):
    return sorted(map(tuple, rolling_median.rolling_medians(df).select("click_id", "kind", "n", "median2", "mad4", "far").collect()))


@pytest.mark.parametrize("unit", [200_000, 40, 5])
def test_rolling_medians(spark, monkeypatch, unit):
    """Also with units cut into runs of time, and with many units a batch."""
    rows = clicks(unit)
    monkeypatch.setattr(rolling_median, "UNIT", unit)
    monkeypatch.setattr(rolling_median, "HELD", 50)
    df = clicks_frame(spark, rows)
    assert medians(df) == brute_medians(rows)
    assert medians(df.limit(0)) == []


def test_one_instant_holds_all(spark, monkeypatch):
    rows = [(i, 10, "a", float(i % 7)) for i in range(300)] + [(300, HOUR + 10, "a", 1.0), (301, HOUR + 11, "a", 2.0)]
    monkeypatch.setattr(rolling_median, "UNIT", 20)
    assert medians(clicks_frame(spark, rows)) == brute_medians(rows)


def test_times_keep_their_clock(spark):
    """Times without a zone are read as they stand, also those that the session's zone does not have."""
    had = spark.conf.get("spark.sql.session.timeZone")
    rows = [(i, (90 * 24 + 1) * HOUR + i * HOUR // 7, "a", float(i)) for i in range(20)]  # 31 March 2024, 1 to 4 o'clock
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert medians(clicks_frame(spark, rows)) == brute_medians(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", had)


def test_a_click_may_differ_from_its_copy(spark):
    rows = [(1, 10, "b", 2.0), (1, 5, "b", 4.0), (1, None, "a", 1.0), (2, 6, "b", 1.0)]
    assert medians(clicks_frame(spark, rows)) == brute_medians([(1, 5, "b", 4.0), (2, 6, "b", 1.0)])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_registered_query_is_its_sql(spark, name):
    from docloom.llm.queries import QUERIES

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.split('.')[0]} as select * from '{DATA}/{f}'")
    got = QUERIES[name](spark, DATA)
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
