"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

Inner products become distances by one more component (the root of the largest
squared norm less the own), the vectors are turned by a fixed random rotation
and dealt to inverted lists.  A query scans the lists whose centres are nearest.  In each
list the rotated vectors are read in blocks of columns: after each block a
hypothesis test compares the partial distance, scaled to all columns, with the
query's bound, and abandons candidates that are almost surely too far.  What survives
is scored exactly, in double precision, on the original vectors.

Lists grow with the root of the table.  Centres are fitted on the vectors whose ids hash lowest, sixteen a list, ``SAMPLE`` at
least and ``LARGEST`` at the most (the documented bound); every
vector is indexed.  The first ``SAMPLE`` of them give each query its first bound (its k-th best
in the sample can only be too lax) and set how many lists to probe, as few as find
``RECALL`` of the sample's true neighbours.  A list, however hot, is cut into blocks of candidates
and of queries, so no task holds a whole one.

Defined results: vectors that are null or zero, hold nulls or non-finite components, or differ from the
table's most frequent dimension (ties to the smaller) take no part.  Ties go to the smaller id.  Rows that
repeat an id are candidates each; a query's own id is never its neighbour; a repeated query id is one query,
with the vector that sorts first.  Rows with a null id take no part.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.llm.store import Table, integral

SAMPLE = 8_192
LARGEST = 65_536
RECALL = 0.98
CANDIDATES = 8_192
QUERIES = 2_048
COLUMNS = 16
#: Candidates are scanned in whole blocks while more than one of so many are left, and one by one after that.
DENSE = 8
#: Of the hypothesis test: larger abandons fewer.
EPSILON = 2.1
_RATIO = 1 + 1e-9
#: Distances to centres that are held at once.
_NUMBERS = 2**22


def _usable(column: pa.Array) -> np.ndarray:
    """A matrix of the vectors of a column of equal, whole lists."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def lists_for(total: int) -> int:
    return round(np.sqrt(total) / 2)


class Index:
    """Rotation, centres, and what the sample tells."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, top: float, total: int, k: int):
        d = sample.shape[1] + 1
        rng = np.random.default_rng(20_240_601)
        q, r = np.linalg.qr(rng.standard_normal((d, d)))
        self.rotation, self.top, self.k = q * np.sign(np.diag(r)), top, k
        x = self.turned(sample)
        lists = int(np.clip(lists_for(total), 1, max(1, len(sample) // 16)))
        self.sample, self.ids = sample[:SAMPLE], ids[:SAMPLE]
        centres = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(8):
            near = self._near(x, centres, 1)[:, 0]
            size = np.bincount(near, minlength=lists)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        self.centres = centres
        self.probes = self._probes(x[:SAMPLE], lists)

    def turned(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.top - (x * x).sum(1)))
        return np.c_[x, more] @ self.rotation

    @staticmethod
    def _near(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        """The n nearest centres of each row, nearest first, ties to the smaller; a block of rows at a time."""
        norms = (centres * centres).sum(1)
        out = np.empty((len(x), min(n, len(centres))), np.int64)
        step = max(1, _NUMBERS // max(1, len(centres)))
        for a in range(0, len(x), step):
            far = norms - 2 * x[a : a + step] @ centres.T
            out[a : a + step] = far.argmin(1)[:, None] if n == 1 else np.argsort(far, axis=1, kind="stable")[:, :n]
        return out

    def _probes(self, x: np.ndarray, lists: int) -> int:
        at = np.arange(0, len(x), max(1, len(x) // 256))
        score = self.sample[at] @ self.sample.T
        score[np.arange(len(at)), at] = -np.inf
        k = min(self.k, len(x) - 1)
        if k < 1:
            return 1
        best = np.argpartition(-score, k - 1, axis=1)[:, :k]
        own = self._near(x, self.centres, 1)[:, 0]
        order = np.argsort(self._near(self.turned(self.sample[at], True), self.centres, lists), axis=1)
        rank = np.sort(np.take_along_axis(order, own[best], axis=1).ravel())
        return int(rank[min(len(rank) - 1, int(np.ceil(RECALL * len(rank))))]) + 1

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return self._near(self.turned(x), self.centres, 1)[:, 0]

    def whole(self) -> Index:
        """This index for queries that are to scan every list without a bound."""
        out = copy.copy(self)
        out.probes, out.sample, out.ids = len(self.centres), self.sample[:0], self.ids[:0]
        return out

    def lists_of(self, q: np.ndarray) -> np.ndarray:
        return self._near(self.turned(q, True), self.centres, self.probes)

    def bounds(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each query a squared distance that its k-th best cannot exceed."""
        if len(self.sample) < self.k:
            return np.full(len(q), np.inf)
        score = q @ self.sample.T
        score[ids[:, None] == self.ids[None, :]] = -np.inf
        far = (q * q).sum(1) + self.top
        least = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1]
        return np.where(np.isfinite(least), far - 2 * least, np.inf)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in order of component, so equal vectors get equal scores wherever they are."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * c[:, j]
    return out


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: larger scores, then smaller ids."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


def scan(index: Index, q: np.ndarray, turned_q: np.ndarray, q_ids: np.ndarray, bound: np.ndarray, c: np.ndarray, turned_c: np.ndarray, c_ids: np.ndarray, count: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, candidate number and score of what a list's scan finds."""
    d = turned_q.shape[1]
    out = []
    cuts = [(at, min(d, at + COLUMNS)) for at in range(0, d, COLUMNS)]
    # |x|^2 - 2 x.y + |y|^2 of a block of columns as one product.
    sides = [np.c_[y, np.ones(len(y)), (y * y).sum(1)].T for y in (turned_c[:, at:to] for at, to in cuts)]
    for a in range(0, len(q), 64):
        b = min(len(q), a + 64)
        limit = bound[a:b] * _RATIO + 1e-12
        part, alive, done = 0.0, True, 0
        for (at, to), side in zip(cuts, sides, strict=True):
            # While most candidates are left, whole blocks of them are cheaper than those that are left.
            x = turned_q[a:b, at:to]
            part += np.c_[-2 * x, (x * x).sum(1), np.ones(b - a)] @ side
            done = to
            lax = (1 + EPSILON / np.sqrt(done)) ** 2 if done < d else 1.0
            alive &= part <= (limit * (lax * done / d))[:, None]
            if count is not None:
                count[done] = count.get(done, 0) + int(np.count_nonzero(alive))
            if np.count_nonzero(alive) * DENSE < alive.size:
                break
        i, j = np.divmod(np.flatnonzero(alive), len(c))
        other = q_ids[a + i] != c_ids[j]
        i, j = i[other], j[other]
        far = part[i, j]
        while done < d:
            to = min(d, done + COLUMNS)
            step = turned_q[a + i, done:to] - turned_c[j, done:to]
            far = far + (step * step).sum(1)
            done = to
            lax = (1 + EPSILON / np.sqrt(done)) ** 2 if done < d else 1.0
            ok = far * (d / done) <= limit[i] * lax
            i, j, far = i[ok], j[ok], far[ok]
            if count is not None:
                count[done] = count.get(done, 0) + int(ok.sum())
        s = scores(q[a + i], c[j])
        top = best(i, c_ids[j], s, index.k)
        out.append((a + i[top], j[top], s[top]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _deal(shared, sizes: dict[int, int], asked: dict[int, int], queries: bool):
    """Rows of the index: a candidate goes to each block of queries of its list, a query to each block of candidates of its lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        n = len(index.centres)
        c_blocks = np.array([-(-sizes.get(i, 0) // CANDIDATES) for i in range(n)])
        q_blocks = np.array([-(-asked.get(i, 0) // QUERIES) for i in range(n)])
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                here = batch.slice(a, 1024)
                ids, x = here.column(0).to_numpy(), _usable(here.column(1))
                salt = here.column(2).to_numpy()
                if queries:
                    lists = index.lists_of(x)
                    row = np.repeat(np.arange(len(ids)), lists.shape[1])
                    lists = lists.ravel()
                    own, other = q_blocks[lists], c_blocks[lists]
                else:
                    row, lists = np.arange(len(ids)), index.list_of(x)
                    own, other = c_blocks[lists], q_blocks[lists]
                mine = salt[row] % np.maximum(own, 1)
                many = np.where(own > 0, other, 0)
                at = np.repeat(np.arange(len(row)), many)
                theirs = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                cb, qb = (theirs, mine[at]) if queries else (mine[at], theirs)
                unit = (lists[at].astype(np.int64) << 40) | (cb.astype(np.int64) << 20) | qb.astype(np.int64)
                # Each vector is turned once, here; a query's bound goes with it.
                sent = np.c_[x, index.turned(x, True), index.bounds(x, ids)] if queries else np.c_[x, index.turned(x)]
                raw = sent.tobytes()
                width = 8 * sent.shape[1]
                blob = pa.array([raw[r * width : (r + 1) * width] for r in row[at].tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(unit), pa.array(ids[row[at]]), blob], names=["unit", "id", "vector"])

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _unit(shared):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        index: Index = shared.value
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        c_ids, q_ids = left["id"].to_numpy(), right["id"].to_numpy()
        c, q = _matrix(left["vector"]), _matrix(right["vector"])
        d = len(index.rotation) - 1
        i, j, s = scan(index, np.ascontiguousarray(q[:, :d]), q[:, d:-1], q_ids, q[:, -1], np.ascontiguousarray(c[:, :d]), c[:, d:], c_ids)
        return pa.table([pa.array(q_ids[i]), pa.array(c_ids[j]), pa.array(s)], schema=schema)

    return run


def _count_lists(shared, queries: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        total = np.zeros(len(index.centres), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                x = _usable(batch.column(0).slice(a, 1024))
                total += np.bincount((index.lists_of(x) if queries else index.list_of(x)).ravel(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["list", "n"])

    return run


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = table.select(integral(table, id_col).alias("id"), v.alias("vector"))
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & whole)
    d = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("vector") == (d.d if d else 0))


def nearest(table: DataFrame, query_filter: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found of each row that ``query_filter`` (on ``id``) takes."""
    spark = table.sparkSession
    rows = usable_vectors(table, id_col, vector_col)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)).alias("top")).first()
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("id"), "vector").limit(int(np.clip(16 * lists_for(facts.n), SAMPLE, LARGEST))).toArrow()
    index = Index(_usable(sample["vector"].combine_chunks()), sample["id"].to_numpy(), facts.top, facts.n, k)
    asked = rows.filter(query_filter).groupBy("id").agg(F.min("vector").alias("vector"))
    found = Table(_search(spark, index, rows, asked, k), "found")
    # A query whose lists hold too few within its bound scans all lists, so that it gets k neighbours if there are as many.
    full = found.df.filter(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = Table(asked.join(full, "id", "left_anti"), "short")
    if short.df.isEmpty():
        return found.df
    rest = _search(spark, index.whole(), rows, short.df, k)
    return found.df.join(short.side().select(F.col("id").alias("query_id")), "query_id", "left_anti").union(rest)


def _search(spark: SparkSession, index: Index, rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(index)
    sizes, wanted = ({r["list"]: r["n"] for r in df.select("vector").mapInArrow(_count_lists(shared, q), "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect()} for df, q in ((rows, False), (asked, True)))
    salted = [df.select("id", "vector", F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30)).alias("salt")) for df in (rows, asked)]
    dealt = [df.mapInArrow(_deal(shared, sizes, wanted, q), "unit long, id long, vector binary") for df, q in zip(salted, (False, True), strict=True)]
    found = dealt[0].groupBy("unit").cogroup(dealt[1].groupBy("unit")).applyInArrow(_unit(shared), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
