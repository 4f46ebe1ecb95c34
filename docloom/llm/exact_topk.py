"""Exact top-k by integer inner product with vector-approximation files.

The vectors, as whole numbers, are packed into blocks, and each block is written with an approximation: every component is one of
up to ``CELLS`` cells of its column in the block (a byte), and the cells' least and greatest members are kept.  A scan
of the approximations alone bounds each score from both sides: with mid = least + greatest and half = greatest - least, twice the score
lies within q.mid -+ |q|.half, two matrix products in exact doubles.  Each task keeps the k best lower bounds of a query, and the
k-th best of all is the query's threshold.  A second scan reads exact vectors only of candidates whose upper bound (the
lower bound of a distance) reaches the threshold, best bounds first, and stops at the first bound that the k-th exact score has passed: the k-th
result is certain then.

Queries go out in groups, cut to ``GROUP`` vectors and ``GROUP_NUMBERS`` components each, by a broadcast of that bounded size; each group scans the
approximations.  No pair leaves a task but its k best of a query.

Defined results: vectors that are null or hold null or non-finite components (times the scale) take no part, nor do rows with a null
id.  A query is compared with the vectors of its own length.  Rows that repeat an id are candidates each; a query's own id is never its neighbour;
a repeated query id is one query, with the vector that sorts first.  Ties go to the smaller id.  A score that a long cannot
hold is null, in its right rank.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.store import Table
from docloom.llm.vector_blocks import EXACT, blocks, long_or_null, matrix, scaled, usable, whole

CELLS = 64
GROUP = 8_192
GROUP_NUMBERS = 2**20
#: Queries whose bounds to a block a task holds at once.
_AT_ONCE = 256


def approximate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of the components, column by column, and each cell's least and greatest member; equal values share a cell."""
    n, d = x.shape
    cells, least, greatest = np.empty((n, d), np.uint8), np.zeros((CELLS, d)), np.zeros((CELLS, d))
    for j in range(d):
        in_order = np.sort(x[:, j])
        marks = np.unique(in_order[(np.arange(1, CELLS) * n) // CELLS])
        cells[:, j] = np.searchsorted(marks, x[:, j], side="right")
        edge = np.searchsorted(in_order, marks)
        first, last = np.r_[0, edge], np.r_[edge, n]
        full = np.flatnonzero(last > first)
        least[full, j], greatest[full, j] = in_order[first[full]], in_order[last[full] - 1]
    return cells, least, greatest


def _file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            cells, least, greatest = approximate(matrix(one.column(2)[0].as_py(), one.column(0)[0].as_py(), len(one.column(1)[0].values)))
            yield pa.RecordBatch.from_arrays([*one.columns, *(pa.array([a.tobytes()], pa.binary()) for a in (cells, least, greatest))], names=["d", "ids", "x", "cells", "least", "greatest"])


class Bounds:
    """Twice the scores of one block from both sides."""

    def __init__(self, d: int, ids: np.ndarray, cells: bytes, least: bytes, greatest: bytes):
        at = (np.frombuffer(cells, np.uint8).reshape(len(ids), d), np.arange(d))
        low, high = (np.frombuffer(raw, np.float64).reshape(CELLS, d) for raw in (least, greatest))
        self.ids, self.mid, self.half = ids, (low + high)[at], (high - low)[at]
        self.most = d * 4 * max(np.abs(low).max(initial=0.0), np.abs(high).max(initial=0.0))

    def of(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper ones, exact where doubles are, and nothing elsewhere, so that all are read."""
        middle, width = q @ self.mid.T, np.abs(q) @ self.half.T
        low, high = middle - width, middle + width
        vague = ~(self.most * np.abs(q).max(axis=1, initial=0.0) < EXACT)
        low[vague], high[vague] = -np.inf, np.inf
        return low, high


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one query and some vectors: 64-bit integers, or Python's where they might not hold one."""
    if x.shape[1] * np.abs(x).max(initial=0.0) * np.abs(q).max(initial=0.0) < EXACT:
        return (x @ q).astype(np.int64)
    return whole(x) @ whole(q) if x.shape[1] else np.zeros(len(x), np.int64)


def _sortable(value: int) -> str:
    """Text that sorts as whole numbers of any size do: sign, number of digits, digits, the latter two turned for negative ones."""
    digits = str(abs(value))
    return f"1{len(digits):05d}{digits}" if value >= 0 else f"0{99_999 - len(digits):05d}" + "".join(str(9 - int(x)) for x in digits)


def _thresholds(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        kept = {d: np.full((len(ids), k), -np.inf) for d, (ids, _) in groups.items()}
        for batch in batches:
            for d, ids, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if d not in groups:
                    continue
                q_ids, q = groups[d]
                block = Bounds(d, np.array(ids), *cells)
                for a in range(0, len(q), _AT_ONCE):
                    low, _ = block.of(q[a : a + _AT_ONCE])
                    low[q_ids[a : a + _AT_ONCE, None] == block.ids[None, :]] = -np.inf
                    both = np.concatenate([kept[d][a : a + _AT_ONCE], low], axis=1)
                    kept[d][a : a + _AT_ONCE] = -np.partition(-both, k - 1, axis=1)[:, :k]
        for d, best in kept.items():
            i, j = np.nonzero(np.isfinite(best))
            yield pa.RecordBatch.from_arrays([pa.array(groups[d][0][i]), pa.array(best[i, j])], names=["query_id", "low"])

    return run


def _refine(shared, k: int, count=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, thresholds = shared.value
        best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for batch in batches:
            for d, ids, raw, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if d not in groups:
                    continue
                q_ids, q = groups[d]
                block, x = Bounds(d, np.array(ids), *cells), matrix(raw, d, len(ids))
                for a in range(0, len(q), _AT_ONCE):
                    _, high = block.of(q[a : a + _AT_ONCE])
                    high[q_ids[a : a + _AT_ONCE, None] == block.ids[None, :]] = -np.inf
                    least = np.array([thresholds.get(i, -np.inf) for i in q_ids[a : a + _AT_ONCE].tolist()])
                    for i in np.flatnonzero((high >= np.maximum(least, -1.7e308)[:, None]).any(axis=1)).tolist():
                        own = best.setdefault((d, a + i), [])
                        at = np.flatnonzero((high[i] >= least[i]) & (high[i] > -np.inf))
                        at = at[np.argsort(-high[i, at], kind="stable")]
                        for b in range(0, len(at), 4 * k):  # in order of the bounds, a few at a time
                            if len(own) == k and high[i, at[b]] < 2 * -own[-1][0]:
                                break
                            some = at[b : b + 4 * k]
                            if count is not None:
                                count.add(len(some))
                            own += zip((-exact_scores(q[a + i], x[some])).tolist(), block.ids[some].tolist(), strict=True)
                            own.sort()
                            del own[k:]
        for (d, i), own in best.items():
            yield pa.RecordBatch.from_arrays([pa.array([int(groups[d][0][i])] * len(own), pa.int64()), pa.array([v for _, v in own], pa.int64()), long_or_null([int(-s) for s, _ in own]), pa.array([_sortable(int(-s)) for s, _ in own])], names=["query_id", "vec_id", "score", "place"])

    return run


def top_k(table: DataFrame, query_filter: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", count=None) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k best of each row that ``query_filter`` (on ``id``) takes.

    ``count``, an accumulator, gets the number of exact vectors read.
    """
    spark = table.sparkSession
    rows = usable(table, id_col, vector_col, scale).filter("id is not null")
    packed = blocks(rows, scale, "vectors")
    files = Table(packed.df.mapInArrow(_file, "d int, ids array<long>, x binary, cells binary, least binary, greatest binary"), "approximations")
    asked = Table(rows.filter(query_filter).groupBy("id").agg(F.min("vector").alias("vector")), "asked").df
    n = asked.agg(F.count("*").alias("n"), F.sum(F.size("vector").cast("long")).alias("numbers")).first()
    groups = max(1, -(-n.n // (GROUP // 2)), -(-(n.numbers or 0) // (GROUP_NUMBERS // 2)))
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id")
    found: list[Table] = []
    for g in range(groups):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).toArrow()
        for part in _pieces(mine, scale):
            shared = spark.sparkContext.broadcast(part)
            lows = files.df.select("d", "ids", "cells", "least", "greatest").mapInArrow(_thresholds(shared, k), "query_id long, low double")
            ranked = lows.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))).filter(F.col("place") == k)
            thresholds = {r.query_id: r.low for r in ranked.collect()}  # one number for each query of the group
            both = spark.sparkContext.broadcast((part, thresholds))
            best = files.df.select("d", "ids", "x", "cells", "least", "greatest").mapInArrow(_refine(both, k, count), "query_id long, vec_id long, score long, place string")
            ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            found.append(Table(ranked.select("query_id", "rank", "vec_id", "score"), "best"))
            shared.destroy()
            both.destroy()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema(found[0].schema).parquet(*[t.path for t in found])


def _pieces(asked: pa.Table, scale: int) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Queries of a group by length, in pieces of a bounded size."""
    if not asked.num_rows:
        return
    vectors = asked["vector"].combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    ids = asked["id"].to_numpy()
    piece: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    rows = numbers = 0
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        step = max(1, min(GROUP, GROUP_NUMBERS // max(d, 1)))
        for a in range(0, len(at), step):
            some = at[a : a + step]
            if piece and (d in piece or rows + len(some) > GROUP or numbers + len(some) * d > GROUP_NUMBERS):
                yield piece
                piece, rows, numbers = {}, 0, 0
            piece[d] = (ids[some], scaled(scale, vectors.take(pa.array(some))))
            rows, numbers = rows + len(some), numbers + len(some) * d
    yield piece
