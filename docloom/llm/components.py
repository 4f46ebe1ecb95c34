"""Connected components of a distributed edge list: forests of chunks first, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import Table

#: Edges that one task holds at a time, 16 bytes each.
CHUNK_EDGES = 1_000_000
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of some edges but the roots, with the smallest node of its component there."""
    nodes, at = np.unique(np.r_[u, v], return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        low = np.minimum(x, y)
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while True:  # every pointer is followed to its end
            far = new[new]
            if np.array_equal(far, new):
                break
            new = far
        if np.array_equal(new, root):
            rest = root != np.arange(len(nodes))
            return nodes[rest], nodes[root[rest]]
        root = new


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    many = 0

    def made() -> pa.RecordBatch:
        u, v = (np.concatenate([np.empty(0, np.int64), *(x.column(i).to_numpy() for x in held)]) for i in range(2))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(u, v)], schema=_EDGES)

    for batch in batches:
        held.append(batch)
        many += batch.num_rows
        if many > CHUNK_EDGES:
            held = [made()]
            many = held[0].num_rows
            if 2 * many > CHUNK_EDGES:  # it hardly shrinks any more
                yield held[0]
                held, many = [], 0
    yield made()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (larger ones, or the others and itself) linked to the smallest of all its neighbours and itself.

    The minimum is a pre-aggregated group-by; the join that hands it back can be split where a node has very many edges.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.filter("u != m").select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def components(edges: DataFrame, chunk: int = CHUNK_EDGES) -> Table:
    """``node``, ``root`` (the smallest node of its component) for every node of ``edges`` (``u``, ``v``) but the roots.

    Edges become forests a chunk at a time, which leaves fewer of them and shorter paths.  Where one chunk holds all of them that is
    the result; else star steps, whose rounds grow with the logarithm of the nodes, go on until nothing changes.
    Repeated edges, self-links and an empty list are allowed.
    """
    now = Table(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u != v"), "edges")
    while True:
        chunks = max(1, -(-now.df.count() // chunk))
        new = Table(now.df.coalesce(chunks).mapInArrow(_forests, "u long, v long"), "edges")
        now.drop()
        now = new
        if chunks == 1:
            break
        fewer = max(1, -(-now.df.count() // chunk))
        if fewer == chunks or fewer > 1 and 2 * fewer > chunks:
            now = _settled(now)
            break
    out = Table(now.df.select(F.col("u").alias("node"), F.col("v").alias("root")), "components")
    now.drop()
    return out


def _settled(now: Table) -> Table:
    state = None
    while True:
        new = Table(_star(_star(now.df, True), False), "edges")
        now.drop()
        now = new
        was, state = state, now.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == was:
            return now
