"""Exact k-means over whole numbers: the same clusters on any machines, in any order of rows.

Vectors are packed into blocks.  A block's squared distances to all centroids are |x|^2 - 2 x.c + |c|^2 in doubles, by one matrix
product; bounds of the magnitudes show that no sum leaves the whole numbers that doubles hold, and rows for which they do not
are computed in Python's integers.  ``treeAggregate`` combines the blocks' sums and counts, so the driver gets k vectors a
round, and the centroids go out with the tasks: k vectors, whatever the number of rows.

Defined results: vectors of other lengths, null ones, and those with null or non-finite components (times the scale) take no
part.  Rows that repeat an id are vectors each; a null id takes part, but starts no centroid.  Starts are the k smallest
digests, ties by vector; of fewer vectors each starts one.  Ties go to the smaller centroid, and an empty centroid stays where
it is.  A distance or inertia that a long cannot hold is null.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import Table
from docloom.llm.vector_blocks import EXACT, blocks, literal_long, long_or_null, matrix, scaled, usable, whole


def nearest(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, list[int]]:
    """For each row the nearest centroid, the first of equals, and the squared distance, exactly."""
    d = x.shape[1]
    c = np.array(centroids, np.float64).reshape(-1, d)
    most = float(max((abs(v) for row in centroids for v in row), default=0))
    # Every partial sum is at most d * (|x| + |c|)^2 in size, so below 2^53 nothing is rounded.
    safe = d * (np.abs(x).max(axis=1, initial=0.0) + most) ** 2 < EXACT
    near, far = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    y = x[safe]
    gemm = (y * y).sum(1)[:, None] - 2 * (y @ c.T) + (c * c).sum(1)
    near[safe] = gemm.argmin(1)
    far[safe] = gemm.min(1).astype(np.int64) if len(y) else 0
    for i in np.flatnonzero(~safe):
        row = [int(v) for v in x[i].tolist()]
        all_ = [sum((a - b) ** 2 for a, b in zip(row, centre, strict=True)) for centre in centroids]
        far[i] = min(all_)
        near[i] = all_.index(far[i])
    return near, far.tolist()


def _sums(x: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each cluster's vectors as Python's integers, and their numbers."""
    size = np.bincount(near, minlength=k)
    if len(x) * np.abs(x).max(initial=0.0) < EXACT:
        return whole((near[None, :] == np.arange(k)[:, None]).astype(np.float64) @ x), size
    sums = np.zeros((k, x.shape[1]), object)
    np.add.at(sums, near, whole(x))
    return sums, size


@dataclass
class Clusters:
    """``centroids`` after the last round, the table of ``blocks`` they were fitted on, and the inertia of each cluster."""

    centroids: list[list[int]]
    blocks: Table
    inertia: list[int]

    def sha256(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]

    def assigned(self) -> DataFrame:
        """``id``, ``cluster`` and squared ``distance`` of each vector."""
        centroids = self.centroids

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    ids = batch.column(1)[i].values
                    near, far = nearest(matrix(batch.column(2)[i].as_py(), batch.column(0)[i].as_py(), len(ids)), centroids)
                    yield pa.RecordBatch.from_arrays([ids, pa.array(near, pa.int32()), long_or_null(far)], names=["id", "cluster", "distance"])

        return self.blocks.df.mapInArrow(assign, "id long, cluster int, distance long")

    def described(self) -> DataFrame:
        """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; k values each, so literals."""
        out = self.assigned()
        if not self.centroids:
            return out.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
        at = F.col("cluster") + 1
        return out.select("*", F.element_at(F.array(*map(literal_long, self.inertia)), at).alias("cluster_inertia"), literal_long(sum(self.inertia)).alias("inertia"), F.element_at(F.array(*map(F.lit, self.sha256())), at).alias("centroid_sha256"))


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    rows = usable(table, id_col, vector_col, scale).filter(F.size("vector") == size)
    packed = blocks(rows, scale, "vectors")
    digest = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    starts = rows.filter("id is not null").withColumn("digest", digest).orderBy("digest", "vector").limit(k).toArrow()
    centroids = [[int(v) for v in row] for row in scaled(scale, starts["vector"].combine_chunks()).tolist()]
    k = len(centroids)
    if not k:
        return Clusters([], Table(packed.df.limit(0), "vectors"), [])
    rdd = packed.df.select("d", F.size("ids").alias("n"), "x").rdd

    def add(total, row, centroids):
        x = matrix(bytes(row.x), row.d, row.n)
        near, far = nearest(x, centroids)
        sums, size = _sums(x, near, k)
        inertia = np.zeros(k, object)
        np.add.at(inertia, near, np.array(far, object))
        return total[0] + sums, total[1] + size, total[2] + inertia

    def both(a, b):
        return tuple(x + y for x, y in zip(a, b, strict=True))

    def combined(centroids):
        zero = (np.zeros((k, size), object), np.zeros(k, np.int64), np.zeros(k, object))
        return rdd.treeAggregate(zero, lambda total, row: add(total, row, centroids), both)

    for _ in range(rounds):
        sums, count, _ = combined(centroids)
        centroids = [[s // int(n) for s in row] if n else old for row, n, old in zip(sums.tolist(), count.tolist(), centroids, strict=True)]
    return Clusters(centroids, packed, [int(v) for v in combined(centroids)[2].tolist()])
