"""Vectors as whole numbers, packed into blocks of rows that one matrix product takes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import Table, integral

ROWS = 4_096
#: Doubles hold every whole number below.
EXACT = 2.0**53

_SCHEMA = "d int, ids array<long>, x binary"


def usable(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the vectors that are not null and whose components are neither null nor, times ``scale``, not finite."""
    rows = table.select(integral(table, id_col).alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x * scale) < float("inf"))))


def scaled(scale: int, vectors: pa.Array) -> np.ndarray:
    """floor(scale * x) of vectors of one length, as doubles, which hold these numbers exactly."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.reshape(len(vectors), -1)) if len(flat) else np.empty((len(vectors), 0))


def blocks(rows: DataFrame, scale: int, name: str) -> Table:
    """A table of blocks of up to ``ROWS`` vectors of one length ``d``: ids, and floor(scale * x) row after row."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}
        size: dict[int, int] = {}

        def flush(d: int) -> pa.RecordBatch:
            parts = held.pop(d)
            del size[d]
            ids = pa.ListArray.from_arrays(pa.array([0, sum(len(i) for i, _ in parts)], pa.int32()), pa.concat_arrays([i for i, _ in parts]))
            return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), ids, pa.array([np.concatenate([x for _, x in parts]).tobytes()], pa.binary())], names=["d", "ids", "x"])

        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False) if batch.num_rows else np.empty(0, np.int32)
            for d in np.unique(lengths).tolist():
                at = pa.array(np.flatnonzero(lengths == d))
                ids, x = batch.column(0).take(at), scaled(scale, batch.column(1).take(at))
                for a in range(0, len(ids), ROWS):
                    held.setdefault(d, []).append((ids[a : a + ROWS], x[a : a + ROWS]))
                    size[d] = size.get(d, 0) + len(ids[a : a + ROWS])
                    if size[d] >= ROWS:
                        yield flush(d)
            while sum(n * d for d, n in size.items()) > 4 * ROWS * 256 or len(size) > 1024:  # many lengths at once, or very long vectors
                yield flush(max(size, key=lambda d: size[d] * max(d, 1)))
        for d in list(held):
            yield flush(d)

    return Table(rows.select("id", "vector").mapInArrow(pack, _SCHEMA), name)


def matrix(raw: bytes, d: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(rows, d)


def whole(x: np.ndarray) -> np.ndarray:
    """Python integers of whole doubles of any size."""
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(v) for v in x.ravel().tolist()]
    return out


def long_or_null(values: list[int]) -> pa.Array:
    return pa.array([v if -(2**63) <= v < 2**63 else None for v in values], pa.int64())


def literal_long(value: int) -> Column:
    return F.lit(value if -(2**63) <= value < 2**63 else None).cast("long")
