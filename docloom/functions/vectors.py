"""Vector expressions over arrays of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, x: t + x * x))


def normalized(v: Column) -> Column:
    """Unit length; unchanged if zero."""
    return let(v, lambda u: let(norm(u), lambda n: F.when(n > 0, F.transform(u, lambda x: x / n)).otherwise(u)))


def fused(a: Column, b: Column, weight: float = 0.7) -> Column:
    return normalized(F.zip_with(a, b, lambda x, y: x * F.lit(weight) + y * F.lit(1 - weight)))


def is_zero(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: x != 0)) == 0


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A deterministic bag-of-words vector, for pipelines without a model: each token adds one to a hashed dimension."""
    slots = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int"))

    @F.arrow_udf("array<double>")
    def counted(column: pa.Array) -> pa.Array:
        size = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        row = np.repeat(np.arange(len(column)), size)
        out = np.bincount(row * dims + column.flatten().to_numpy(zero_copy_only=False), minlength=len(column) * dims).reshape(len(column), dims).astype(float)
        norm = np.sqrt((out * out).sum(1, keepdims=True))
        out /= np.where(norm > 0, norm, 1)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * dims), pa.array(out.ravel()))

    return counted(F.coalesce(slots, F.array().cast("array<int>")))
