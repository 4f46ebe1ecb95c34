"""Section classification against category prototypes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import MIN_CONFIDENCE, MIN_MARGIN, SECONDARY_GAP, SECONDARY_SCORE, TOP_K
from docloom.functions import vectors as vx
from docloom.sources.io import shared_folder

#: Prototypes that a task scores its rows against at a time, and bytes of those that are broadcast at a time.
BLOCK = 4_096
GROUP_BYTES = 32_000_000
#: Scores that a task holds at a time, of as many rows as that allows for a block.
CELLS = 1_048_576


def prototypes(phrases: DataFrame, label: str = "label", vector: str = "vector") -> DataFrame:
    """``label, prototype``: the mean of the normalised vectors of a label, normalised."""
    unit = phrases.select(F.col(label).alias("label"), vx.normalized(F.col(vector).cast("array<double>")).alias("v"))
    dims = unit.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])
    return dims.groupBy("label").agg(mean.alias("m")).select("label", vx.normalized(F.col("m")).alias("prototype"))


def scored(vectors: DataFrame, protos: DataFrame, vector: str = "vector", digits: int | None = None, block: int = BLOCK, k: int | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``ranked``: the ``k`` best labels (all of them without ``k``) with their cosine scores, best first, ties by label.

    Prototypes are a table of any size, read in order of label.  A group of them, bounded by ``group_bytes``, is broadcast at a time; a task scores its
    rows against a block of the group at a time and keeps the k best of each row, into which the next block's best are merged.  Between
    groups the rows with their best so far are a table in the shared folder.  So memory is that of one group and one block of scores, whatever the
    number of prototypes.  A vector of another length, or null, has the first labels with scores that are no numbers.
    """
    spark = vectors.sparkSession
    if k is None:
        k = protos.count()
    found = T.ArrayType(T.StructType([T.StructField("label", protos.schema["label"].dataType), T.StructField("score", T.DoubleType())]))
    unit = vectors.withColumn("__unit", vx.normalized(F.col(vector).cast("array<double>")))
    out = unit.withColumn("__best", F.array().cast(found))
    schema = T.StructType([*vectors.schema.fields, T.StructField("__unit", T.ArrayType(T.DoubleType())), T.StructField("__best", found)])
    done = 0
    for labels, matrix in _groups(protos.orderBy("label"), group_bytes):
        if done:
            path = shared_folder(spark)
            out.write.parquet(path)
            out = spark.read.schema(schema).parquet(path)
        shared = spark.sparkContext.broadcast((labels, matrix))
        out = out.mapInArrow(_best_of(shared, block, k, digits), schema)
        done += 1
    return out.drop("__unit").withColumnRenamed("__best", "ranked")


def _groups(protos: DataFrame, group_bytes: int) -> Iterator[tuple[list, np.ndarray]]:
    rows: list = []
    held = 0
    for r in protos.select("label", "prototype").toLocalIterator():
        rows.append(r)
        held += 8 * len(r.prototype) + 64
        if held >= group_bytes:
            yield [r.label for r in rows], np.array([r.prototype for r in rows], np.float64)
            rows, held = [], 0
    if rows:
        yield [r.label for r in rows], np.array([r.prototype for r in rows], np.float64)


def first_largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row, largest first, ties in order of place; what is no number comes last."""
    n, m = scores.shape
    k = min(k, m)
    plain = np.where(np.isnan(scores), -np.inf, scores)
    if k == m:
        return np.argsort(-plain, axis=1, kind="stable")
    least = np.partition(plain, m - k, axis=1)[:, m - k, None]
    above, equal = plain > least, plain == least
    # Of those equal to the k-th, the first ones fill up.
    spare = k - above.sum(axis=1, keepdims=True)
    chosen = above | (equal & (np.cumsum(equal, axis=1) <= spare))
    at = np.nonzero(chosen)[1].reshape(n, k)
    order = np.argsort(-np.take_along_axis(plain, at, axis=1), axis=1, kind="stable")
    return np.take_along_axis(at, order, axis=1)


def _rounded(x: np.ndarray, digits: int | None) -> np.ndarray:
    return x if digits is None else np.copysign(np.floor(np.abs(x) * 10.0**digits + 0.5) / 10.0**digits, x)


def _best_of(shared, block: int, k: int, digits: int | None):
    """The last two columns are unit vectors and their best so far, which are merged with the best of a group."""

    def merged(batch: pa.RecordBatch, names: pa.Array, matrix: np.ndarray) -> pa.RecordBatch:
        column, before = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        n, had = batch.num_rows, int(before.value_lengths()[0].as_py())
        kind = before.type.value_type
        whole = pc.fill_null(pc.list_value_length(column), -1).to_numpy() == matrix.shape[1]
        v = column.filter(pa.array(whole)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, matrix.shape[1])
        flat = before.flatten()
        # Places: those before the group's count down from nought, the group's own up.
        best, place = flat.field("score").to_numpy(zero_copy_only=False).reshape(n, had), np.arange(-n * had, 0).reshape(n, had)
        for a in range(0, len(names), block):
            m = matrix[a : a + block]
            made = np.full((n, len(m)), np.nan)
            out = np.zeros((len(v), len(m)))
            for j in range(m.shape[1]):  # in order of dimensions, as every engine sums
                out += v[:, j : j + 1] * m[:, j]
            made[whole] = _rounded(out, digits)
            top = first_largest(made, k)
            best = np.concatenate([best, np.take_along_axis(made, top, axis=1)], axis=1)
            place = np.concatenate([place, a + top], axis=1)
            top = first_largest(best, k)
            best, place = np.take_along_axis(best, top, axis=1), np.take_along_axis(place, top, axis=1)
        every = pa.concat_arrays([flat.field("label"), names])
        label = every.take(pa.array((place + n * had).ravel()))
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * best.shape[1])
        pairs = pa.StructArray.from_arrays([label, pa.array(best.ravel())], fields=[kind.field("label"), kind.field("score")])
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pairs)], names=batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, matrix = shared.value
        many = max(1, CELLS // max(1, min(block, len(labels))))
        names = None
        for batch in batches:
            if names is None:
                names = pa.array(labels, batch.schema.field(batch.num_columns - 1).type.value_type.field("label").type)
            for at in range(0, batch.num_rows, many):
                yield merged(batch.slice(at, many), names, matrix)

    return run


def status(top: Column, second: Column) -> Column:
    """UNMAPPED under the confidence, else AMBIGUOUS under the margin, else SUCCESS; a score that is no number is UNMAPPED."""
    bad = top.isNull() | F.isnan(top) | (top < MIN_CONFIDENCE)
    return F.when(bad, "UNMAPPED").when(top - F.coalesce(second, F.lit(0.0)) < MIN_MARGIN, "AMBIGUOUS").otherwise("SUCCESS")


def classified(ranked: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best label, confidence, margin, status, top k and secondary labels from ``ranked``."""
    r = F.col("ranked")
    top, second = F.get(r, 0)["score"], F.get(r, 1)["score"]
    more = F.filter(F.slice(r, 2, k - 1), lambda t: (t["score"] >= SECONDARY_SCORE) | (top - t["score"] <= SECONDARY_GAP))
    return ranked.select(
        *[c for c in ranked.columns if c != "ranked"],
        F.get(r, 0)["label"].alias("classification"), top.alias("confidence"), (top - second).alias("margin"), status(top, second).alias("status"),
        F.transform(F.slice(r, 1, k), lambda t: t["label"]).alias("top_k_labels"), F.transform(F.slice(r, 1, k), lambda t: t["score"]).alias("top_k_scores"),
        F.transform(more, lambda t: t["label"]).alias("secondary_labels"),
    )


def best_of_each(rows: DataFrame, classes: list[str], key: str = "document_id", order: str = "section_id") -> DataFrame:
    """In each document the best row of each class in ``classes`` keeps it; others become OTHER_SECTION of domain OTHER."""
    w = Window.partitionBy(key, "classification").orderBy(F.desc("confidence"), order)
    loses = F.col("classification").isin(*classes) & (F.row_number().over(w) > 1)
    out = rows.withColumn("__l", loses)
    for c, other in (("classification", "OTHER_SECTION"), ("category_domain", "OTHER"), ("category_level1", "OTHER")):
        if c in rows.columns:
            out = out.withColumn(c, F.when(F.col("__l"), other).otherwise(F.col(c)))
    return out.drop("__l")


def with_domain(rows: DataFrame, domains: DataFrame) -> DataFrame:
    """Domain and level of each class from a dimension (``classification, category_domain, category_level1``), OTHER beyond it."""
    out = rows.join(domains, "classification", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("OTHER")) for c in ("category_domain", "category_level1")})
