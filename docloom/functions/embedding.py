"""Embedding by a model behind an iterator Pandas UDF, and the routing of sections to models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions import vectors as vx

#: Makes a model on a worker: a function from texts to a matrix.
Factory = Callable[[], Callable[[list[str]], np.ndarray]]
Embedder = Callable[[Column], Column]


def model_embedder(factory: Factory, dims: int, batch: int = 64) -> Embedder:
    """An embedder whose model is made once a worker; a blank or null text is the zero vector, others have unit length."""

    @F.pandas_udf("array<float>")
    def embed(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for texts in series:
            plain = texts.fillna("").to_numpy(object)
            out = np.zeros((len(plain), dims), np.float32)
            at = np.array([i for i, t in enumerate(plain) if t.strip()], int)
            for a in range(0, len(at), batch):
                some = at[a : a + batch]
                made = np.asarray(model(list(plain[some])), np.float64)
                size = np.linalg.norm(made, axis=1, keepdims=True)
                out[some] = made / np.where(size > 0, size, 1)
            yield pd.Series(list(out))

    return embed


def mean_pooled(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Averages of token vectors (text, token, dimension) under a mask."""
    weight = mask[..., None].astype(np.float64)
    return (tokens * weight).sum(1) / np.maximum(weight.sum(1), 1e-9)


def first_pooled(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The vector of each text's first token that its mask shows, which models with a leading class token put there; zeros for a text of none."""
    shown = mask.astype(bool)
    first = tokens[np.arange(len(tokens)), shown.argmax(axis=1)].astype(np.float64)
    return np.where(shown.any(axis=1)[:, None], first, 0.0)


def routed(sections: DataFrame, title: Embedder, content: Embedder, text: str = "content_text", flag: str = "is_heading", version: str = "1.0") -> DataFrame:
    """Headings through one model, the rest through another, in one pass; rows without a flag have no embedding and go."""
    rows = sections.filter(F.col(flag).isNotNull())
    vector = F.when(F.col(flag), title(F.col(text))).otherwise(content(F.col(text)))
    return rows.withColumns({"embedding_type": F.when(F.col(flag), "title").otherwise("content"), "embedding_vector": vector, "word_count": tx.word_count(F.col(text)), "model_version": F.lit(version)}).withColumn("vector_length", F.size("embedding_vector"))


def statistics(embedded: DataFrame) -> DataFrame:
    """Per type: vectors, their length, how many are zero, mean words."""
    return embedded.groupBy("embedding_type").agg(F.count("*").alias("n"), F.min("vector_length").alias("vector_length"), F.count_if(vx.is_zero(F.col("embedding_vector"))).alias("zero_vectors"), F.avg("word_count").alias("avg_word_count"))
