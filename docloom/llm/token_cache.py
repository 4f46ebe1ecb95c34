"""Token counts through a digest cache.

A count is stored under the digest of the text's normalised content and the digest of the
tokenizer's file.  The content is normalised by the tokenizer's own normaliser, of whose output alone its
tokens are made, so texts that differ in form only share a count and the count is exact.  A call joins the
digests to what is stored, encodes each distinct missing content once, appends the new counts, and joins again.

Texts are told apart by the digest of their bytes first, in the JVM; each distinct one is normalised once.  These joins
move digests only; of a content that several rows hold, one row is encoded, chosen by a pre-aggregated minimum, so no
text is shuffled unless the list of misses is too large to broadcast.  The cache is partitioned by tokenizer; a call reads its own part.

Defined results: a null text counts as an empty one.  Repeated rows, and rows
that share an id, each get their text's count; a content is encoded once, however many rows hold it.
Columns that clash with an added one (``n_bytes``, ``n_tokens``) are replaced.  Counts are of whole texts, without added tokens.
Two writers may store one digest twice; both hold the same count, and reads take one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import kernels as k
from docloom.llm.store import Table, shared_dir

_CACHE = "digest binary, n_tokens long"
#: Digests of misses, 40 bytes a row, are broadcast up to these bounds.
_MISSES = {"max_bytes": 32_000_000, "max_rows": 400_000}
_loaded: dict[str, Callable[[list[str]], list[int]]] = {}


def tokenizer_digest(path: str) -> bytes:
    return hashlib.sha256(Path(path).read_bytes()).digest()


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens with the library that the file is for; loaded once a worker."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        elif path.endswith(".json"):
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            words = Tokenizer.from_file(path)
            words.no_truncation()
            words.no_padding()
            _loaded[path] = lambda texts: [len(x.ids) for x in words.encode_batch(texts, add_special_tokens=False)]
        else:
            raise ValueError(f"no tokenizer library for {path}")
    return _loaded[path]


def normaliser(path: str) -> Callable[[list[str]], list[str]]:
    """The tokenizer's own normalisation; its tokens are made of the result alone."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return model.normalize
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path).normalizer
    # Special strings are cut out of the raw text, so with them the text itself is the content.
    return (lambda texts: texts) if made is None or Tokenizer.from_file(path).get_added_tokens_decoder() else (lambda texts: [made.normalize_str(x) for x in texts])


def _normalise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = normaliser(path)
        for batch in batches:
            for a, b in k.slices(batch.column(1)):
                made = [hashlib.sha256(x.encode()).digest() for x in plain(batch.column(1).slice(a, b - a).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(made, pa.binary())], names=["raw", "row", "digest"])

    return run


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            for a, b in k.slices(batch.column(1)):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(count(texts), pa.int64())], names=["digest", "n_tokens"])

    return run


def kept_cache(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/docloom/token-cache"


def forget_counts(spark: SparkSession, tokenizer_path: str, cache_path: str | None = None) -> None:
    """Drops the stored counts of a tokenizer."""
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{cache_path or kept_cache(spark)}/tokenizer={tokenizer_digest(tokenizer_path).hex()}")
    part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens``; new counts are appended to the Parquet table at ``cache_path`` (a folder for each tokenizer).

    Without a path the cache is the folder ``docloom/token-cache`` in the shared folder.  It is kept between calls and sessions and goes with
    the shared folder; ``forget_counts`` drops it.
    """
    spark = docs.sparkSession
    cache_path = cache_path or kept_cache(spark)
    version = tokenizer_digest(tokenizer_path)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    raw = F.unhex(F.sha2(text.cast("binary"), 256))

    part = f"{cache_path}/tokenizer={version.hex()}"

    def stored() -> DataFrame:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(part)
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.createDataFrame([], _CACHE)
        return spark.read.schema(_CACHE).parquet(part)

    # One row of each distinct text: the smallest of a per-row number that the row itself determines, and how many rows have it.
    rows = docs.select(raw.alias("raw"), text.alias("text"), F.xxhash64(*_hashable(docs)).alias("row"))
    digests = rows.select("raw", "text", "row").mapInArrow(_normalise(tokenizer_path), "raw binary, row long, digest binary")
    each = digests.groupBy("raw", "row").agg(F.min("digest").alias("digest"), F.count("*").alias("copies"))
    seen = Table(each.groupBy("raw").agg(F.min("digest").alias("digest"), F.min(F.struct("row", "copies")).alias("one")).select("raw", "digest", "one.*"), "digests")
    misses = seen.df.join(stored(), "digest", "left_anti").groupBy("digest").agg(F.min(F.struct("raw", "row", "copies")).alias("one"))
    misses = Table(misses.select("digest", "one.*"), "misses")
    if not misses.df.isEmpty():
        # Rows that are equal in all columns are told apart by nothing; of these, and of these alone, one is chosen by a shuffle of their texts.
        alone, equal = (misses.df.filter(f"copies {x} 1").select("digest", "raw", "row") for x in ("=", ">"))
        hint = F.broadcast if misses.small(**_MISSES) else lambda df: df
        todo = rows.join(hint(alone), ["raw", "row"]).select("digest", "text")
        if not equal.isEmpty():
            todo = todo.union(rows.join(hint(equal), ["raw", "row"]).select("digest", "text").dropDuplicates(["digest"]))
        todo.mapInArrow(_encode(tokenizer_path), _CACHE).write.mode("append").parquet(part)
    counts = Table(seen.df.join(stored().dropDuplicates(["digest"]), "digest").select("raw", "n_tokens"), "counts")
    seen.drop()
    misses.drop()
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    keyed = docs.select(*keep, F.octet_length(text).cast("long").alias("n_bytes"), raw.alias("__docloom_raw"))
    right = counts.side(**_MISSES).select(F.col("raw").alias("__docloom_raw"), "n_tokens")
    return keyed.join(right, "__docloom_raw", "left").drop("__docloom_raw")


def _hashable(docs: DataFrame) -> list[Column]:
    """All columns whose values xxhash64 takes, which are all but maps and variants."""
    return [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()] or [F.lit(0)]
