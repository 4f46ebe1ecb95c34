"""Upserts that rewrite only the partitions they touch.

Touched are the partitions that source rows belong to, and those that hold a row with a key of the source (a row whose partition
changes leaves its old one).  Their rows are merged and written beside the table; a journal then says what is to be swapped, and each
partition is renamed out and in.  Files of other partitions keep name and time.

One writer at a time.  Wherever a call stops, ``recover_partitions`` (which every call begins with) makes it whole: without a journal nothing has been
swapped and what was written goes; with one the remaining partitions are swapped.  Readers in between may see some partitions new and some old.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources import io


class _Files:
    """A table's folder and, beside it, what an upsert writes before it swaps."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.new, self.old, self.journal = (f"{self.path}.{end}" for end in ("new", "old", "journal"))
        self.fs = self.at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def drop(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def move(self, here: str, there: str) -> None:
        self.fs.mkdirs(self.at(there).getParent())
        io._moved(self.fs, self.at(here), self.at(there))

    def write_journal(self, text: str) -> None:
        """Whole or not at all."""
        out = self.fs.create(self.at(self.journal + ".part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(self.journal + ".part", self.journal)

    def read_journal(self) -> str:
        stream = self.fs.open(self.at(self.journal))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _folders(df: DataFrame, depth: int) -> set[str]:
    """Partition folders, as named below the table's, of the files that rows come from; as many as partitions."""
    decode = df.sparkSession._jvm.java.net.URLDecoder.decode
    files = df.select(F.regexp_extract("__file", r"^(.*)/[^/]*$", 1)).distinct().collect()
    return {"/".join(decode(r[0].replace("+", "%2B"), "UTF-8").split("/")[-depth:]) for r in files}


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str], update: list[str] | None = None) -> list[str]:
    """Upserts into a Parquet table partitioned by ``partition_by``; returns the folders of the partitions that were rewritten.

    The source has all columns of the table.  Keys compare null-safe; matched rows take ``update`` (all but the keys by default), new rows come in
    whole.  A source that holds a key twice is refused before anything is written, and an empty one changes nothing.  An empty text as the value of a
    partition reads back as null, as Spark writes it.  Large partitions are split between tasks (rebalanced by partition).
    """
    files = _Files(spark, path)
    recover_partitions(spark, path)
    if not source.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"the source holds a key ({', '.join(keys)}) more than once")
    if not files.exists(files.path):
        source.write.partitionBy(*partition_by).parquet(files.path)
        return []
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    own = source.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()  # as many as partitions
    reached = {"/".join(name(c, r[c]) for c in partition_by) for r in own}
    there = spark.read.schema(source.schema).parquet(files.path)
    on = reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys])
    held = there.withColumn("__file", F.col("_metadata.file_path")).alias("t").join(source.select(*keys).alias("s"), on, "left_semi")
    touched = sorted(_folders(held, len(partition_by)) | {f for f in reached if files.exists(f"{files.path}/{f}")})
    now = spark.read.option("basePath", files.path).schema(source.schema).parquet(*[f"{files.path}/{f}" for f in touched]) if touched else there.limit(0)
    out = io.merged(now, source, keys, update).select(*source.columns)
    out.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(files.new)
    made = sorted(f for f in reached | set(touched) if files.exists(f"{files.new}/{f}"))
    files.write_journal(json.dumps({"in": made, "out": touched}))
    recover_partitions(spark, path)
    return sorted({*made, *touched})


def recover_partitions(spark: SparkSession, path: str) -> None:
    """Ends what an upsert has begun: swaps what its journal lists, or drops what it wrote before there was one."""
    files = _Files(spark, path)
    if files.exists(files.journal):
        todo = json.loads(files.read_journal())
        for f in sorted({*todo["in"], *todo["out"]}):
            here, new, old = (f"{base}/{f}" for base in (files.path, files.new, files.old))
            waits = files.exists(new)
            # A partition that came in already is left alone; one that nothing comes in for only goes out.
            if f in todo["out"] and files.exists(here) and not files.exists(old) and (waits or f not in todo["in"]):
                files.move(here, old)
            if waits:
                files.move(new, here)
        files.drop(files.journal)
    for rest in (files.new, files.old, files.journal + ".part"):
        files.drop(rest)
