"""Incremental ingestion: whole documents arrive as files and are upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docloom.sources import io


def upsert_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], transform: Callable[[DataFrame], DataFrame] = lambda df: df, once: bool = True) -> StreamingQuery:
    """Reads new Parquet files under ``source``, transforms each batch and upserts it; a batch that is run again changes nothing."""
    stream = spark.readStream.schema(schema).parquet(source)

    def write(batch: DataFrame, _: int) -> None:
        io.merge_upsert(batch.sparkSession, target, transform(batch), keys)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
