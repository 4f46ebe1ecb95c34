"""Intermediate tables in the folder that all executors share.

A written table cuts lineage, survives lost executors, and knows its own size.
The folder is the session's ``spark.checkpoint.dir``; where that is unset, a local
session gets a temporary folder, and any other is refused, as its machines share none.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A side of a join is broadcast only if its values, as measured row by row (strings and arrays at their full length), hold no more
#: bytes than this, and it has no more rows; its hash table then stays within some 30 MB.
BROADCAST_BYTES = 12_000_000
BROADCAST_ROWS = 200_000
#: Files of more bytes than this are not measured; they are too large in any case.
_LOOK_BYTES = 64_000_000


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="docloom-")
        atexit.register(shutil.rmtree, found, True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_scopes: list[list[Table]] = []


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Drops at its end all tables that were written within, but for those that are told to ``keep``."""
    _scopes.append([])
    try:
        yield
    finally:
        for table in _scopes.pop():
            table.drop()


def integral(df: DataFrame, name: str) -> Column:
    """An id column as longs; an id of another type than a whole number is refused before anything runs."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"column {name} holds {kind.simpleString()}, not whole numbers")
    return F.col(f"`{name}`").cast("long")


class Table:
    """A table written to the shared folder."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/docloom/{name}-{uuid.uuid4().hex}"
        self.schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        if _scopes:
            _scopes[-1].append(self)

    def keep(self) -> Table:
        """This table, which now belongs to the scope around the one it was written in, or to none."""
        for i in range(len(_scopes) - 1, -1, -1):
            if self in _scopes[i]:
                _scopes[i].remove(self)
                if i:
                    _scopes[i - 1].append(self)
                break
        return self

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _at(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop, hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def bytes(self) -> int:
        hadoop, fs = self._at()
        return fs.getContentSummary(hadoop).getLength()

    def small(self, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> bool:
        if self.bytes() > max(max_bytes, _LOOK_BYTES):
            return False
        found = self.df.agg(F.count("*").alias("rows"), F.sum(_row_bytes(self.schema)).alias("bytes")).first()
        return found.rows <= max_rows and (found.bytes or 0) <= max_bytes

    def side(self, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS) -> DataFrame:
        """This table as the small side of a join: broadcast if its measured size allows, else left to a shuffle join."""
        return F.broadcast(self.df) if self.small(max_bytes, max_rows) else self.df

    def drop(self) -> None:
        hadoop, fs = self._at()
        fs.delete(hadoop, True)


def _row_bytes(schema: T.StructType) -> Column:
    """What a row takes in memory, about: eight bytes a value, and what strings, arrays and structs hold."""
    total = F.lit(8 * len(schema.fields) + 16).cast("long")
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_bucket(df: DataFrame, tasks: int) -> DataFrame:
    """``df`` dealt by its column ``bucket`` to so many tasks, or to as many as the session's shuffles have, if those are more."""
    return df.repartition(max(tasks, shuffle_partitions(df.sparkSession)), "bucket")


def extended(df: DataFrame, columns: list[str], **added: T.DataType) -> T.StructType:
    """The schema of some columns of a table and of added ones."""
    return T.StructType([f for f in df.schema.fields if f.name in columns] + [T.StructField(n, t) for n, t in added.items()])


def set_aside(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``df`` with columns of these names out of the way; ``put_back`` brings them back."""
    return df.withColumnsRenamed({c: f"__docloom_kept_{c}" for c in df.columns if c in names})


def put_back(df: DataFrame, columns: list[str], names: tuple[str, ...]) -> DataFrame:
    """Only ``columns``, those set aside under their own names again."""
    return df.drop(*names).withColumnsRenamed({f"__docloom_kept_{c}": c for c in names}).select(*[f"`{c}`" for c in columns])
