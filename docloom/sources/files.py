"""Files in a store: scanned, read by a chain of readers under a deadline for each, and written whole.

A scan lists a folder and packs files into tasks by their sizes; empty files hold nothing and are in no scan, and what is larger than a bound is not loaded and becomes a row with an
error.  Each task has one process that runs the readers, started when the first file comes and used for all; a reader that exceeds its deadline, or
takes its process down, costs that file's attempt and a new process, and the file goes to the next reader.
"""

from __future__ import annotations

import multiprocessing
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources import io

#: Seconds that a reader has for a file, and bytes of a file that is loaded.
SECONDS = 90.0
START_SECONDS = 120.0
#: Tasks, and so processes started, for each core of the cluster, at the most.
TASKS_A_CORE = 4
#: Results that leave a task together, and bytes of the files that they were read from.
RESULT_ROWS = 256
RESULT_BYTES = 1_048_576
LARGEST = 512 * 1024 * 1024


def scan(spark: SparkSession, folder: str, pattern: str = "*", largest: int = LARGEST) -> tuple[DataFrame, DataFrame]:
    """``path, length, content`` of the files beneath a folder whose names fit, and ``path, length`` of those that are too large to load."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    small = files.filter(F.col("length") <= largest).select("path", "length", "content")
    return together(small), together(files.filter(F.col("length") > largest).select("path", "length"))


def together(files: DataFrame) -> DataFrame:
    """A scan of many small files has a task for every few of them; some are put together, so that tasks follow the cores and not the files."""
    return files.coalesce(TASKS_A_CORE * files.sparkSession.sparkContext.defaultParallelism)


def _serve(packed: bytes, pipe) -> None:
    readers = cloudpickle.loads(packed)
    pipe.send("ready")
    while True:
        try:
            number, content = pipe.recv()
        except EOFError:
            return
        try:
            pipe.send((readers[number](content), None))
        except Exception as e:  # noqa: BLE001  told to the caller
            pipe.send((None, str(e)))


class Readers:
    """A process that runs readers, one call at a time, each with a deadline; it is replaced when it does not answer."""

    def __init__(self, readers: list[io.Extractor], seconds: float):
        self.packed, self.seconds, self.child, self.pipe, self.started = cloudpickle.dumps(readers), seconds, None, None, 0

    def __enter__(self) -> Readers:
        return self

    def __exit__(self, *_: object) -> None:
        self.end()

    def end(self) -> None:
        if self.child is not None:
            self.pipe.close()
            self.child.terminate()
            self.child.join(5)
            if self.child.is_alive():
                self.child.kill()
                self.child.join()
            self.child = None

    def call(self, number: int, content: bytes) -> dict:
        if self.child is None:
            # From a server without threads, as a worker that runs threads must not fork.
            ways = multiprocessing.get_context("forkserver")
            self.pipe, there = ways.Pipe()
            self.child = ways.Process(target=_serve, args=(self.packed, there), daemon=False)
            self.child.start()
            there.close()
            self.started += 1
            if not self.pipe.poll(START_SECONDS):  # a file's time begins when there is someone to read it
                self.end()
                raise RuntimeError("the process did not start")
            self.pipe.recv()
        try:
            self.pipe.send((number, content))
            if not self.pipe.poll(self.seconds):
                raise TimeoutError(f"no result after {self.seconds} s")
            made, error = self.pipe.recv()
        except TimeoutError:
            self.end()
            raise
        except (EOFError, OSError):
            self.end()
            raise RuntimeError("the process ended without a result") from None
        if error is not None:
            raise RuntimeError(error)
        return made


def extracted(files: DataFrame, readers: list[tuple[str, io.Extractor]], schema: str = io.EXTRACTED, seconds: float = SECONDS) -> DataFrame:
    """The first reader that succeeds on each file of ``path, content``; a file that none can read is a row with its errors.

    ``schema`` must have ``path string, tools_used array<string>, error_message string`` and the fields that readers return.
    """
    kind = pa.schema(io.arrow_fields(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        held = 0
        with Readers([read for _, read in readers], seconds) as process:
            for batch in batches:
                for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    row, errors = {"path": path, "tools_used": []}, []
                    raw = content.as_py()
                    for i, (name, _) in enumerate(readers):
                        row["tools_used"].append(name)
                        try:
                            row |= process.call(i, raw)
                            errors = []
                            break
                        except Exception as e:  # noqa: BLE001  any failure passes the file to the next reader
                            errors.append(f"{name}: {e}"[:1000])
                    row["error_message"] = "; ".join(errors)[:1000] or None
                    done.append({n: row.get(n) for n in kind.names})
                    held += len(raw)
                    if len(done) >= RESULT_ROWS or held >= RESULT_BYTES:
                        yield pa.RecordBatch.from_pylist(done, schema=kind)
                        done, held = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=kind)

    return together(files.select("path", "content")).mapInArrow(run, schema)  # each task starts a process


def read_folder(spark: SparkSession, folder: str, readers: list[tuple[str, io.Extractor]], schema: str = io.EXTRACTED, seconds: float = SECONDS, pattern: str = "*", largest: int = LARGEST) -> DataFrame:
    """``extracted`` of all files of a folder, those too large to load included, as rows with that error."""
    small, large = scan(spark, folder, pattern, largest)
    refused = large.select("path", F.array().cast("array<string>").alias("tools_used"), F.format_string("%d bytes are more than the %d that are loaded", "length", F.lit(largest)).alias("error_message"))
    return extracted(small, readers, schema, seconds).unionByName(refused, allowMissingColumns=True)


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address (local, hdfs, s3, gs, abfs) and the folder's path in it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", folder):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder.removeprefix("file:")


def write_files(df: DataFrame, folder: str, name: str = "name", text: str = "text") -> DataFrame:
    """A text file for each row, named by a column and put in place whole; returns ``path`` and ``n_bytes`` of each when run.

    The folder is in a store that all machines reach; a task that runs again writes the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            paths, sizes = [], []
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if file is None or os.path.basename(file) != file or file in ("", ".", ".."):
                    raise ValueError(f"not a file's name: {file}")
                raw = (content.as_py() or "").encode()
                part = f"{base}/.{file}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw)
                store.move(part, f"{base}/{file}")
                paths.append(f"{folder}/{file}")
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], names=["path", "n_bytes"])

    return df.select(name, text).mapInArrow(run, "path string, n_bytes long")
