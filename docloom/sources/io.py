"""Sources and sinks: schema-tolerant input, record normalising, overwrites, upserts."""

from __future__ import annotations

import atexit
import multiprocessing
import re
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string


def ensure_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Adds the columns that are missing."""
    return df.withColumns({n: c for n, c in defaults.items() if n not in df.columns})


def first_of(df: DataFrame, names: list[str], kind: str, default: object = None) -> Column:
    """The first of several alternative columns that is there and not blank, cast."""
    have = [F.expr(f"try_cast(nullif(cast(`{n}` as string), '') as {kind})") for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(default).cast(kind))


#: Alternative names of the fields of section records.
SECTION_FIELDS: dict[str, tuple[list[str], str, object]] = {
    "section_id": (["section_id", "id"], "string", None),
    "document_id": (["document_id", "doc_id"], "string", None),
    "page_number": (["page_number", "page"], "int", 0),
    "sequence_number": (["sequence_number", "sequence"], "int", 0),
    "section_type": (["section_type", "type"], "string", "paragraph"),
    "content_text": (["content_text", "text", "content"], "string", ""),
    "heading_level": (["heading_level", "level"], "int", None),
}


def normalized_records(df: DataFrame, fields: dict[str, tuple[list[str], str, object]] | None = None) -> DataFrame:
    return df.select(*[first_of(df, *spec).alias(n) for n, spec in (fields or SECTION_FIELDS).items()])


def children(df: DataFrame, field: str, keys: list[str]) -> DataFrame:
    """One child table of a nested result: keys and a row for each element of an array of structs."""
    return df.select(*keys, F.inline(field))


Extractor = Callable[[bytes], dict]


def _work(extract: bytes, content: bytes, out) -> None:
    try:
        out.send((cloudpickle.loads(extract)(content), None))
    except Exception as e:  # noqa: BLE001  told to the caller
        out.send((None, str(e)))


def time_limited(extract: Extractor, seconds: float, grace: float = 5) -> Extractor:
    """``extract`` in a process of its own, which is ended, at last killed, when its time is over; that is an error like others.

    The process comes from a server without threads, as a worker that runs threads must not fork.
    """
    packed = cloudpickle.dumps(extract)

    def run(content: bytes) -> dict:
        ways = multiprocessing.get_context("forkserver")
        here, there = ways.Pipe(duplex=False)
        child = ways.Process(target=_work, args=(packed, content, there), daemon=False)
        child.start()
        there.close()
        try:
            # What was sent is read before the process is waited for, as a large result blocks its sender.
            if not here.poll(seconds):
                raise TimeoutError(f"no result after {seconds} s")
            try:
                made, error = here.recv()
            except EOFError:
                raise RuntimeError("the process ended without a result") from None
        finally:
            here.close()
            child.terminate()
            child.join(grace)
            if child.is_alive():
                child.kill()
                child.join()
        if error is not None:
            raise RuntimeError(error)
        return made

    return run


def text_pages(content: bytes) -> dict:
    """Pages of plain text, between form feeds; refuses what is no text."""
    if content[:5] == b"%PDF-" or b"\0" in content:
        raise ValueError("not plain text")
    pages = content.decode("utf-8").split("\f")
    return {"pages": pages, "page_count": len(pages), "characters": sum(map(len, pages)), "is_scanned": False}


_OBJECT = re.compile(rb"/Type\s*/Page(?!s)")
_STREAM = re.compile(rb"<<((?:[^<>]|<<[^<>]*>>|<[^<>]*>)*)>>\s*stream\r?\n(.*?)\r?\n?endstream", re.S)
_SHOWN = re.compile(rb"\((?:[^()\\]|\\.)*\)|T\*|'|Td|TD", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t"}


def pdf_text(content: bytes) -> dict:
    """The literal strings that a PDF's plain or deflated streams show, a page for each stream that shows any, and whether it is scanned:
    its first pages have an image each but hardly a character.  A small reader; encodings of fonts are for a larger one."""
    if content[:5] != b"%PDF-":
        raise ValueError("not a PDF")
    count, pages, images = len(_OBJECT.findall(content)), [], 0
    for head, body in _STREAM.findall(content):
        if b"/Image" in head:
            images += 1
            continue
        if b"/FlateDecode" in head:
            body = zlib.decompress(body)
        text = b"".join(re.sub(rb"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), x[1:-1], flags=re.S) if x[:1] == b"(" else b"\n" for x in _SHOWN.findall(body))
        if shown := text.decode("latin-1").strip():
            pages.append(shown)
    count = count or len(pages)
    if not count:
        raise ValueError("no pages")
    total = sum(map(len, pages))
    return {"pages": pages, "page_count": count, "characters": total, "is_scanned": images > 0 and total < 100 * min(3, count)}


#: Readers in the order in which they are tried, by name.
EXTRACTORS: list[tuple[str, Extractor]] = [("pdf_text", pdf_text), ("text_pages", text_pages)]
EXTRACTED = "path string, tools_used array<string>, error_message string, pages array<string>, page_count int, characters long, is_scanned boolean"


def extract_files(files: DataFrame, extractors: list[tuple[str, Extractor]], schema: str) -> DataFrame:
    """Runs extractors over ``path, content`` until one succeeds; a file that none can read is a row with its errors, not a failed job.

    ``schema`` must have ``path string, tools_used array<string>, error_message string`` and the fields that extractors return.
    """

    kind = pa.schema(arrow_fields(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for path, content in zip(*batch.columns, strict=True):
                row: dict = {"path": path.as_py(), "tools_used": [], "error_message": None}
                errors, raw = [], content.as_py()
                for name, extract in extractors:
                    row["tools_used"] = [*row["tools_used"], name]
                    try:
                        row |= extract(bytes(raw))
                        errors = []
                        break
                    except Exception as e:  # noqa: BLE001  any failure passes the file to the next extractor
                        errors.append(f"{name}: {e}"[:1000])
                row["error_message"] = "; ".join(errors)[:1000] or None
                rows.append({n: row.get(n) for n in kind.names})
                held += len(raw or b"") + 100
                if held >= 1_000_000:  # results are handed on by the bytes that made them
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return files.select("path", "content").mapInArrow(run, schema)


def arrow_fields(schema: str) -> list[pa.Field]:
    kind = to_arrow_type(_parse_datatype_string(schema))
    return [kind.field(i) for i in range(kind.num_fields)]


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, skip_empty: bool = False, dynamic: bool = False, most_rows: int | None = None) -> bool:
    """Puts a table in the place of another, with its own schema; says whether it did, as an empty one may be skipped.

    ``dynamic``: only the partitions that ``df`` has rows of are replaced, the others stay as they are.  Rows are rebalanced by partition before
    they are written, so a small partition is one file and a large one, however hot, is written by many tasks; no file has more than ``most_rows``.
    """
    if skip_empty and df.isEmpty():
        return False
    if dynamic and not partition_by:
        raise ValueError("dynamic overwriting needs partitions")
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if most_rows:
        writer = writer.option("maxRecordsPerFile", most_rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return True


def shared_folder(spark: SparkSession) -> str:
    """A new folder beneath the one that all machines share; a local session without one gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="docloom-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/docloom/{uuid.uuid4().hex}"


def create_table(spark: SparkSession, name: str, schema: str, partition_by: list[str] | None = None) -> None:
    """An empty Parquet table, unless there is one."""
    parts = f" partitioned by ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"create table if not exists {name} ({schema}) using parquet{parts}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drops a table if it is there."""
    spark.sql(f"drop table if exists {name}")


def merged(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, delete_missing: bool = False) -> DataFrame:
    """``target`` after an upsert: matched rows (null-safe keys) take ``update`` from the source, new rows come in whole.

    The source holds a key once; ``merge_upsert`` makes sure of that.
    """
    update = [c for c in target.columns if c not in keys] if update is None else update
    t, s = target.alias("t").withColumn("__t", F.lit(True)), source.alias("s").withColumn("__s", F.lit(True))
    on = None
    for c in keys:
        same = F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
        on = same if on is None else on & same
    joined = t.join(s, on, "right" if delete_missing else "full")
    matched, new = F.col("__t").isNotNull() & F.col("__s").isNotNull(), F.col("__t").isNull()
    cols = [F.when(new | (matched & F.lit(c in update)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return joined.select(*cols)


def merge_upsert(spark: SparkSession, path: str, source: DataFrame, keys: list[str], update: list[str] | None = None, delete_missing: bool = False) -> None:
    """Upserts into a Parquet table, one writer at a time.

    The result is written to ``path.new``; then the table is renamed to ``path.old``, the result takes its place, and the old one goes.
    Wherever that stops, the next call first puts back what is whole: a table that is missing is the complete ``path.new`` if there is
    one, else ``path.old``.  A source that holds a key twice is refused, as a MERGE refuses it, before anything is written.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    table, new, old = (fs_path(path + end) for end in ("", ".new", ".old"))
    fs = table.getFileSystem(spark._jsc.hadoopConfiguration())
    recover(spark, path)
    if not source.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"the source holds a key ({', '.join(keys)}) more than once")
    there = fs.exists(table)
    out = merged(spark.read.parquet(path), source, keys, update, delete_missing) if there else source
    out.write.mode("overwrite").parquet(new.toString())
    if there:
        _moved(fs, table, old)
    _moved(fs, new, table)
    fs.delete(old, True)


def recover(spark: SparkSession, path: str) -> None:
    """The table at ``path`` as the last whole upsert left it, whatever stopped one since."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    table, new, old, whole = (fs_path(path + end) for end in ("", ".new", ".old", ".new/_SUCCESS"))
    fs = table.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(table) and fs.exists(old):
        _moved(fs, new if fs.exists(whole) else old, table)
    if fs.exists(table):
        fs.delete(new, True)
        fs.delete(old, True)


def _moved(fs, here, there) -> None:
    if not fs.rename(here, there):
        raise OSError(f"could not rename {here} to {there}")


def completed(registry: DataFrame, sections: DataFrame, classified: DataFrame, key: str = "document_id") -> DataFrame:
    """Registry rows whose documents have as many classified as sections become DOCUMENT_PREPROCESSING_COMPLETE."""
    a, b = sections.groupBy(key).agg(F.count("*").alias("__a")), classified.groupBy(key).agg(F.count("*").alias("__b"))
    done = a.join(b, key).filter("__a = __b").select(key, F.lit("DOCUMENT_PREPROCESSING_COMPLETE").alias("__done"))
    return registry.join(done, key, "left").withColumn("processing_status", F.coalesce("__done", "processing_status")).drop("__done")
