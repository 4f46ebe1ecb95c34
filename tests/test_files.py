"""Scans of stored files under deadlines, and files written to a store."""

import os
import time

import pytest
from docloom.operators import evaluate, extraction
from docloom.sources import files
from pyspark.sql import functions as F


def readers():
    """Functions that travel by value, as workers do not have this module."""

    def picky(content: bytes) -> dict:
        import os
        import time

        if content.startswith(b"hang"):
            time.sleep(60)
        if content.startswith(b"crash"):
            os._exit(3)
        if content.startswith(b"bad"):
            raise ValueError("cannot read this")
        return {"pages": [content.decode()], "page_count": 1, "characters": len(content), "is_scanned": False}

    def lenient(content: bytes) -> dict:
        if b"always" in content:
            raise ValueError("nor this")
        return {"pages": ["?"], "page_count": 1, "characters": 0, "is_scanned": False}

    return picky, lenient


@pytest.fixture
def folder(tmp_path):
    for name, content in {"a.txt": "good", "b.txt": "hang", "c.txt": "crash", "d.txt": "bad", "e.txt": "bad always", "f.txt": "", "g.bin": "other", "deep/h.txt": "hang always", "big.txt": "x" * 5000}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(content)
    return str(tmp_path)


def test_a_file_costs_its_own_attempt_only(spark, folder):
    began = time.time()
    rows = files.read_folder(spark, folder, list(zip(("picky", "lenient"), readers(), strict=True)), seconds=1.5, pattern="*.txt", largest=1000)
    got = {os.path.basename(r.path): r for r in rows.collect()}
    assert time.time() - began < 45  # two hang for sixty seconds
    assert set(got) == {"a.txt", "b.txt", "c.txt", "d.txt", "e.txt", "h.txt", "big.txt"}  # the empty one is in no scan
    assert got["a.txt"].pages == ["good"] and got["a.txt"].tools_used == ["picky"] and got["a.txt"].error_message is None
    for name in "bcd":
        assert got[f"{name}.txt"].tools_used == ["picky", "lenient"] and got[f"{name}.txt"].pages == ["?"]
    assert "cannot read this" in got["e.txt"].error_message and "nor this" in got["e.txt"].error_message
    assert "no result after" in got["h.txt"].error_message
    assert "5000 bytes" in got["big.txt"].error_message and got["big.txt"].tools_used == []
    pages = rows.select(F.col("path").alias("document_id"), F.when(F.col("error_message").isNull(), 1).alias("page_number"), F.get("tools_used", F.lit(0)).alias("tool"), "error_message")
    states = {os.path.basename(r.document_id): r.processing_status for r in extraction.registry(pages).collect()}
    assert {n for n, s in states.items() if s == "FAILED"} == {"e.txt", "h.txt", "big.txt"}


def test_one_process_serves_all_files():
    with files.Readers(list(readers()), 1.0) as process:
        assert [process.call(1, b"x")["page_count"] for _ in range(50)] == [1] * 50 and process.started == 1
        with pytest.raises(TimeoutError, match="no result"):
            process.call(0, b"hang")
        with pytest.raises(RuntimeError, match="ended"):
            process.call(0, b"crash")
        with pytest.raises(RuntimeError, match="cannot read"):
            process.call(0, b"bad")
        assert process.call(0, b"fine")["pages"] == ["fine"] and process.started == 3
        child = process.child
    assert not child.is_alive()


def test_a_scan_reads_no_more_than_it_must(spark, folder):
    small, large = files.scan(spark, folder, "*.txt", 1000)
    assert small.select("path", "length").count() == 6 and [r.length for r in large.collect()] == [5000]
    assert "content" not in large.select("path", "length")._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_files_are_written_whole(spark, tmp_path, scheme):
    df = spark.createDataFrame([("a.txt", "één\n", 1), ("b.txt", None, 2), ("c.txt", "", 3)], "name string, text string, n_bytes int").repartition(2)
    out = {os.path.basename(r.path): r.n_bytes for r in files.write_files(df, f"{scheme}{tmp_path}/new").collect()}
    assert out == {"a.txt": 6, "b.txt": 0, "c.txt": 0} and sorted(os.listdir(tmp_path / "new")) == ["a.txt", "b.txt", "c.txt"]
    assert (tmp_path / "new/a.txt").read_text() == "één\n"
    with pytest.raises(Exception, match="not a file"):
        files.write_files(spark.createDataFrame([("../x", "t")], "name string, text string"), str(tmp_path)).collect()


def test_labels_of_a_table_are_numbered(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "l string")
    assert sorted(map(tuple, evaluate.numbered_labels(df, "l").collect())) == [("a", 0), ("b", 1)]


def test_tasks_of_a_scan_follow_the_cores(spark, tmp_path):
    for i in range(400):
        (tmp_path / f"d{i}.txt").write_text(f"text {i}")
    most = files.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    small, large = files.scan(spark, str(tmp_path), "*.txt")
    assert small.rdd.getNumPartitions() <= most and large.rdd.getNumPartitions() <= most
    rows = files.read_folder(spark, str(tmp_path), [("all", lambda content: {"page_count": len(content)})], pattern="*.txt").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.page_count) for r in rows) == sorted((f"d{i}.txt", len(f"text {i}")) for i in range(400))
