"""The pipeline on the smallest tables, each stage against what it must do."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_stages(spark):
    import corpus_pipeline
    from docloom.llm import decontam, jaccard_join
    from docloom.llm.store import Table

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = Table(stage(spark, docs, DATA), name).df
        assert docs.columns == columns
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    groups = jaccard_join.near_duplicate_groups(docs)
    assert groups.filter("id <> component_id").count() == 0
    assert decontam.mark_benchmark_words(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter("n_hit > 0").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in out} == kept["private_data"]
    again = corpus_pipeline.run(spark, DATA).collect()
    cols = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in cols) for r in again) == sorted(tuple(r[c] for c in cols) for r in out)


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
