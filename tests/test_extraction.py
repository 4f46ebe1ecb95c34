"""Extraction rows, taggers, embedders, annotated texts and table helpers on literals."""

import json
import time

import numpy as np
import pytest
from docloom.functions import embedding
from docloom.operators import entities as ent
from docloom.operators import classify, evaluate, extraction, structure, tagging
from docloom.sources import corpus, io
from pyspark.sql import functions as F


def test_pages_blank_a_table_of_contents(spark):
    rows = [(1, 1, 1, "toc", "Contents of this book"), (1, 2, 1, "toc", "One ..... 4"), (1, 3, 2, "equation", "a = b"), (1, 4, 2, "figure", "x")]
    items = spark.createDataFrame(rows, "document_id int, sequence_number int, page_number int, section_type string, content_text string")
    got = {r.page_number: r for r in extraction.pages(items).collect()}
    assert got[1].is_toc and got[1].text == "" and got[2].text == "a = b\nx"
    assert (got[2].images_count, got[2].formulas_count, got[2].section_count) == (1, 1, 2)


def test_paragraphs_and_page_sections(spark):
    texts = spark.createDataFrame([(1, " a \n\n\n\nb\nc"), (2, ""), (3, None)], "document_id int, text string")
    got = extraction.paragraph_sections(texts).select("document_id", "sequence_number", "content_text").orderBy("sequence_number").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a"), (1, 2, "b\nc")]
    assert extraction.page_sections(texts.withColumn("page_number", F.lit(1))).count() == 1


def test_registry_rule(spark):
    rows = [(1, 1, "digital", None), (1, None, "digital", "e" * 2000), (2, None, "raw", "bad"), (3, None, "raw", None)]
    got = {r.document_id: r for r in extraction.registry(spark.createDataFrame(rows, "document_id int, page_number int, tool string, error_message string")).collect()}
    assert [got[i].processing_status for i in (1, 2, 3)] == ["SUCCESS", "FAILED", "SUCCESS"]
    assert len(got[1].error_message) == 1000 and got[1].page_count == 1 and got[1].tools_used == ["digital"]


def test_gazetteer_takes_the_longest_phrase(spark):
    tagger = tagging.gazetteer({"heart": "BIOMARKER", "heart failure": "CONDITION", "aspirin": "DRUG"})
    rows = spark.createDataFrame([(1, "Heart failure, then aspirin; heart."), (2, ""), (3, None)], "id int, text string")
    got = {r.id: r for r in tagging.extracted(rows, tagger, text="text").collect()}
    assert [(e.text, e.entity_type) for e in got[1].entities] == [("Heart failure,", "CONDITION"), ("aspirin;", "DRUG"), ("heart.", "BIOMARKER")]
    assert got[1].entity_type_counts == {"BIOMARKER": 1, "CONDITION": 1, "DRUG": 1} and got[2].entity_count == got[3].entity_count == 0
    flat = tagging.clinical_entities(tagging.extracted(rows, tagger, text="text"), ["id"], "id").orderBy("entity_id").collect()
    assert [(r.entity_id, r.start_position, r.end_position) for r in flat] == [("1_e0001", 0, 14), ("1_e0002", 20, 28), ("1_e0003", 29, 35)]
    long = spark.createDataFrame([(1, "see A b c d, a b")], "id int, text string")
    many = {f"term {i}": "DRUG" for i in range(6_000)} | {"a b c d": "DRUG", "a b": "CONDITION"}
    assert [(e.text, e.entity_type) for e in tagging.extracted(long, tagging.gazetteer(many), text="text").first().entities] == [("A b c d,", "DRUG"), ("a b", "CONDITION")]


def test_models_embed_blank_texts_as_zero(spark):
    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    rows = spark.createDataFrame([(1, "abc", True), (2, " ", False), (3, None, False), (4, "x", None)], "id int, content_text string, is_heading boolean")
    embed = embedding.model_embedder(factory, 2)
    got = {r.id: r for r in embedding.routed(rows, embed, embed).collect()}
    assert got[1].embedding_type == "title" and np.allclose(got[1].embedding_vector, np.array([3, 1]) / np.sqrt(10))
    assert got[2].embedding_vector == got[3].embedding_vector == [0, 0] and 4 not in got
    assert np.allclose(embedding.mean_pooled(np.array([[[2.0], [4.0], [9.0]]]), np.array([[1, 1, 0]])), [[3.0]])


def test_annotated_texts(spark, tmp_path):
    marks = [{"type": "labels", "value": {"start": 4, "end": 7, "labels": ["DRUG"]}}, {"type": "labels", "value": {"start": 0, "end": 3, "labels": ["CONDITION"]}}, {"type": "choices"}]
    tasks = [{"id": 1, "data": {"text": "abc def gh"}, "annotations": [{"result": marks}, {"result": []}]}, {"id": 2, "data": {"text": "x y"}, "annotations": []}]
    (tmp_path / "tasks.json").write_text(json.dumps(tasks))
    rows = corpus.training_rows(corpus.annotated_texts(spark, str(tmp_path / "tasks.json")))
    got = {r.id: r for r in rows.collect()}
    assert got[1].tokens == ["abc", "def", "gh"] and got[1].ner_tags == ["B-CONDITION", "B-DRUG", "O"]
    assert got[2].ner_tags == ["O", "O"]
    assert {tuple(r) for r in corpus.label_counts(rows).collect()} == {("CONDITION", 1), ("DRUG", 1)}


def test_time_limits(spark):
    def slow(content):
        time.sleep(30)

    def bad(content):
        raise ValueError("unreadable")

    with pytest.raises(TimeoutError):
        io.time_limited(slow, 0.2)(b"")
    with pytest.raises(RuntimeError, match="unreadable"):
        io.time_limited(bad, 20)(b"")
    assert len(io.time_limited(lambda c: {"text": "x" * 1_000_000}, 20)(b"")["text"]) == 1_000_000


def test_tables_are_made_once_and_dropped(spark):
    for _ in range(2):
        io.create_table(spark, "docloom_made", "a int, document_id string", ["document_id"])
    assert spark.table("docloom_made").count() == 0
    for _ in range(2):
        io.drop_table(spark, "docloom_made")


def test_exploded_spans(spark):
    rows = spark.createDataFrame([(1, [("a", "DRUG")]), (2, [])], "id int, entities array<struct<text:string,entity_type:string>>")
    assert [tuple(r) for r in ent.exploded(rows).collect()] == [(1, "a", "DRUG")]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", range(1, 6))
def test_an_upsert_that_stops_loses_nothing(spark, tmp_path, monkeypatch, step):
    """Stopped before any of its steps and run again, an upsert ends as one that was not stopped."""
    path = str(tmp_path / "t")
    spark.range(10).withColumn("v", F.lit("old")).write.parquet(path)
    new = spark.range(8, 12).withColumn("v", F.lit("new"))
    moves = []
    real = io._moved

    def moved(fs, here, there):
        moves.append(there.toString())
        if step == len(moves):
            raise Stopped
        real(fs, here, there)
        if step == 2 + len(moves):
            raise Stopped

    monkeypatch.setattr(io, "_moved", moved)
    try:
        io.merge_upsert(spark, path, new, ["id"])
    except Stopped:
        pass
    monkeypatch.setattr(io, "_moved", real)
    io.recover(spark, path)
    assert spark.read.parquet(path).count() in (10, 12)
    for _ in range(2):
        io.merge_upsert(spark, path, new, ["id"])
        got = {r.id: r.v for r in spark.read.parquet(path).collect()}
        assert got == {**dict.fromkeys(range(8), "old"), **dict.fromkeys(range(8, 12), "new")}
    assert {p.name for p in tmp_path.iterdir()} == {"t"}


def test_repeated_source_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="more than once"):
        io.merge_upsert(spark, path, spark.range(2).union(spark.range(1)), ["id"])
    assert spark.read.parquet(path).count() == 3


def test_extractors(spark):
    import zlib

    page = b"BT (Hello) Tj T* (wor\\(ld) Tj ET"
    packed = zlib.compress(page)
    pdf = b"%PDF-1.4 1 0 obj <</Type /Page>> endobj 2 0 obj <</Length 9 /Filter /FlateDecode>>\nstream\n" + packed + b"\nendstream endobj"
    scan = b"%PDF-1.4 1 0 obj <</Type /Page>> endobj 2 0 obj <</Subtype /Image>>\nstream\nxx\nendstream endobj"
    files = spark.createDataFrame([("a.pdf", pdf), ("s.pdf", scan), ("t.txt", "one\ftwo".encode()), ("x.bin", b"\x00\x01")], "path string, content binary")
    got = {r.path: r for r in io.extract_files(files, io.EXTRACTORS, io.EXTRACTED).collect()}
    assert got["a.pdf"].pages == ["Hello\nwor(ld"] and not got["a.pdf"].is_scanned and got["a.pdf"].tools_used == ["pdf_text"]
    assert got["s.pdf"].is_scanned and got["s.pdf"].page_count == 1
    assert got["t.txt"].pages == ["one", "two"] and got["t.txt"].tools_used == ["pdf_text", "text_pages"] and got["t.txt"].error_message is None
    assert "not a PDF" in got["x.bin"].error_message and "not plain text" in got["x.bin"].error_message


def test_prototypes_in_blocks(spark):
    protos = spark.createDataFrame([(f"l{i}", [float(i == j) + 0.1 * i for j in range(4)]) for i in range(9)], "label string, prototype array<double>")
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, None)], "id int, vector array<double>")
    one, many = ([r.ranked for r in classify.scored(rows, protos, block=b).orderBy("id").collect()] for b in (100, 2))
    assert one[:2] == many[:2] and len(one[0]) == 9 and one[1][0].label == "l1"


def test_best_prototypes_of_many(spark):
    """Groups and blocks of any size give what the full sort gives, ties and vectors of other lengths too."""
    rng = np.random.default_rng(4)
    protos = [(i, rng.choice([-1.0, 0.0, 0.5, 1.0], 6).tolist()) for i in range(700)]
    rows = [(i, rng.choice([-1.0, 0.0, 1.0], 6).tolist()) for i in range(60)] + [(100, None), (101, [1.0]), (102, [0.0] * 6)]
    p = spark.createDataFrame(protos, "label int, prototype array<double>").repartition(3)
    v = spark.createDataFrame(rows, "id int, vector array<double>").repartition(2)
    want = {}
    for i, x in rows:
        n = np.sqrt(sum(y * y for y in x)) if x else 0
        score = [sum(a / n * b for a, b in zip(x, y, strict=True)) if x and len(x) == 6 and n else float("nan") for _, y in protos]
        order = sorted(range(700), key=lambda j: (-np.floor(abs(score[j]) * 1e6 + 0.5) * np.sign(score[j]) if score[j] == score[j] else 9e9, j))
        want[i] = order[:5]
    for block, size in ((4_096, 10**9), (64, 10**9), (64, 20_000), (7, 3_000)):
        got = {r.id: [x.label for x in r.ranked] for r in classify.scored(v, p, digits=6, block=block, k=5, group_bytes=size).collect()}
        assert {i: g for i, g in got.items() if i < 102} == {i: w for i, w in want.items() if i < 102}, (block, size)
    assert [x.label for x in classify.scored(v.filter("id = 3"), p.limit(0), k=5).first().ranked] == []


def test_memory_is_one_block():
    import tracemalloc

    class Shared:
        value = (list(range(100_000)), np.random.default_rng(1).normal(size=(100_000, 8)))

    import pyarrow as pa

    kind = pa.list_(pa.struct([("label", pa.int64()), ("score", pa.float64())]))
    x = np.random.default_rng(2).normal(size=(500, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), pa.array([[]] * 500, kind)], names=["__unit", "__best"])
    tracemalloc.start()
    (out,) = classify._best_of(Shared, 1_000, 5, None)([batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * 8 * 500 * 1_000 and peak < 8 * 500 * 100_000 / 4  # blocks of scores, not all of them
    want = np.argsort(-(x @ Shared.value[1].T), axis=1)[:, :5]
    assert [[y["label"] for y in r] for r in out.column(1).to_pylist()] == want.tolist()


def test_alignment_scores_and_marks(spark):
    rows = spark.createDataFrame([([None, 0, 0, 1, None], ["B-DRUG", "O"], [1.0, 3.0, 3.0])], "w array<int>, t array<string>, l array<double>")
    got = rows.select(evaluate.aligned(F.col("w"), F.col("t"), ["O", "B-DRUG"]).alias("a"), evaluate.softmax_best(F.col("l")).alias("b")).first()
    assert got.a == [-100, 1, -100, 0, -100] and got.b.label == 1 and abs(got.b.score - 1 / (2 + np.exp(-2.0))) < 1e-12
    text = spark.createDataFrame([("a <b> c", [(2, 5, "DRUG")])], "t string, s array<struct<start:int,end:int,label:string>>")
    assert text.select(ent.highlighted(F.col("t"), F.col("s"), html=True).alias("m")).first().m == 'a <mark class="entity" data-type="DRUG">&lt;b&gt;</mark> c'


def test_whole_rows_of_runs_and_unions(spark):
    a = spark.createDataFrame([("x", 2, "q"), ("x", 1, "p"), ("y", 3, "r")], "section_id string, n int, s string")
    assert {tuple(r) for r in structure.unique_by(a).collect()} == {("x", 1, "p"), ("y", 3, "r")}
    assert [tuple(r) for r in structure.repeated_keys(a).collect()] == [("x", 2)]
    assert structure.stacked([structure.empty_like(a), a.drop("s"), a]).count() == 6
