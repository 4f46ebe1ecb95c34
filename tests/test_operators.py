"""Operators on literals: rules, structure, tags, sinks, and a stream."""

import re

import pytest
import pyarrow as pa
from docloom.constants import BIO_TAGS
from docloom.functions import text as tx
from docloom.functions import vectors as vx
from docloom.operators import classify, evaluate, gold, structure
from docloom.operators import entities as ent
from docloom.sources import io
from docloom.streaming import ingest
from pyspark.sql import functions as F


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'array<double>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("text", "kind", "level"),
    [
        (None, "unknown", None), ("", "unknown", None), ("1.2 Scope ..... 12", "toc_entry", None), ("Chapter IV of it", "heading", 1), ("3.1.2 Dosing", "heading", 3),
        ("Appendix b", "appendix", None), ("- item", "list_item", None), ("Fig. 3 shows", "figure_caption", None), ("Table 2 lists", "table_caption", None), ("a ≤ b", "equation", None), ("Plain words", "paragraph", None),
    ],
)
def test_section_type(spark, text, kind, level):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(tx.section_type(F.col("t")).alias("k"), tx.heading_level(F.col("t"), tx.section_type(F.col("t"))).alias("l")).first()
    assert (r.k, r.l) == (kind, level)


def test_toc_page(spark):
    page = "Table of Contents\nScope .... 3\nMethods .... 9"
    lines = "\n".join(f"Part {i} .. {i}" for i in range(7))
    got = [one(spark, tx.is_toc_page(F.col("t")), t=t) for t in (page, lines, "short", "words only, and long enough to count")]
    assert got == [True, True, False, False]


def test_markdown(spark):
    kinds = [("T", "heading", 2, "## T"), ("T", "heading", 9, "###### T"), ("x", "list_item", 1, "- x"), ("e", "equation", 1, "$e$"), ("c", "caption", 1, "*c*"), ("f", "footnote", 1, "[^]: f"), ("p", "code", 1, "```\np\n```"), ("", "heading", 1, "")]
    for text, kind, level, want in kinds:
        assert one(spark, tx.markdown(F.col("t"), F.col("k"), F.col("l")), t=text, k=kind, l=level) == want
    table = spark.createDataFrame([([["a", "b|c"], ["1", None]],)], "r array<array<string>>").select(tx.markdown_table(F.col("r")).alias("x")).first().x
    assert table == "| a | b\\|c |\n| --- | --- |\n| 1 |  |"


def test_paths(spark):
    assert one(spark, tx.normalized_path(F.col("p")), p="dbfs:/Volumes/a+b%20c") == "/Volumes/a+b c"
    assert one(spark, tx.normalized_path(F.col("p")), p="dbfs:/x/y") == "/dbfs/x/y"
    assert one(spark, tx.normalized_path(F.col("p")), p=" ") is None
    assert one(spark, tx.document_id(F.col("p")), p="/a/NCT1/f.pdf") == "NCT1"
    assert one(spark, tx.document_id(F.col("p")), p="/a/uploads/f.x.pdf") == "f.x"
    assert one(spark, tx.protocol_id(F.col("p")), p="NCT1_v2_x") == "NCT1"
    assert one(spark, tx.section_id(F.col("p"), F.col("n")), p="d", n=7) == "d_s00007"
    assert one(spark, tx.label_type(F.col("p")), p="Formula") == "equation"
    assert one(spark, tx.is_scanned(F.col("c"), F.col("i")), c=[10.0, 20.0], i=[1.0, 0.0]) is True
    assert one(spark, tx.is_scanned(F.col("c"), F.col("i")), c=[500.0], i=[1.0]) is False


def chunks_of(text, most):
    parts = [s.strip() for s in re.split(r"(?<=[.!?])\s+(?=[A-Z])|(?<=[.!?])\s*\n+", text) if s.strip()]
    out, now, n = [], [], 0
    for s in parts:
        k = len(s.split())
        if now and n + k > most:
            out.append(" ".join(now))
            now, n = [], 0
        now.append(s)
        n += k
    return [*out, *([" ".join(now)] if now else [])] or [text]


@pytest.mark.parametrize("text", ["One two. Three four five! six? Seven.\nEight nine", "no ends at all " * 10, "A. B. C.", ""])
def test_chunks(spark, text):
    assert one(spark, tx.chunks(F.col("t"), 4), t=text) == chunks_of(text, 4)


def sections(spark, rows):
    return spark.createDataFrame([("d", *r) for r in rows], "document_id string, section_id string, page_number int, sequence_number int, section_type string, content_text string, heading_level int")


def test_hierarchy_modes(spark):
    long_ = "word " * 20
    rows = [("a", 1, 1, "heading", "A", 1), ("b", 1, 2, "heading", "B", 2), ("c", 1, 3, "heading", "C", 3), ("d", 1, 4, "heading", "D", 1), ("e", 1, 5, "paragraph", long_, None)]
    df = structure.ordered(sections(spark, rows))
    loose = {r.section_id: r.parent_section_id for r in structure.with_hierarchy(df).collect()}
    strict = {r.section_id: r.parent_section_id for r in structure.with_hierarchy(df, strict=True).collect()}
    assert loose == {"a": None, "b": "a", "c": "b", "d": None, "e": "c"}
    assert strict == {"a": None, "b": "a", "c": "b", "d": None, "e": "d"}
    path = structure.with_leaf(structure.with_path(structure.with_hierarchy(df)))
    got = {r.section_id: (r.hierarchy_path, r.is_leaf) for r in path.collect()}
    assert got["c"] == ("a > b > c", False) and got["e"] == ("a > b > c > e", True)


def test_noise_merge_and_chunk(spark):
    rows = [("h1", 1, 1, "paragraph", "Header", None), ("p1", 1, 2, "paragraph", "one", None), ("p2", 1, 3, "paragraph", "two", None), ("h2", 2, 1, "paragraph", "Header", None), ("l", 2, 2, "list_item", "x", None), ("n", 2, 3, "paragraph", None, None), ("p3", 3, 1, "paragraph", "One two. Three four. " * 60, None)]
    df = sections(spark, rows)
    noise = structure.repeated_noise(df)
    assert [r.content_text for r in noise.collect()] == ["Header"]
    pages = spark.createDataFrame([("d", " one ", None), ("d", "", "x")], "document_id string, header_text string, footer_text string")
    assert {r.content_text for r in structure.explicit_noise(pages).collect()} == {"one", "x"}
    clean = structure.ordered(structure.without_noise(df, noise)).withColumn("parent_section_id", F.lit(None).cast("string"))
    merged = {r.section_id: (r.merged_count, r.content_text) for r in structure.merged_paragraphs(clean).collect()}
    assert merged["p1"] == (2, "one two") and merged["l"] == (1, "x")
    parts = [r for r in structure.chunked(clean).collect() if r.section_id.startswith("p3")]
    assert [r.section_id for r in sorted(parts, key=lambda r: r.chunk_index)] == ["p3_c1", "p3_c2"]


def test_classification(spark):
    phrases = spark.createDataFrame([("A", [2.0, 0.0]), ("A", [1.0, 0.0]), ("B", [0.0, 3.0]), ("C", [0.0, 0.0])], "label string, vector array<double>")
    protos = classify.prototypes(phrases)
    rows = spark.createDataFrame([(1, [5.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "section_id int, vector array<double>")
    got = {r.section_id: r for r in classify.classified(classify.scored(rows, protos)).collect()}
    assert (got[1].classification, got[1].status) == ("A", "SUCCESS") and got[3].status == "UNMAPPED" and got[2].status == "UNMAPPED"
    assert one(spark, classify.status(F.lit(0.8), F.lit(0.79)), x=1) == "AMBIGUOUS"
    assert one(spark, classify.status(F.lit(float("nan")), F.lit(0.1)), x=1) == "UNMAPPED"
    assert one(spark, vx.normalized(F.col("v")), v=[3.0, 4.0]) == [0.6, 0.8]
    assert one(spark, F.size(vx.hashed_embedding(F.lit("a b"))), x=1) == 64
    best = classify.best_of_each(spark.createDataFrame([("d", "s1", "X", 0.9), ("d", "s2", "X", 0.9), ("d", "s3", "Y", 0.1)], "document_id string, section_id string, classification string, confidence double"), ["X"])
    assert {r.section_id: r.classification for r in best.collect()} == {"s1": "X", "s2": "OTHER_SECTION", "s3": "Y"}


def test_gold_rules(spark):
    assert one(spark, gold.priority(F.col("c"), F.col("d")), c="PRIMARY_ENDPOINT", d="X") == "HIGH"
    assert one(spark, gold.priority(F.col("c"), F.col("d")), c="X", d="REPRODUCTIVE") == "MEDIUM"
    assert one(spark, gold.expected_types(F.col("c")), c="LAB_DRUG") == ["BIOMARKER", "PATIENT_CRITERIA"]


def test_tags(spark):
    text = "Patients with metastatic breast cancer take Pembrolizumab 200mg IV"
    spans = [(14, 38, "CONDITION"), (44, 57, "DRUG"), (58, 66, "DOSAGE")]
    df = spark.createDataFrame([(text, spans)], "text string, spans array<struct<start:int,end:int,label:string>>")
    df = df.withColumn("words", ent.words_with_offsets(F.col("text"))).withColumn("labels", ent.encoded_labels(F.col("words"), F.col("spans")))
    r = df.first()
    assert r.labels == ["O", "O", "B-CONDITION", "I-CONDITION", "I-CONDITION", "O", "B-DRUG", "B-DOSAGE", "I-DOSAGE"]
    tokens = F.zip_with("words", "labels", lambda w, t: F.struct(t.alias("label"), w["start"].alias("start"), w["end"].alias("end"), F.lit(0.5).alias("confidence")))
    got = df.select(F.inline(ent.decoded_spans(tokens, F.col("text")))).collect()
    assert [(g.start_pos, g.end_pos, g.entity_type, g.text) for g in got] == [(a, b, k, text[a:b]) for a, b, k in spans]
    assert df.select(ent.highlighted(F.col("text"), F.col("spans")).alias("x")).first().x.endswith("[Pembrolizumab](DRUG) [200mg IV](DOSAGE)")
    adjacent = [("B-X", 0, 1, 0.4), ("B-X", 2, 3, 0.8), ("I-Y", 4, 5, 1.0), ("O", 6, 6, 0.0), ("I-Y", 6, 7, 0.5)]
    toks = spark.createDataFrame([("a b c d", adjacent)], "text string, t array<struct<label:string,start:int,end:int,confidence:double>>")
    strict = toks.select(F.inline(ent.decoded_spans(F.col("t"), F.col("text")))).collect()
    relaxed = toks.select(F.inline(ent.decoded_spans(F.col("t"), F.col("text"), relaxed=True))).collect()
    assert [(g.text, g.confidence) for g in strict] == [("a", 0.4), ("b", 0.8), ("c d", 0.75)]
    assert [g.text for g in relaxed] == ["a b", "c d"] and abs(relaxed[0].confidence - 0.6) < 1e-12


def test_evaluation(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    r = evaluate.weighted_scores(rows, "t", "p").first()
    assert (round(r.accuracy, 6), round(r.recall, 6), round(r.precision, 6)) == (0.5, 0.5, 0.375)
    weights = {r.label: r.weight for r in evaluate.class_weights(spark.createDataFrame([("O",)] * 99 + [("B-DRUG",)], "tag string"), BIO_TAGS).collect()}
    assert weights["O"] == 0.5 and weights["B-DRUG"] == 100 / 17 * 1.5 and weights["I-DRUG"] == 100 / 17


def test_records_and_upsert(spark, tmp_path):
    raw = spark.createDataFrame([("s", "", "txt", "4")], "id string, content_text string, text string, page string")
    r = io.normalized_records(raw).first()
    assert (r.section_id, r.content_text, r.page_number, r.section_type) == ("s", "txt", 4, "paragraph")
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, None, "a"), (2, 1, "b")], "id int, chunk int, v string")
    second = spark.createDataFrame([(1, None, "A"), (3, 1, "c")], "id int, chunk int, v string")
    io.merge_upsert(spark, path, first, ["id", "chunk"])
    for _ in range(2):  # twice is once
        io.merge_upsert(spark, path, second, ["id", "chunk"])
        assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "A"), (2, "b"), (3, "c")]
    io.merge_upsert(spark, path, second, ["id", "chunk"], delete_missing=True)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]


def test_extraction_falls_back(spark):
    files = spark.createDataFrame([("a", bytearray(b"ok")), ("b", bytearray(b"bad")), ("c", bytearray(b"worse"))], "path string, content binary")

    def strict(content):
        if content != b"ok":
            raise ValueError("unreadable")
        return {"text": content.decode()}

    def lax(content):
        if content == b"worse":
            raise ValueError("hopeless")
        return {"text": "raw " + content.decode("latin-1")}

    out = io.extract_files(files, [("strict", strict), ("lax", lax)], "path string, tools_used array<string>, error_message string, text string").collect()
    got = {r.path: (r.tools_used, r.text, bool(r.error_message)) for r in out}
    assert got == {"a": (["strict"], "ok", False), "b": (["strict", "lax"], "raw bad", False), "c": (["strict", "lax"], None, True)}


def test_stream_upserts(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for v in ("a", "b"):
        spark.createDataFrame([(1, v), (2, v)], "id int, v string").coalesce(1).write.mode("append").parquet(source)
        ingest.upsert_stream(spark, source, "id int, v string", target, str(tmp_path / "cp"), ["id"]).awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(target).collect()) == [(1, "b"), (2, "b")]


def test_python_values_are_made_a_bounded_slice_at_a_time():
    long_, short = pa.array(["x" * 100_000] * 20), pa.array(["x"] * 5_000)
    for column, most in ((long_, 3), (short, 256)):
        runs = list(ent.slices((column,)))
        assert max(many for _, many in runs) <= most and sum(many for _, many in runs) == len(column)
    assert list(ent.slices((pa.array([], pa.string()),))) == []


def test_registered_queries_bound_their_batches(spark):
    from docloom.plans import registry
    from docloom.session import BATCH

    for key in BATCH:
        spark.conf.unset(key)
    registry.QUERIES["bio_encode"](spark, "/root/testdata/sf0.001")
    assert {key: spark.conf.get(key) for key in BATCH} == BATCH


def test_scores_of_a_batch_are_held_a_bounded_part_at_a_time(monkeypatch):
    from types import SimpleNamespace

    import numpy as np

    held = []
    first = classify.first_largest
    monkeypatch.setattr(classify, "first_largest", lambda scores, k: held.append(scores.size) or first(scores, k))
    protos = np.random.default_rng(0).normal(size=(4096, 2))
    kind = pa.list_(pa.struct([("label", pa.int64()), ("score", pa.float64())]))
    rows = pa.RecordBatch.from_arrays([pa.array([[1.0, 0.5]] * 1000 + [None]), pa.array([[]] * 1001, kind)], names=["__unit", "__best"])
    out = list(classify._best_of(SimpleNamespace(value=(list(range(4096)), protos)), classify.BLOCK, 3, None)([rows]))
    assert max(held) <= 2**20 and sum(b.num_rows for b in out) == 1001
    assert [x["label"] for x in out[0].column(1)[0].as_py()] == list(np.argsort(-(protos @ [1.0, 0.5]), kind="stable")[:3])
