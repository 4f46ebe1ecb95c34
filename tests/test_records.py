"""Records of mixed shapes as seven child tables, on literals."""

import json

from docloom.sources import records

BODIES = [
    {"pages": [{"source_pdf": "dbfs:/Volumes/NCT1/a.pdf", "page": "3", "text": None, "has_header": "yes", "has_footer": "false"}, {"page_number": 0, "page": 9}, 7, None, "text", []],
     "sections": [{"id": 12, "seq": 2, "content": "c", "bbox": {"x0": "1.5", "y0": 2}, "bbox_x1": 3, "heading_level": " "}, {"section_id": "", "id": "z", "text": "", "content": "d", "bbox": "none", "heading_level": "4", "document_id": "own"}],
     "registry": {"doc_id": "D", "tools_used": "one", "page_count": "x"}},
    {"images": [{"id": "i", "path": "/p/q.png"}], "tables": [{"table_html": "<t>"}], "formulas": [{"latex": "x"}], "errors": [{"message": "m"}], "registry": {"tools_used": [1, "two"], "processing_status": "SUCCESS", "page_count": 2.0}},
    {"pages": {}, "registry": [1], "other": [{}]}, [], "text",
]


def table(spark):
    return spark.createDataFrame([(json.dumps(b),) for b in BODIES] + [(None,), ("",), ("{bad",)], "body string").repartition(3)


def test_fields_of_all_shapes(spark, tmp_path):
    path = str(tmp_path / "children")
    counts = records.write_children(table(spark), path)
    assert counts == {"pages": 2, "sections": 2, "images": 1, "tables": 1, "formulas": 1, "errors": 1, "registry": 2}
    got = {k: sorted(map(lambda r: r.asDict(), records.child(spark, path, k).collect()), key=str) for k in records.KINDS}
    assert {k: len(v) for k, v in got.items()} == counts
    first = next(r for r in got["pages"] if r["source_path"])
    assert (first["source_path"], first["document_id"], first["page_number"], first["text"], first["has_header"], first["has_footer"]) == ("/Volumes/NCT1/a.pdf", "NCT1", 3, "", True, False)
    a, b = sorted(got["sections"], key=lambda r: r["section_id"])
    assert (a["section_id"], a["sequence_number"], a["content_text"], a["heading_level"]) == ("12", 2, "c", None)
    assert [a[f"bbox_{c}"] for c in ("x0", "y0", "x1", "y1")] == [1.5, 2.0, 3.0, None]
    assert (b["section_id"], b["content_text"], b["heading_level"], b["document_id"], b["bbox_x0"]) == ("z", "d", 4, "own", None)
    one, two = sorted(got["registry"], key=lambda r: r["processing_status"])
    assert two["processing_status"] == "failed" and two["tools_used"] == ["one"] and two["page_count"] == 0 and two["document_id"] == "D"
    assert one["tools_used"] == ["1", "two"] and one["page_count"] == 2
    assert got["images"][0]["image_path"] == "/p/q.png" and got["tables"][0]["html"] == "<t>" and got["formulas"][0]["content"] == "x" and got["errors"][0]["error_message"] == "m"


def test_the_source_is_read_once(spark, tmp_path):
    table(spark).write.parquet(str(tmp_path / "results"))
    seen = spark.sparkContext.accumulator(0)
    source = spark.read.parquet(str(tmp_path / "results"))

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counts = records.write_children(source.mapInArrow(count, source.schema), str(tmp_path / "children"))
    assert seen.value == source.count() and sum(counts.values()) == 10
    plan = records.child(spark, str(tmp_path / "children"), "tables")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bbox" not in plan.split("ReadSchema")[1]


def test_nothing_in_nothing_out(spark, tmp_path):
    counts = records.write_children(table(spark).limit(0), str(tmp_path / "none"))
    assert set(counts.values()) == {0}


def test_a_record_is_read_in_one_pass(spark):
    plan = records.tagged(table(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get(record") <= 2  # tools_used alone, as a list and as a text
