"""Sections of markup, outlines of any depth and chunks of markdown, on literals."""

import pytest
from docloom.functions import text as tx
from docloom.operators import structure
from docloom.sources import markup
from pyspark.sql import functions as F


def labels(html):
    return [(label, level, text) for label, level, _, _, text in markup.sections_in(html)]


def test_labels_levels_and_entities():
    html = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
    <body><nav>top <a href="x">menu</a></nav><h1>One&nbsp;x</h1><h4>Deep <i>er</i></h4><p>First <b>bold</b><br> line
    two &#169; &lt;tag&gt;</p><pre> a
  b </pre><figcaption>fig</figcaption><aside>note</aside><footer>end</footer></body></html>"""
    assert labels(html) == [
        ("title", None, "A & B"), ("page_header", None, "top menu"), ("section_header", 1, "One\xa0x"), ("section_header", 4, "Deep er"),
        ("text", None, "First bold\nline two © <tag>"), ("code", None, "a\n  b"), ("figure_caption", None, "fig"), ("footnote", None, "note"), ("page_footer", None, "end"),
    ]


def test_only_whole_references_are_decoded():
    assert labels("<title>a&amp;b &amp</title><p>&lt;&#65;&#x42; &ampx; &unknown; &am &lt x&copy") == [("title", None, "a&b &amp"), ("text", None, "<AB &ampx; &unknown; &am &lt x&copy")]
    assert labels('<img alt="a&amp;b &amp c&lt"><p>x\0y &\0amp;') == [("picture", None, "a&b &amp c&lt"), ("text", None, "xy &amp;")]


def test_missing_and_stray_end_tags():
    assert labels("<head><title>t</title><p>in body") == [("title", None, "t"), ("text", None, "in body")]
    assert labels("<p>a<p>b</div></p>c<h2>d<h3>e</h3>f") == [("text", None, "a"), ("text", None, "b"), ("text", None, "c"), ("section_header", 2, "d"), ("section_header", 3, "e"), ("text", None, "f")]
    assert labels("<ul><li>a<ol><li>b<li>c</ol>d<li>e</ul>f") == [*(("list_item", None, x) for x in "abcde"), ("text", None, "f")]
    assert labels("<table><caption>c</caption><tr><td>1<td>2<tr><th>3</table>") == [("table_caption", None, "c"), *(("table", None, x) for x in "123")]
    assert labels("a <b>b<p>c</b>d") == [("text", None, "a b"), ("text", None, "cd")]
    assert labels('<input type="checkbox" checked value="yes"><img alt=" a  b "><img>') == [("checkbox_selected", None, "yes"), ("picture", None, "a b")]
    assert labels("x < y <unended") == [("text", None, "x < y <unended")]
    assert labels("<script>1<2</script><template><p>no</p></template> \n ") == [] == labels("") == labels(None)


def test_nesting_and_size_have_no_bound():
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert labels(deep) == [("text", None, "x")]
    assert markup.sections_in(deep)[0][2] == 3000
    assert len(labels("<p>word</p>" * 20_000)) == 20_000
    assert labels("<b>" * 50_000 + "x")[0][2] == "x"


def test_page_table(spark):
    pages = spark.createDataFrame([("a", "<h2>T</h2><p>x<ol><li>y</ol>", 1), ("b", None, 2), ("c", "", 3), (None, "<p>z", 4)], "page string, html string, label int")
    got = {(r.document_id, r.section_id, r.section_type, r.heading_level, r.enumerated) for r in markup.page_sections(pages, "page", "html").collect()}
    assert got == {("a", "a_s00001", "heading", 2, False), ("a", "a_s00002", "paragraph", None, False), ("a", "a_s00003", "list_item", None, True), (None, "null_s00001", "paragraph", None, False)}
    assert markup.page_sections(pages.limit(0), "page", "html").count() == 0


def outline(spark, rows, strict=False):
    made = [("d", f"s{i}", 1, i, "heading" if level else "table", "x", level) for i, level in enumerate(rows)]
    df = spark.createDataFrame(made, "document_id string, section_id string, page_number int, sequence_number int, section_type string, content_text string, heading_level int")
    return structure.with_hierarchy(structure.ordered(df), strict=strict)


@pytest.mark.parametrize("strict", [False, True])
def test_outline_of_twelve_levels(spark, strict):
    got = {r.section_id: r for r in outline(spark, [*range(1, 13), None, 3, None, 1, None], strict).collect()}
    assert got["s11"].hierarchy_path == " > ".join(f"s{i}" for i in range(12)) and got["s11"].parent_section_id == "s10"
    assert got["s12"].parent_section_id == "s11" and got["s13"].parent_section_id == "s1"
    assert got["s14"].parent_section_id == ("s13" if strict else "s11")
    assert got["s15"].parent_section_id is None and got["s15"].hierarchy_path == "s15"
    assert got["s16"].hierarchy_path.startswith("s15 > " if strict else "s0 > ")


def test_outline_is_one_shuffle(spark):
    plan = outline(spark, [1, 2, None])._jdf.queryExecution().executedPlan().toString()
    hierarchy = plan[: plan.index("Window")]
    assert hierarchy.count("Exchange") <= 1 and "Join" not in plan


def test_paths_from_given_parents(spark):
    rows = [("d", f"s{i}", i, None if i == 0 else f"s{i - 1}") for i in range(12)] + [("e", "s1", 1, "gone"), ("e", "s2", 2, "s1"), (None, "n", 1, None)]
    df = spark.createDataFrame(rows, "document_id string, section_id string, doc_order int, parent_section_id string")
    got = {(r.document_id, r.section_id): r.hierarchy_path for r in structure.with_path(df).collect()}
    assert got["d", "s11"] == " > ".join(f"s{i}" for i in range(12)) and got["e", "s2"] == "gone > s1 > s2" and got[None, "n"] == "n"


def test_chunks_side_by_side(spark):
    text = "One two three. Four five six. Seven eight nine. Ten."
    rows = [("p", "paragraph", text, "One. Two.", 1, 1), ("q", "paragraph", "Short one.", None, 1, 2), ("r", "table", text, text, 1, 3), ("n", None, None, None, 1, 4)]
    df = spark.createDataFrame(rows, "section_id string, section_type string, content_text string, content_markdown string, page_number int, sequence_number int").withColumn("document_id", F.lit("d"))
    got = structure.section_order(structure.chunked(df, over=4, most=6)).orderBy("section_order").collect()
    assert [(r.section_id, r.content_text, r.content_markdown, r.chunk_index) for r in got] == [
        ("p_c1", "One two three. Four five six.", "One. Two.", 1), ("p_c2", "Seven eight nine. Ten.", "", 2), ("q", "Short one.", None, None), ("r", text, text, None), ("n", None, None, None),
    ]


def test_chunks_keep_every_sentence():
    parts = [f"{'w ' * (i % 9)}End{i}." for i in range(200)]
    made = tx.chunks_of(" X".join(parts), 12)
    assert " ".join(made) == " X".join(parts) and all(len(c.split()) <= 12 or c.count(".") == 1 for c in made)
