"""Registered queries of sources, sinks, extraction rows, training data and set operations."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.constants import BIO_TAGS, LABEL_TYPES
from docloom.functions import embedding
from docloom.functions import text as tx
from docloom.operators import entities as ent
from docloom.operators import evaluate, extraction, structure, tagging
from docloom.plans.registry import _GOLD, _SEC, _STRIP, _gold, _words, query
from docloom.sources import corpus, files, io, records, upsert
from docloom.sources.tables import line_sections, load

# --- sources ---


@query("src_extract", "select 'd' || doc_id path, 'pdf_text,text_pages' tools_used, case when text is not null then 1 end page_count, length(text) characters, text is null failed from documents")
def src_extract(spark: SparkSession, base: str) -> DataFrame:
    files = load(spark, base, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("path"), F.col("text").cast("binary").alias("content"))
    out = io.extract_files(files, io.EXTRACTORS, io.EXTRACTED)
    return out.select("path", F.array_join("tools_used", ",").alias("tools_used"), "page_count", "characters", F.col("error_message").isNotNull().alias("failed"))


@query("src_files", r"""select doc_id, 'pdf_text,text_pages' tools_used, 1 page_count, length(coalesce(text, '')) characters, octet_length(encode(coalesce(text, ''))) length, 'SUCCESS' processing_status from documents where text <> ''""")
def src_files(spark: SparkSession, base: str) -> DataFrame:
    """Documents written as files of their own, scanned, and read by a chain of readers in processes with a deadline; their registry."""
    folder = io.shared_folder(spark)
    texts = load(spark, base, "documents").filter("text <> ''").select(F.format_string("d%d.txt", "doc_id").alias("name"), "text")
    files.write_files(texts, folder).write.format("noop").mode("overwrite").save()
    number = F.regexp_extract("path", r"d(\d+)\.txt$", 1).cast("long").alias("doc_id")
    small, _ = files.scan(spark, folder, "*.txt")
    found = files.read_folder(spark, folder, io.EXTRACTORS, pattern="*.txt").select(number, "tools_used", "page_count", "characters", "error_message")
    path = io.shared_folder(spark)  # files are read once; what follows reads the result
    found.write.parquet(path)
    read = spark.read.parquet(path)
    pages = read.select(F.col("doc_id").alias("document_id"), F.when(F.col("error_message").isNull(), 1).alias("page_number"), F.element_at("tools_used", -1).alias("tool"), "error_message")
    registry = extraction.registry(pages).select(F.col("document_id").alias("doc_id"), "processing_status")
    sizes = small.select(number, F.col("length"))
    return read.join(registry, "doc_id").join(sizes, "doc_id").select("doc_id", F.array_join("tools_used", ",").alias("tools_used"), "page_count", "characters", "length", "processing_status")


@query("src_scanned", "select l_orderkey, sum(l_linenumber) < 100 * least(count(*), 3) and max(l_quantity) > 40 is_scanned from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) i from lineitem) where i <= 3 group by 1")
def src_scanned(spark: SparkSession, base: str) -> DataFrame:
    pages = load(spark, base, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))).alias("p"))
    chars = F.transform("p", lambda x: x["l_linenumber"].cast("double"))
    images = F.transform("p", lambda x: F.when(x["l_quantity"] > 40, 1.0).otherwise(0.0))
    return pages.select("l_orderkey", tx.is_scanned(chars, images).alias("is_scanned"))


@query("src_records", "select event_id::varchar section_id, user_id::varchar document_id, 0 page_number, 0 sequence_number, event_type section_type, coalesce(nullif(props, ''), '') content_text, 'none' engine from events")
def src_records(spark: SparkSession, base: str) -> DataFrame:
    raw = load(spark, base, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("doc_id"), F.col("event_type").alias("type"), F.col("props").alias("text"))
    return io.ensure_columns(io.normalized_records(raw), {"engine": F.lit("none"), "section_type": F.lit("unused")}).drop("heading_level")


@query("src_children", "select conv_id, turn, role, length(text) chars from conversations")
def src_children(spark: SparkSession, base: str) -> DataFrame:
    nested = load(spark, base, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", F.length("text").alias("chars"))).alias("turns"))
    return io.children(nested, "turns", ["conv_id"])


_O = "o_orderkey"
_SEVEN = f"""r as (select o_custkey c, {_O} k, o_custkey::varchar document_id, ({_O} % 50)::int page, * from orders)
 select 'pages' kind, document_id, '' id, page page_number, o_orderpriority || '|' || (k % 2 = 0) detail from r union all
 select 'sections', document_id, case when k % 2 = 0 then 's' || k else k::varchar end, page, case when k % 2 = 0 then 'heading|2|3|' || o_orderpriority else 'paragraph|0|4|' || o_orderstatus end || '|' || (k * 25) || '|' || case when k % 2 = 0 then 150 else -1 end from r union all
 select 'images', document_id, 'i' || k, page, 'png' from r where k % 3 = 0 union all select 'tables', document_id, 't' || k, page, '<t>' from r where k % 3 = 1 union all select 'formulas', document_id, 'f' || k, 0, 'x^2' from r where k % 3 = 2 union all
 select 'errors', document_id, '', 0, 'bronze|late' from r where o_orderstatus = 'P' union all
 select 'registry', c_custkey::varchar, '', 0, case when c_custkey % 2 = 0 then 'SUCCESS|7|one,two' else 'failed|7|one' end from customer"""


def _results(spark: SparkSession, base: str) -> DataFrame:
    """A JSON document for each customer, whose records have all the shapes: other names, texts as numbers, boxes nested and flat."""
    orders = load(spark, base, "orders")
    k = F.col(_O)
    path, even, page = F.format_string("dbfs:/Volumes/%d/f.pdf", "o_custkey"), k % 2 == 0, (k % 50).cast("int")
    either = lambda a, b, x: [F.when(even, x).alias(a), F.when(~even, x).alias(b)]
    where = either("source_path", "source_pdf", path)
    box = F.when(even, F.struct((k / 4).alias("x0"), F.lit("1.5").alias("y0"))).alias("bbox")
    records_of = {
        "pages": (F.lit(True), [*where, *either("page", "page_number", page), F.col("o_orderpriority").alias("text"), F.when(even, True).alias("has_header")]),
        "sections": (F.lit(True), [
            *where, F.when(even, F.concat(F.lit("s"), k)).alias("section_id"), F.when(~even, k).alias("id"), *either("page_number", "page", page.cast("string")), F.when(even, 3).alias("seq"), F.when(~even, "4").alias("sequence_number"),
            *either("type", "section_type", F.when(even, "heading").otherwise("paragraph")), *either("text", "content", F.when(even, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus"))), F.when(even, "2").otherwise("").alias("heading_level"), box, F.when(~even, k / 4).alias("bbox_x0"),
        ]),
        "images": (k % 3 == 0, [path.alias("source_path"), F.concat(F.lit("i"), k).alias("image_id"), page.alias("page_number"), *either("format", "image_format", F.lit("png"))]),
        "tables": (k % 3 == 1, [path.alias("source_path"), F.concat(F.lit("t"), k).alias("id"), page.alias("page_number"), *either("html", "table_html", F.lit("<t>"))]),
        "formulas": (k % 3 == 2, [path.alias("source_path"), F.concat(F.lit("f"), k).alias("id"), *either("latex", "content", F.lit("x^2")), F.lit("none").alias("page_number")]),
        "errors": (F.col("o_orderstatus") == "P", [path.alias("source_path"), *either("stage", "error_stage", F.lit("bronze")), *either("message", "error_message", F.lit("late"))]),
    }
    lists = orders.groupBy("o_custkey").agg(*[F.collect_list(F.when(rule, F.struct(*fields))).alias(kind) for kind, (rule, fields) in records_of.items()])
    c = F.col("c_custkey")
    registry = F.struct(F.format_string("/Volumes/%d/f.pdf", c).alias("source_path"), F.when(c % 2 == 0, "SUCCESS").alias("processing_status"), F.lit("7").alias("page_count"))
    all_ = load(spark, base, "customer").select("c_custkey").join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    body = F.to_json(F.struct(*records_of, registry.alias("registry")))
    tools = F.when(c % 2 == 0, '"tools_used":["one","two"],').otherwise('"tools_used":"one",')
    return all_.select(F.replace(body, F.lit('"registry":{'), F.concat(F.lit('"registry":{'), tools)).alias("body"))


@query("src_children_seven", f"with {_SEVEN}")
def src_children_seven(spark: SparkSession, base: str) -> DataFrame:
    """Seven child tables written from one pass over extraction results, and read back."""
    path = io.shared_folder(spark)
    records.write_children(_results(spark, base), path)
    text = lambda *cs: F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in cs])
    box = lambda c: F.coalesce((F.col(c) * 100).cast("long"), F.lit(-1)).cast("string")
    details = {
        "pages": (F.lit(""), text("text", "has_header")), "sections": (F.col("section_id"), text("section_type", F.coalesce("heading_level", F.lit(0)).cast("string"), "sequence_number", "content_text", box("bbox_x0"), box("bbox_y0"))),
        "images": (F.col("image_id"), F.col("image_format")), "tables": (F.col("table_id"), F.col("html")), "formulas": (F.col("formula_id"), F.col("content")), "errors": (F.lit(""), text("error_stage", "error_message")),
        "registry": (F.lit(""), text("processing_status", "page_count", F.array_join("tools_used", ","))),
    }
    parts = []
    for kind, (name, detail) in details.items():
        rows = records.child(spark, path, kind)
        page = F.col("page_number") if "page_number" in rows.columns else F.lit(0)
        parts.append(rows.select(F.lit(kind).alias("kind"), "document_id", name.alias("id"), page.alias("page_number"), detail.alias("detail")))
    return structure.stacked(parts)


@query("src_json", "select event_id, cast(json_extract_string(props, '$.k') as integer) k from events")
def src_json(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("src_api_json", "select p_partkey, p_name text, p_type label, 0 start, length(p_name) \"end\", 0.5::double score from part")
def src_api_json(spark: SparkSession, base: str) -> DataFrame:
    one = F.struct(F.col("p_name").alias("text"), F.col("p_type").alias("label"), F.lit(0).alias("start"), F.length("p_name").alias("end"), F.lit(0.5).alias("score"))
    return corpus.api_entities(load(spark, base, "part").select("p_partkey", F.to_json(F.struct(F.array(one).alias("entities"))).alias("body")))


#: Bytes of texts that a file of tasks takes, about.
_FILE_BYTES = 8_000_000


@query("src_corpus", r"select upper(role) entity_type, count(*) n from conversations where regexp_matches(text, '\S') group by 1")
def src_corpus(spark: SparkSession, base: str) -> DataFrame:
    """First words of turns as annotations, written as files of tasks, read back as a labelling tool's export."""
    rows = load(spark, base, "conversations").filter(F.col("text").rlike(r"\S"))
    begin = F.length(F.regexp_extract("text", r"^(\s*)", 1))
    value = F.struct(begin.alias("start"), (begin + F.length(F.regexp_extract("text", r"(\S+)", 1))).alias("end"), F.array(F.upper("role")).alias("labels"))
    result = F.array(F.struct(F.lit("labels").alias("type"), value.alias("value")))
    task = F.to_json(F.struct((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.struct("text").alias("data"), F.array(F.struct(result.alias("result"))).alias("annotations")))
    size = rows.agg(F.sum(F.octet_length("text") + 200)).first()[0] or 0
    by_file = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(max(1, -(-size // _FILE_BYTES)))).alias("file")
    made = rows.groupBy(by_file).agg(F.concat(F.lit("["), F.array_join(F.collect_list(task), ","), F.lit("]")).alias("text"))
    folder = io.shared_folder(spark)
    files.write_files(made.select(F.format_string("tasks-%d.json", "file").alias("name"), "text"), folder).agg(F.sum("n_bytes")).collect()
    return corpus.label_counts(corpus.training_rows(corpus.annotated_texts(spark, folder)))


# --- sinks ---


@query("sink_files", "select 'c' || c_custkey || '.txt' name, octet_length(encode(c_name || chr(10) || c_mktsegment)) n_bytes from customer")
def sink_files(spark: SparkSession, base: str) -> DataFrame:
    rows = load(spark, base, "customer").select(F.format_string("c%d.txt", "c_custkey").alias("name"), F.concat_ws("\n", "c_name", "c_mktsegment").alias("text"))
    out = files.write_files(rows, io.shared_folder(spark))
    return out.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "n_bytes")


@query("sink_partitioned", "select p_brand, count(*) n, max(p_partkey) last from part group by 1")
def sink_partitioned(spark: SparkSession, base: str) -> DataFrame:
    """A table that replaces one of another schema; an empty one is skipped."""
    path, part = io.shared_folder(spark), load(spark, base, "part")
    io.overwrite(part.select("p_size"), path)
    io.overwrite(part.select("p_brand", "p_partkey"), path, ["p_brand"])
    io.overwrite(structure.empty_like(part), path, skip_empty=True)
    return spark.read.parquet(path).groupBy(F.col("p_brand").cast("string").alias("p_brand")).agg(F.count("*").alias("n"), F.max("p_partkey").alias("last"))


@query("merge_partitions", """select p_partkey, case when p_size > 45 then p_name || '!' else p_name end p_name, case when p_size > 45 and p_partkey % 2 = 0 then 'Moved' else p_brand end p_brand, p_size from part
 union all select -p_partkey, p_name || '!', p_brand, p_size from part where p_size > 45 and p_partkey % 2 = 1""")
def merge_partitions(spark: SparkSession, base: str) -> DataFrame:
    """Large parts change, every other one moves to another partition, and new ones come in."""
    part = load(spark, base, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    path = io.shared_folder(spark)
    part.write.partitionBy("p_brand").parquet(path)
    moves = F.col("p_partkey") % 2 == 0
    large = part.filter("p_size > 45").withColumns({"p_name": F.concat("p_name", F.lit("!")), "p_brand": F.when(moves, "Moved").otherwise(F.col("p_brand"))})
    new = large.filter(~moves).withColumn("p_partkey", -F.col("p_partkey"))
    upsert.upsert_partitions(spark, path, large.union(new), ["p_partkey"], ["p_brand"])
    return spark.read.schema(part.schema).parquet(path)


@query("sink_dynamic", """select p_brand, count(*) n, sum(case when p_size > 25 then 0 else p_size end)::bigint sizes from part where p_size <= 25 or p_brand not in (select p_brand from part where p_size = 1) group by 1""")
def sink_dynamic(spark: SparkSession, base: str) -> DataFrame:
    """Brands with a part of size one are replaced by their small parts; in the others the sizes of large ones become nought."""
    path, part = io.shared_folder(spark), load(spark, base, "part").select("p_partkey", "p_size", "p_brand")
    io.overwrite(part.withColumn("p_size", F.when(F.col("p_size") > 25, 0).otherwise(F.col("p_size"))), path, ["p_brand"], most_rows=500)
    brands = part.filter("p_size = 1").select("p_brand").distinct()
    io.overwrite(part.filter("p_size <= 25").join(brands, "p_brand", "left_semi"), path, ["p_brand"], dynamic=True, most_rows=500)
    return spark.read.schema(part.schema).parquet(path).groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("sizes"))


@query("sink_tables", "select s_nationkey, count(*) n from supplier group by 1")
def sink_tables(spark: SparkSession, base: str) -> DataFrame:
    """A table made if it is not there, filled, read and dropped; what is read of it stays in the shared folder."""
    name, path = f"docloom_{uuid.uuid4().hex}", io.shared_folder(spark)
    for _ in range(2):
        io.create_table(spark, name, "s_suppkey bigint, s_nationkey int", ["s_nationkey"])
    try:
        load(spark, base, "supplier").select("s_suppkey", "s_nationkey").write.insertInto(name)
        spark.table(name).groupBy("s_nationkey").agg(F.count("*").alias("n")).write.parquet(path)
    finally:
        io.drop_table(spark, name)
    return spark.read.parquet(path)


# --- extraction rows and sections ---


@query("ext_sections_ocr", f"select doc_id document_id, 1 page_number, 1 sequence_number, 'ocr_text' section_type, md5(text) text_md5 from documents where {_STRIP.format('text')} <> ''")
def ext_sections_ocr(spark: SparkSession, base: str) -> DataFrame:
    pages = load(spark, base, "documents").select(F.col("doc_id").alias("document_id"), F.lit(1).alias("page_number"), "text")
    return extraction.page_sections(pages).select("document_id", "page_number", "sequence_number", "section_type", F.md5(F.col("content_text").cast("binary")).alias("text_md5"))


@query("ext_errors", "select doc_id document_id, 'bronze' error_stage, md5(left(text, 1000)) message_md5, 'at ' || doc_id traceback from documents where text is not null")
def ext_errors(spark: SparkSession, base: str) -> DataFrame:
    failed = load(spark, base, "documents").filter("text is not null").select(F.col("doc_id").alias("document_id"), F.col("text").alias("error_message"), F.concat(F.lit("at "), F.col("doc_id").cast("string")).alias("traceback"))
    return extraction.errors(failed, "bronze").select("document_id", "error_stage", F.md5(F.col("error_message").cast("binary")).alias("message_md5"), "traceback")


@query("ext_document_summary", """with p as (select *, l_returnflag = 'R' toc, case when l_tax > 0.06 then 'e' end err from lineitem),
 t as (select l_orderkey, l_linestatus tool, count(*) n from p group by 1, 2), e as (select l_orderkey, min_by(tool, (100000 - n)::varchar || tool) engine from t group by 1)
 select l_orderkey document_id, count(distinct l_linenumber) page_count, coalesce(string_agg(distinct l_linenumber::varchar, ',' order by l_linenumber::varchar) filter (toc), '') toc_pages,
 coalesce(string_agg(distinct l_linenumber::varchar, ',' order by l_linenumber::varchar) filter (err is not null), '') error_pages, epoch(max(l_shipdate) - min(l_shipdate)) + 60 duration_seconds, engine
 from p join e using (l_orderkey) group by l_orderkey, engine""")
def ext_document_summary(spark: SparkSession, base: str) -> DataFrame:
    at = F.col("l_shipdate")
    pages = load(spark, base, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("page_number"), (F.col("l_returnflag") == "R").alias("is_toc"), F.when(F.col("l_tax") > 0.06, "e").alias("error_message"), F.col("l_linestatus").alias("tool"), at.alias("started"), (at + F.expr("interval 60 seconds")).alias("ended"))
    return extraction.document_summary(pages).select("document_id", "page_count", *[F.array_join(F.array_sort(F.col(c).cast("array<string>")), ",").alias(c) for c in ("toc_pages", "error_pages")], "duration_seconds", "engine")


@query("sec_is_heading", f"with {_SEC} select section_type, count(*) n, sum(case when section_type = 'heading' or heading_level is not null or (section_type in ('list_item', 'paragraph') and {_words('content_text')} < 15) then 1 else 0 end)::bigint headings from sec group by 1")
def sec_is_heading(spark: SparkSession, base: str) -> DataFrame:
    rows = structure.with_hierarchy(structure.ordered(line_sections(spark, base)))
    return rows.groupBy("section_type").agg(F.count("*").alias("n"), F.count_if("is_heading").alias("headings"))


@query("sec_explicit_noise", f"""with {_SEC}, pages as (select document_id, page_number, min_by(content_text, sequence_number) header_text, max_by(content_text, sequence_number) footer_text from sec group by 1, 2),
 noise as (select document_id, trim(header_text) t from pages where trim(header_text) <> '' union select document_id, trim(footer_text) from pages where trim(footer_text) <> '')
 select document_id, count(*) kept from sec s where not exists (select 1 from noise n where n.document_id = s.document_id and n.t = s.content_text) group by 1""")
def sec_explicit_noise(spark: SparkSession, base: str) -> DataFrame:
    rows = line_sections(spark, base)
    pages = rows.groupBy("document_id", "page_number").agg(F.min_by("content_text", "sequence_number").alias("header_text"), F.max_by("content_text", "sequence_number").alias("footer_text"))
    return structure.without_noise(rows, structure.explicit_noise(pages)).groupBy("document_id").agg(F.count("*").alias("kept"))


_LABELS = [*LABEL_TYPES, "Unknown", "TITLE", "Table"]


@query("sec_label_map", "with l as (select p_partkey, ([" + ", ".join(f"'{x}'" for x in _LABELS) + f"])[p_partkey % {len(_LABELS)} + 1] label from part) select p_partkey, case lower(label) " + " ".join(f"when '{a}' then '{b}'" for a, b in LABEL_TYPES.items()) + " else 'paragraph' end kind from l")
def sec_label_map(spark: SparkSession, base: str) -> DataFrame:
    label = F.get(F.array(*map(F.lit, _LABELS)), (F.col("p_partkey") % len(_LABELS)).cast("int"))
    return load(spark, base, "part").select("p_partkey", tx.label_type(label).alias("kind"))


@query("sec_strikethrough", "select p_partkey, p_size > 25 struck from part")
def sec_strikethrough(spark: SparkSession, base: str) -> DataFrame:
    marked = F.when(F.col("p_size") > 25, F.concat("p_name", F.lit("̶"))).otherwise(F.col("p_name"))
    return load(spark, base, "part").select("p_partkey", tx.struck_through(marked).alias("struck"))


@query("txt_md_table", """with r as (select n_regionkey, string_agg('| ' || replace(n_name || '|x', '|', '\\|') || ' | ' || n_nationkey || ' |', chr(10) order by n_nationkey) body from nation group by 1)
 select n_regionkey, '| name | key |' || chr(10) || '| --- | --- |' || chr(10) || body markdown from r""")
def txt_md_table(spark: SparkSession, base: str) -> DataFrame:
    cells = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.array(F.concat(x["n_name"], F.lit("|x")), x["n_nationkey"].cast("string")))
    rows = load(spark, base, "nation").groupBy("n_regionkey").agg(cells.alias("cells"))
    return rows.select("n_regionkey", tx.markdown_table(F.concat(F.array(F.array(F.lit("name"), F.lit("key"))), "cells")).alias("markdown"))


# --- set operations ---


@query("set_union_by_name", f"with {_SEC} select count(*) n, count(distinct section_id) sections, count(chunk) chunks from (select section_id, null chunk from sec union all select section_id, 1 from sec where section_type = 'heading')")
def set_union_by_name(spark: SparkSession, base: str) -> DataFrame:
    rows = line_sections(spark, base)
    headings = rows.filter(F.col("section_type") == "heading").withColumn("chunk", F.lit(1))
    every = structure.stacked([structure.empty_like(rows), rows, headings])
    return every.agg(F.count("*").alias("n"), F.count_distinct("section_id").alias("sections"), F.count("chunk").alias("chunks"))


@query("sec_unique", "select text, min(doc_id) doc_id, min(source) filter (doc_id = least) source from (select *, min(doc_id) over (partition by text) least from documents) group by text")
def sec_unique(spark: SparkSession, base: str) -> DataFrame:
    return structure.unique_by(load(spark, base, "documents").select("text", "doc_id", "source"), "text")


@query("sec_repeated", "select md5(text) text_md5, count(*) n from documents group by 1 having count(*) > 1")
def sec_repeated(spark: SparkSession, base: str) -> DataFrame:
    rows = load(spark, base, "documents").select(F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return structure.repeated_keys(rows, "text_md5")


@query("date_range", "select event_type, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') first, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') last from events group by 1")
def date_range(spark: SparkSession, base: str) -> DataFrame:
    """First and last moments as ISO texts, which sort as the moments do."""
    rows = load(spark, base, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))
    return rows.groupBy("event_type").agg(F.min("at").alias("first"), F.max("at").alias("last"))


# --- embeddings, training data, scores ---


def _word_model(pooled=embedding.mean_pooled):
    """A stand-in for a model: each word is a vector of its length and 1, and a text the mean of its words, or another pooling of them."""

    def run(texts: list[str]) -> np.ndarray:
        lengths = [[len(w) for w in t.split()] for t in texts]
        most = max(map(len, lengths))
        tokens, mask = np.zeros((len(texts), most, 2)), np.zeros((len(texts), most))
        for i, x in enumerate(lengths):
            tokens[i, : len(x), 0], tokens[i, : len(x), 1], mask[i, : len(x)] = x, 1, 1
        return pooled(tokens, mask)

    return run


@query("emb_model", r"""with w as (select conv_id, turn, regexp_extract_all(coalesce(text, ''), '\S+') a from conversations), m as (select conv_id, turn, len(a) n, length(array_to_string(a, '')) / len(a) x from w)
 select conv_id, turn, case when n = 0 then 0 else round(x / sqrt(x * x + 1), 3) end first, n = 0 is_zero from m""")
def emb_model(spark: SparkSession, base: str) -> DataFrame:
    vector = embedding.model_embedder(_word_model, 2)(F.col("text"))
    rows = load(spark, base, "conversations").select("conv_id", "turn", vector.alias("v"))
    return rows.select("conv_id", "turn", F.round(F.get("v", 0).cast("double"), 3).alias("first"), (F.get("v", 1) == 0).alias("is_zero"))


@query("emb_cls", r"""with w as (select conv_id, turn, length(regexp_extract(coalesce(text, ''), '\S+')) n from conversations)
 select conv_id, turn, case when n = 0 then 0 else round(n / sqrt(n * n + 1), 3) end first, n = 0 is_zero from w""")
def emb_cls(spark: SparkSession, base: str) -> DataFrame:
    vector = embedding.model_embedder(lambda: _word_model(embedding.first_pooled), 2)(F.col("text"))
    rows = load(spark, base, "conversations").select("conv_id", "turn", vector.alias("v"))
    return rows.select("conv_id", "turn", F.round(F.get("v", 0).cast("double"), 3).alias("first"), (F.get("v", 1) == 0).alias("is_zero"))


@query("ner_split_exact", """with k as (select distinct doc_id, substr(md5('42:' || doc_id), 1, 15) code from labels), r as (select doc_id, row_number() over (order by code, doc_id) <= (select count(*) * 80 // 100 from k) training from k)
 select doc_id, training from labels join r using (doc_id)""")
def ner_split_exact(spark: SparkSession, base: str) -> DataFrame:
    return evaluate.split_exactly(load(spark, base, "labels"), "doc_id").select("doc_id", "training")


@query("ner_split", "select substr(md5('42:' || doc_id), 1, 4) < 'cccc' training, count(*) n from labels group by 1")
def ner_split(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "labels").groupBy(evaluate.in_training("doc_id").alias("training")).agg(F.count("*").alias("n"))


@query("ner_label_maps", "select label, (row_number() over (order by label) - 1)::int id from (select distinct p_type label from part)")
def ner_label_maps(spark: SparkSession, base: str) -> DataFrame:
    """Numbers of the labels that a table holds, in their order."""
    return evaluate.numbered_labels(load(spark, base, "part"), "p_type")


@query("ner_aligned", r"""with w as (select conv_id, turn, regexp_extract_all(text, '\S+') a from conversations),
 p as (select conv_id, turn, list_transform(a, lambda x: ((length(x) + 3) // 4)::bigint) k, a from w)
 select conv_id, turn, len(a) words, coalesce(list_sum(k), 0)::bigint + 2 - len(a) ignored, coalesce(list_sum(list_transform(a, lambda x: case when length(x) > 5 then 1 else 0 end)), 0)::bigint label_sum from p""")
def ner_aligned(spark: SparkSession, base: str) -> DataFrame:
    """Words in sub-tokens of four characters between two special ones; long words are B- of the first type."""
    rows = load(spark, base, "conversations").filter("text is not null").select("conv_id", "turn", ent.words_with_offsets(F.col("text")).alias("w"))
    numbers = F.flatten(F.transform("w", lambda w, i: F.array_repeat(i, F.ceil(F.length(w["word"]) / 4).cast("int"))))
    special = F.array(F.lit(None).cast("int"))
    tags = F.transform("w", lambda w: F.when(F.length(w["word"]) > 5, BIO_TAGS[1]).otherwise("O"))
    rows = rows.select("conv_id", "turn", "w", F.concat(special, numbers, special).alias("numbers"), tags.alias("tags"))
    rows = rows.select("conv_id", "turn", F.size("w").cast("long").alias("words"), evaluate.aligned(F.col("numbers"), F.col("tags"), BIO_TAGS).alias("labels"))
    ignored = F.size(F.filter("labels", lambda x: x == -100)).cast("long")
    total = F.aggregate(F.filter("labels", lambda x: x >= 0), F.lit(0).cast("long"), lambda t, x: t + x)
    return rows.select("conv_id", "turn", "words", ignored.alias("ignored"), total.alias("label_sum"))


@query("ner_scores", "with e as (select vec_id, list_transform(embedding, lambda x: x::double) v from embeddings) select vec_id, (list_position(v, list_max(v)) - 1)::int label, round(1 / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))), 6) score from e")
def ner_scores(spark: SparkSession, base: str) -> DataFrame:
    best = evaluate.softmax_best(F.col("v"))
    rows = load(spark, base, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v")).select("vec_id", best.alias("b"))
    return rows.select("vec_id", "b.label", F.round("b.score", 6).alias("score"))


def _picky(text: str) -> list[dict]:
    if "a" in text:
        raise ValueError("cannot read this")
    return [{"label": "B-DRUG", "start": w["start"], "end": w["end"], "confidence": 1.0} for w in ent.words_of(text)]


@query("ner_error_to_empty", r"select conv_id, turn, case when contains(text, 'a') then 0 else len(regexp_extract_all(coalesce(text, ''), '\S+')) end entity_count from conversations")
def ner_error_to_empty(spark: SparkSession, base: str) -> DataFrame:
    rows = tagging.extracted(load(spark, base, "conversations").select("conv_id", "turn", "text"), tagging.forgiving(_picky), text="text")
    return rows.select("conv_id", "turn", F.col("entity_count").cast("long").alias("entity_count"))


@query("ner_ready", f"with {_GOLD} select protocol_id, count(*) n from gold group by 1")
def ner_ready(spark: SparkSession, base: str) -> DataFrame:
    return tagging.ready(_gold(spark, base)).groupBy("protocol_id").agg(F.count("*").alias("n"))
