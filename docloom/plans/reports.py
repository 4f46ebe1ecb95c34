"""Registered queries of extraction rows, tagging, embeddings and the reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import embedding
from docloom.functions import text as tx
from docloom.functions import vectors as vx
from docloom.operators import classify, extraction
from docloom.operators import entities as ent
from docloom.plans.registry import _CLS, _ENT, _GOLD, _MEAN, _PROTO, _RANK, _SEC, _STRIP, _VEC, _classified, _gold, _words, query
from docloom.sources.tables import entities, line_sections, load

# --- extraction ---

_CAPTIONS = {"images": ["figure_caption"], "tables": ["table_caption"], "formulas": ["equation"]}
_P = _STRIP.format("t")


@query("ext_pages", rf"""with {_SEC}, p as (select document_id, page_number, string_agg(content_text, chr(10) order by sequence_number) t, count(*) section_count, count(*) filter (section_type = 'figure_caption') images_count,
 count(*) filter (section_type = 'table_caption') tables_count, count(*) filter (section_type = 'equation') formulas_count from sec group by 1, 2),
 l as (select *, list_filter(string_split({_P}, chr(10)), lambda x: {_STRIP.format("x")} <> '') a from p),
 m as (select *, length({_P}) >= 20 and (((contains(lower(t), 'contents') or contains(lower(t), 'index')) and regexp_matches(t, '\.{{3,}}\s*\d+')) or (len(a) > 5 and len(list_filter(a, lambda x: regexp_matches(x, '[.\s]+\d{{1,4}}\s*$'))) * 2 > len(a))) is_toc from l)
 select document_id, page_number, md5(case when is_toc then '' else t end) text_md5, is_toc, section_count, images_count, tables_count, formulas_count from m""")
def ext_pages(spark: SparkSession, base: str) -> DataFrame:
    out = extraction.pages(line_sections(spark, base), _CAPTIONS)
    return out.select("document_id", "page_number", F.md5(F.col("text").cast("binary")).alias("text_md5"), "is_toc", "section_count", "images_count", "tables_count", "formulas_count")


@query("ext_sections_paragraphs", f"""with p as (select doc_id document_id, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {_STRIP.format("x")}), lambda x: x <> '') a from documents)
 select document_id, unnest(generate_series(1, len(a)))::int sequence_number, md5(unnest(a)) text_md5 from p""")
def ext_sections_paragraphs(spark: SparkSession, base: str) -> DataFrame:
    out = extraction.paragraph_sections(load(spark, base, "documents"), key="doc_id")
    return out.select("document_id", "sequence_number", F.md5(F.col("content_text").cast("binary")).alias("text_md5"))


@query("ext_sections_items", f"with {_SEC} select document_id, count(*) n, min(section_id) first_id, max(section_id) last_id from sec where {_STRIP.format('content_text')} <> '' group by 1")
def ext_sections_items(spark: SparkSession, base: str) -> DataFrame:
    return extraction.item_sections(line_sections(spark, base)).groupBy("document_id").agg(F.count("*").alias("n"), F.min("section_id").alias("first_id"), F.max("section_id").alias("last_id"))


@query("ext_formulas", f"with {_SEC} select document_id, page_number, printf('%s_f%05d', cast(document_id as varchar), sequence_number) formula_id, left(content_text, 200) context, true needs_llm_processing from sec where section_type = 'equation'")
def ext_formulas(spark: SparkSession, base: str) -> DataFrame:
    return extraction.formulas(line_sections(spark, base))


@query("ext_tables", "select l_orderkey document_id, l_suppkey % 3 table_id, string_agg(distinct (l_linenumber)::varchar, ',' order by l_linenumber::varchar) pages, count(*) part_count, count(distinct l_linenumber) > 1 spans_multiple_pages from lineitem group by 1, 2")
def ext_tables(spark: SparkSession, base: str) -> DataFrame:
    parts = load(spark, base, "lineitem").select(F.col("l_orderkey").alias("document_id"), (F.col("l_suppkey") % 3).alias("table_id"), F.col("l_linenumber").alias("page_number"))
    return extraction.tables(parts).select("document_id", "table_id", F.array_join(F.col("page_numbers").cast("array<string>"), ",").alias("pages"), "part_count", "spans_multiple_pages")


@query("ext_images", "select printf('%s_p%03d_img%03d', cast(p_partkey as varchar), p_size, 1) image_id, p_size * 4 < 100 is_above_header from part")
def ext_images(spark: SparkSession, base: str) -> DataFrame:
    found = load(spark, base, "part").select(F.col("p_partkey").alias("document_id"), F.col("p_size").cast("int").alias("page_number"), F.lit(1).alias("image_number"), (F.col("p_size") * 4).alias("bbox_y0"))
    return extraction.images(found).select("image_id", "is_above_header")


_READ = """rd as (select o_custkey document_id, case when o_orderstatus <> 'P' then o_orderkey end page_number, case when o_orderstatus = 'P' then 'page ' || o_orderkey::varchar end error_message, case when o_orderstatus = 'O' then 'digital' else 'fallback' end tool from orders),
 reg as (select document_id, count(page_number) page_count, count(error_message) error_count, string_agg(distinct tool, ',' order by tool) tools_used, min(error_message) error_message from rd group by 1),
 registry as (select *, case when error_count = 0 or page_count > 0 then 'SUCCESS' else 'FAILED' end processing_status from reg)"""


def _registry(spark: SparkSession, base: str) -> DataFrame:
    s = F.col("o_orderstatus")
    read = load(spark, base, "orders").select(F.col("o_custkey").alias("document_id"), F.when(s != "P", F.col("o_orderkey")).alias("page_number"), F.when(s == "P", F.concat(F.lit("page "), F.col("o_orderkey").cast("string"))).alias("error_message"), F.when(s == "O", "digital").otherwise("fallback").alias("tool"))
    return extraction.registry(read)


@query("ext_registry", f"with {_READ} select * from registry")
def ext_registry(spark: SparkSession, base: str) -> DataFrame:
    return _registry(spark, base).withColumn("tools_used", F.array_join("tools_used", ","))


@query("reg_status_summary", f"with {_READ} select processing_status, count(*) documents, sum(page_count)::bigint total_pages, sum(error_count)::bigint total_errors from registry group by 1")
def reg_status_summary(spark: SparkSession, base: str) -> DataFrame:
    return _registry(spark, base).groupBy("processing_status").agg(F.count("*").alias("documents"), F.sum("page_count").alias("total_pages"), F.sum("error_count").alias("total_errors"))


@query("reg_errors_by_tool", f"with {_READ} select error_message, count(*) n from registry where tools_used like 'fallback%' and error_message is not null group by 1 order by n desc, error_message limit 20")
def reg_errors_by_tool(spark: SparkSession, base: str) -> DataFrame:
    rows = _registry(spark, base).filter((F.get("tools_used", 0) == "fallback") & F.col("error_message").isNotNull())
    return rows.groupBy("error_message").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error_message").limit(20)


@query("reg_no_tools", "select c_custkey document_id from customer where c_custkey not in (select o_custkey from orders)")
def reg_no_tools(spark: SparkSession, base: str) -> DataFrame:
    known = load(spark, base, "customer").select(F.col("c_custkey").alias("document_id"))
    rows = known.join(_registry(spark, base), "document_id", "left")
    return rows.filter(F.size(F.coalesce("tools_used", F.array())) == 0).select("document_id")


@query("src_paths", """select c_custkey, '/Volumes/' || c_mktsegment || '/a b+c/' || c_name || '.pdf' path, 'a b+c' document_id, coalesce(nullif(regexp_extract(c_name || '_x', '^([^_]+)', 1), ''), '') protocol_id from customer""")
def src_paths(spark: SparkSession, base: str) -> DataFrame:
    raw = F.concat(F.lit("dbfs:/Volumes/"), F.col("c_mktsegment"), F.lit("/a%20b+c/"), F.col("c_name"), F.lit(".pdf"))
    rows = load(spark, base, "customer").select("c_custkey", "c_name", tx.normalized_path(raw).alias("path"))
    return rows.select("c_custkey", "path", tx.document_id(F.col("path")).alias("document_id"), tx.protocol_id(F.concat("c_name", F.lit("_x"))).alias("protocol_id"))


# --- sections ---


@query("sec_order", f"with {_SEC} select document_id, section_id, row_number() over (partition by document_id order by page_number, sequence_number, section_id)::int section_order from sec")
def sec_order(spark: SparkSession, base: str) -> DataFrame:
    w = Window.partitionBy("document_id").orderBy("page_number", "sequence_number", "section_id")
    return line_sections(spark, base).select("document_id", "section_id", F.row_number().over(w).alias("section_order"))


@query("sec_type_summary", f"with {_SEC} select section_type, count(*) n, avg({_words('content_text')}) avg_words, avg(length(content_text)) avg_chars from sec group by 1")
def sec_type_summary(spark: SparkSession, base: str) -> DataFrame:
    return line_sections(spark, base).groupBy("section_type").agg(F.count("*").alias("n"), F.avg(tx.word_count(F.col("content_text"))).alias("avg_words"), F.avg(F.length("content_text")).alias("avg_chars"))


@query("sec_sample", f"with {_SEC} select document_id, section_id, section_type, left(content_text, 100) preview from sec where section_type = 'heading' order by document_id, sequence_number limit 20")
def sec_sample(spark: SparkSession, base: str) -> DataFrame:
    rows = line_sections(spark, base).filter(F.col("section_type") == "heading").orderBy("document_id", "sequence_number").limit(20)
    return rows.select("document_id", "section_id", "section_type", F.left("content_text", F.lit(100)).alias("preview"))


# --- embeddings and classes ---


def _embedded(spark: SparkSession, base: str) -> DataFrame:
    rows = line_sections(spark, base).withColumn("is_heading", F.col("section_type") == "heading")
    return embedding.routed(rows, vx.hashed_embedding, vx.hashed_embedding)


@query("emb_statistics", f"""with {_SEC}, e as (select case when section_type = 'heading' then 'title' else 'content' end embedding_type, {_words("content_text")} word_count from sec)
 select embedding_type, count(*) n, 64 vector_length, count(*) filter (word_count = 0) zero_vectors, avg(word_count) avg_word_count from e group by 1""")
def emb_statistics(spark: SparkSession, base: str) -> DataFrame:
    return embedding.statistics(_embedded(spark, base))


@query("emb_by_document", f"with {_SEC} select document_id, count(*) total_embeddings, count(*) filter (section_type = 'heading') title_embeddings, count(*) filter (section_type <> 'heading') content_embeddings from sec group by 1")
def emb_by_document(spark: SparkSession, base: str) -> DataFrame:
    return _embedded(spark, base).groupBy("document_id").agg(F.count("*").alias("total_embeddings"), F.count_if(F.col("embedding_type") == "title").alias("title_embeddings"), F.count_if(F.col("embedding_type") == "content").alias("content_embeddings"))


@query("vec_fuse", "select vec_id section_id, round(list_inner_product(f, f), 6) square, round(f[1] * 1000)::bigint first_thousandths from (select vec_id, list_transform(u, lambda x: x / sqrt(list_inner_product(u, u))) f from (select vec_id, list_transform(generate_series(1, len(embedding)), lambda i: 0.7::double * embedding[i]::double + 0.3::double * embedding[len(embedding) + 1 - i]::double) u from embeddings))")
def vec_fuse(spark: SparkSession, base: str) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    fused = vx.fused(v, F.reverse(v))
    rows = load(spark, base, "embeddings").select(F.col("vec_id").alias("section_id"), fused.alias("f"))
    return rows.select("section_id", F.round(vx.dot(F.col("f"), F.col("f")), 6).alias("square"), F.round(F.get("f", 0) * 1000).cast("long").alias("first_thousandths"))


_DOMAINS = [("1", "CLINICAL_LABS", "LABS"), ("2", "CLINICAL_LABS", "VITALS"), ("3", "DEMOGRAPHICS", "PERSON"), ("4", "STUDY", "DESIGN")]
_DOM = "dom(classification, category_domain, category_level1) as (values " + ", ".join(str(d) for d in _DOMAINS) + ")"
_DCLS = f"{_DOM}, dcls as (select cls.*, coalesce(dom.category_domain, 'OTHER') category_domain, coalesce(dom.category_level1, 'OTHER') category_level1 from cls left join dom on dom.classification = cls.classification::varchar)"


def _with_domain(spark: SparkSession, base: str) -> DataFrame:
    domains = spark.createDataFrame(_DOMAINS, "classification string, category_domain string, category_level1 string")
    return classify.with_domain(_classified(spark, base).withColumn("classification", F.col("classification").cast("string")), F.broadcast(domains))


@query("cls_by_domain", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS}, {_DCLS} select category_domain, category_level1, count(*) n, {_MEAN} avg_conf from dcls group by 1, 2")
def cls_by_domain(spark: SparkSession, base: str) -> DataFrame:
    return _with_domain(spark, base).groupBy("category_domain", "category_level1").agg(F.count("*").alias("n"), ent.mean("confidence").alias("avg_conf"))


@query("cls_samples", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS}, {_DCLS} select section_id, classification::varchar classification, confidence from dcls where category_domain = 'CLINICAL_LABS' order by confidence desc, section_id limit 10")
def cls_samples(spark: SparkSession, base: str) -> DataFrame:
    rows = _with_domain(spark, base).filter(F.col("category_domain") == "CLINICAL_LABS")
    return rows.orderBy(F.desc("confidence"), "section_id").limit(10).select("section_id", "classification", "confidence")


@query("cls_unmapped", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS} select truth, count(*) n, min(confidence) lowest from cls where status = 'UNMAPPED' group by 1")
def cls_unmapped(spark: SparkSession, base: str) -> DataFrame:
    return _classified(spark, base).filter(F.col("status") == "UNMAPPED").groupBy("truth").agg(F.count("*").alias("n"), F.min("confidence").alias("lowest"))


# --- the published table ---


@query("gold_priority_counts", f"with {_GOLD} select ner_priority, category_domain, case when word_count > 200 then 'LONG' when word_count > 50 then 'MEDIUM' else 'SHORT' end section_complexity, count(*) n from gold group by 1, 2, 3")
def gold_priority_counts(spark: SparkSession, base: str) -> DataFrame:
    return _gold(spark, base).groupBy("ner_priority", "category_domain", "section_complexity").agg(F.count("*").alias("n"))


@query("gold_by_class", f"with {_GOLD} select classification, count(*) section_count, avg(text_length) avg_length from gold group by 1")
def gold_by_class(spark: SparkSession, base: str) -> DataFrame:
    return _gold(spark, base).groupBy("classification").agg(F.count("*").alias("section_count"), F.avg("text_length").alias("avg_length"))


@query("gold_coverage", f"with {_GOLD} select protocol_id, protocol_total_sections, count(distinct classification) protocol_unique_categories, count(*) filter (ner_priority = 'HIGH') protocol_high_sections from gold group by 1, 2")
def gold_coverage(spark: SparkSession, base: str) -> DataFrame:
    return _gold(spark, base).select("protocol_id", "protocol_total_sections", "protocol_unique_categories", "protocol_high_sections").distinct()


@query("gold_high_sample", f"with {_GOLD} select protocol_id, section_id, category_domain, left(section_text, 80) preview from gold where ner_priority = 'HIGH' order by confidence desc, protocol_id, section_id limit 20")
def gold_high_sample(spark: SparkSession, base: str) -> DataFrame:
    rows = _gold(spark, base).filter(F.col("ner_priority") == "HIGH").orderBy(F.desc("confidence"), "protocol_id", "section_id").limit(20)
    return rows.select("protocol_id", "section_id", "category_domain", F.left("section_text", F.lit(80)).alias("preview"))


# --- entities ---

@query("ner_common_entities", f"with {_ENT} select min(entity_text) canonical_text, entity_type, count(*) occurrence_count, count(distinct protocol_id) protocol_count, {_MEAN} avg_conf from ent group by entity_norm, entity_type order by occurrence_count desc, entity_norm, entity_type limit 20")
def ner_common_entities(spark: SparkSession, base: str) -> DataFrame:
    top = ent.catalog(entities(spark, base)).orderBy(F.desc("occurrence_count"), "entity_norm", "entity_type").limit(20)
    return top.select("canonical_text", "entity_type", "occurrence_count", "protocol_count", F.col("avg_confidence").alias("avg_conf"))


_SUM = "ps as (select protocol_id, count(*) total_entities, count(distinct entity_norm) unique_entities, count(distinct entity_type) unique_entity_types, count(distinct entity_norm) / count(*) entity_density from ent group by 1)"


@query("ner_protocol_averages", f"with {_ENT}, {_SUM} select count(*) protocols, avg(total_entities) avg_total_entities, avg(unique_entities) avg_unique_entities, avg(unique_entity_types) avg_entity_types, round(avg(entity_density), 6) avg_density from ps")
def ner_protocol_averages(spark: SparkSession, base: str) -> DataFrame:
    return ent.protocol_summary(entities(spark, base)).agg(F.count("*").alias("protocols"), F.avg("total_entities").alias("avg_total_entities"), F.avg("unique_entities").alias("avg_unique_entities"), F.avg("unique_entity_types").alias("avg_entity_types"), F.round(F.avg("entity_density"), 6).alias("avg_density"))


@query("ner_diverse_protocols", f"with {_ENT}, {_SUM} select protocol_id, total_entities, unique_entities, unique_entity_types, entity_density diversity from ps order by diversity desc, protocol_id limit 20")
def ner_diverse_protocols(spark: SparkSession, base: str) -> DataFrame:
    rows = ent.protocol_summary(entities(spark, base)).orderBy(F.desc("entity_density"), "protocol_id").limit(20)
    return rows.select("protocol_id", "total_entities", "unique_entities", "unique_entity_types", F.col("entity_density").alias("diversity"))


@query("ner_catalog_summary", f"with {_ENT}, g as (select entity_norm, entity_type, count(*) n from ent group by 1, 2) select count(*) unique_entities, sum(n)::bigint total_occurrences, count(distinct entity_type) entity_types from g")
def ner_catalog_summary(spark: SparkSession, base: str) -> DataFrame:
    each = ent.normalized(entities(spark, base)).groupBy("entity_norm", "entity_type").agg(F.count("*").alias("n"))
    return each.agg(F.count("*").alias("unique_entities"), F.sum("n").alias("total_occurrences"), F.count_distinct("entity_type").alias("entity_types"))


@query("ner_class_totals", f"with {_ENT}, g as (select classification, category_domain, entity_type, count(*) n, count(distinct entity_norm) u from ent group by 1, 2, 3) select classification, sum(n)::bigint total_entities, sum(u)::bigint total_unique from g group by 1 order by total_entities desc, classification limit 20")
def ner_class_totals(spark: SparkSession, base: str) -> DataFrame:
    each = ent.normalized(entities(spark, base)).groupBy("classification", "category_domain", "entity_type").agg(F.count("*").alias("n"), F.count_distinct("entity_norm").alias("u"))
    return each.groupBy("classification").agg(F.sum("n").alias("total_entities"), F.sum("u").alias("total_unique")).orderBy(F.desc("total_entities"), "classification").limit(20)
