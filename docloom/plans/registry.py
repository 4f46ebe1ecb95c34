"""Registered queries of the document-intelligence engine and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.constants import BIO_TAGS, CHUNK_WORDS, ENTITY_TYPES, TOP_K
from docloom.functions import text as tx
from docloom.functions import vectors as vx
from docloom.operators import classify, evaluate, extraction, gold, structure
from docloom.operators import entities as ent
from docloom.session import fine_shuffles, prepare
from docloom.sources import io
from docloom.sources.tables import entities, line_sections, load, vectors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = wraps(f)(lambda spark, base: f(fine_shuffles(prepare(spark)), base))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


# --- shared SQL ---

_ENT = """ent as (select o_custkey protocol_id, l_orderkey section_id, o_orderpriority classification, c_mktsegment category_domain, p_name entity_text,
 p_type entity_type, 1 - l_discount confidence, lower(trim(p_name)) entity_norm
 from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey join customer on o_custkey = c_custkey)"""
_MEAN = "cast(sum(cast(confidence as decimal(28, 12))) as double) / count(confidence)"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _words(c: str) -> str:
    return f"(case when {_STRIP.format(c)} = '' then 0 else len(regexp_split_to_array({_STRIP.format(c)}, '\\s+')) end)"


_T = _STRIP.format("content_text")
_TOC = rf"""(length({_T}) >= 20 and (((contains(lower({_T}), 'contents') or contains(lower({_T}), 'index')) and regexp_matches({_T}, '\.{{3,}}\s*\d+'))))"""
_TYPE = rf"""case when content_text is null or content_text = '' then 'unknown' when {_TOC} then 'toc'
 when regexp_matches({_T}, '^[\d.]+\s+.+[.\s]+\d+\s*$') then 'toc_entry'
 when regexp_matches(lower({_T}), '^(chapter|section|article|part)\s+[\divxlc]+') then 'heading'
 when regexp_matches({_T}, '^[\d.]+\s+[A-Z]') and length({_T}) < 100 then 'heading'
 when regexp_matches(lower({_T}), '^appendix\s+[a-z\d]') then 'appendix'
 when regexp_matches({_T}, '^[-•*]\s') then 'list_item'
 when regexp_matches(lower({_T}), '^(figure|fig\.?)\s+\d+') then 'figure_caption'
 when regexp_matches(lower({_T}), '^(table|tbl\.?)\s+\d+') then 'table_caption'
 when regexp_matches({_T}, '[∫∑∏√∂∇≠≤≥±×÷]') then 'equation' else 'paragraph' end"""
_LEVEL = rf"""case when section_type = 'heading' then len(string_split(regexp_replace(regexp_extract({_T}, '^([\d.]+)', 1), '^\.+|\.+$', '', 'g'), '.')) end"""
_SEC = f"""lines as (select doc_id document_id, source, unnest(string_split(text, chr(10))) content_text, generate_subscripts(string_split(text, chr(10)), 1) sequence_number from documents),
 typed as (select *, cast((sequence_number - 1) // 5 + 1 as integer) page_number, {_TYPE} section_type from lines),
 sec as (select *, printf('%s_s%05d', cast(document_id as varchar), sequence_number) section_id, cast({_LEVEL} as integer) heading_level from typed)"""
_VEC = """raw as (select vec_id section_id, label, list_transform(embedding, lambda x: cast(x as double)) vector from embeddings),
 vec as (select section_id, label, list_transform(vector, lambda x: x / sqrt(list_inner_product(vector, vector))) vector from raw)"""
_PROTO = """proto as (select label, list(m / n order by i) prototype from (select *, sqrt(sum(m * m) over (partition by label)) n from
 (select label, i, avg(x) m from (select label, unnest(vector) x, generate_subscripts(vector, 1) i from vec) group by label, i)) group by label)"""
_RANK = """ranked as (select section_id, vec.label truth, proto.label, round(list_inner_product(vector, prototype) / (sqrt(list_inner_product(vector, vector))), 6) score,
 row_number() over (partition by section_id order by round(list_inner_product(vector, prototype) / (sqrt(list_inner_product(vector, vector))), 6) desc, proto.label) r from vec, proto)"""
_CLS = """cls as (select a.section_id, a.truth, a.label classification, a.score confidence, round(a.score - b.score, 6) margin,
 case when a.score < 0.72 then 'UNMAPPED' when a.score - b.score < 0.02 then 'AMBIGUOUS' else 'SUCCESS' end status from ranked a join ranked b on a.section_id = b.section_id and a.r = 1 and b.r = 2)"""


# --- entities ---


@query("ner_catalog", f"""with {_ENT}, g as (select entity_norm, entity_type, count(*) occurrence_count, count(distinct protocol_id) protocol_count, count(distinct section_id) section_count,
 {_MEAN} avg_confidence, min(confidence) min_confidence, max(confidence) max_confidence, string_agg(distinct classification, ',' order by classification) found_in_classifications,
 string_agg(distinct category_domain, ',' order by category_domain) found_in_domains, min(entity_text) canonical_text, count(distinct entity_text) variant_count,
 string_agg(distinct protocol_id::varchar, ',' order by protocol_id::varchar) protocol_list, string_agg(distinct entity_text, ',' order by entity_text) text_variants from ent group by 1, 2)
 select *, entity_type || '_' || md5(entity_norm) entity_id, row_number() over (partition by entity_type order by occurrence_count desc, entity_norm) rank_in_type from g""")  # fmt: skip
def ner_catalog(spark: SparkSession, base: str) -> DataFrame:
    def joined(c: str) -> Column:
        return F.array_join(F.array_sort(F.col(c).cast("array<string>")), ",")

    return ent.catalog(entities(spark, base)).withColumns({c: joined(c) for c in ("protocol_list", "text_variants")})


@query("ner_protocol_summary", f"""with {_ENT} select protocol_id, count(*) total_entities, count(distinct entity_norm) unique_entities, count(distinct entity_type) unique_entity_types, {_MEAN} avg_entity_confidence,
 count(distinct classification) unique_classifications, count(distinct category_domain) unique_domains, count(distinct entity_norm) / count(*) entity_density from ent group by 1""")
def ner_protocol_summary(spark: SparkSession, base: str) -> DataFrame:
    return ent.protocol_summary(entities(spark, base))


@query("ner_type_counts", f"""with {_ENT}, c as (select protocol_id, entity_type, count(*) n from ent group by 1, 2)
 select protocol_id, string_agg(entity_type || '=' || n, ',' order by entity_type) type_counts from c group by 1""")
def ner_type_counts(spark: SparkSession, base: str) -> DataFrame:
    return ent.type_counts(entities(spark, base)).select("protocol_id", "type_counts")


_PAIRS = f"""{_ENT}, num as (select *, row_number() over (partition by protocol_id, section_id, classification order by entity_norm, entity_type) i from ent),
 pairs as (select a.protocol_id, a.section_id, a.classification, a.entity_norm entity1, b.entity_norm entity2, a.entity_type type1, b.entity_type type2
 from num a join num b on a.protocol_id = b.protocol_id and a.section_id = b.section_id and a.classification = b.classification and a.i < b.i)"""


@query("ner_pairs", f"with {_PAIRS} select * from pairs")
def ner_pairs(spark: SparkSession, base: str) -> DataFrame:
    return ent.pairs(entities(spark, base))


_CO = """co as (select entity1, entity2, type1, type2, count(*) cooccurrence_count, count(distinct protocol_id) protocol_count, count(distinct section_id) section_count,
 string_agg(distinct classification, ',' order by classification) cooccurring_in from pairs group by 1, 2, 3, 4)"""


@query("ner_cooccurrence", f"with {_PAIRS}, {_CO} select * from co")
def ner_cooccurrence(spark: SparkSession, base: str) -> DataFrame:
    return ent.cooccurrence(entities(spark, base))


@query("ner_cross_type_pairs", f"with {_PAIRS}, {_CO} select * from co where type1 != type2 order by cooccurrence_count desc, entity1, entity2, type1, type2 limit 20")
def ner_cross_type_pairs(spark: SparkSession, base: str) -> DataFrame:
    return ent.cooccurrence(entities(spark, base)).filter("type1 != type2").orderBy(F.desc("cooccurrence_count"), "entity1", "entity2", "type1", "type2").limit(20)


@query("ner_category_dist", f"""with {_ENT}, s as (select classification, category_domain, entity_type, count(*) entity_count, count(distinct entity_norm) unique_entities, count(distinct protocol_id) protocol_count, {_MEAN} avg_confidence from ent group by 1, 2, 3),
 f as (select classification, category_domain, entity_type, entity_norm, row_number() over (partition by classification, category_domain, entity_type order by count(*) desc, entity_norm) r from ent group by 1, 2, 3, 4)
 select s.*, t.top_entities from s join (select classification, category_domain, entity_type, string_agg(entity_norm, ',' order by r) top_entities from f where r <= 10 group by 1, 2, 3) t using (classification, category_domain, entity_type)""")
def ner_category_dist(spark: SparkSession, base: str) -> DataFrame:
    return ent.category_distribution(entities(spark, base))


@query("ner_top_per_type", f"""with {_ENT}, e as (select entity_type, entity_norm, count(*) n from ent group by 1, 2), k as (select entity_type, sum(n)::bigint type_total from e group by 1 order by 2 desc, 1 limit 5)
 select entity_type, type_total, entity_norm, n, rank from (select *, row_number() over (partition by entity_type order by n desc, entity_norm) rank from e) join k using (entity_type) where rank <= 10""")
def ner_top_per_type(spark: SparkSession, base: str) -> DataFrame:
    return ent.top_per_type(entities(spark, base))


@query("ner_type_distribution", f"with {_ENT} select entity_type, count(*) entity_count, {_MEAN} avg_confidence, count(distinct entity_norm) unique_entities from ent group by 1")
def ner_type_distribution(spark: SparkSession, base: str) -> DataFrame:
    return ent.type_distribution(entities(spark, base))


@query("ner_diversity", f"with {_ENT} select classification, count(*) total, count(distinct entity_type) types, count(distinct entity_norm) texts from ent group by 1 order by texts desc, classification limit 10")
def ner_diversity(spark: SparkSession, base: str) -> DataFrame:
    return ent.normalized(entities(spark, base)).groupBy("classification").agg(F.count("*").alias("total"), F.count_distinct("entity_type").alias("types"), F.count_distinct("entity_norm").alias("texts")).orderBy(F.desc("texts"), "classification").limit(10)


@query("drug_dosage_join", f"""with {_ENT}, t as (select min(entity_type) a, max(entity_type) b from ent)
 select d.section_id, d.entity_norm drug, e.entity_norm dosage, count(*) n from ent d join ent e on d.protocol_id = e.protocol_id and d.section_id = e.section_id
 where d.entity_type = (select a from t) and e.entity_type = (select b from t) group by 1, 2, 3""")
def drug_dosage_join(spark: SparkSession, base: str) -> DataFrame:
    rows = ent.normalized(entities(spark, base))
    kinds = load(spark, base, "part").agg(F.min("p_type").alias("a"), F.max("p_type").alias("b")).first()
    d, e = rows.filter(F.col("entity_type") == kinds.a).alias("d"), rows.filter(F.col("entity_type") == kinds.b).alias("e")
    joined = d.join(e, (F.col("d.protocol_id") == F.col("e.protocol_id")) & (F.col("d.section_id") == F.col("e.section_id")))
    return joined.groupBy(F.col("d.section_id").alias("section_id"), F.col("d.entity_norm").alias("drug"), F.col("e.entity_norm").alias("dosage")).agg(F.count("*").alias("n"))


@query("entity_report", f"with {_ENT} select category_domain, count(*) entities, round(count(*) * 100.0 / sum(count(*)) over (), 6) pct from ent group by 1")
def entity_report(spark: SparkSession, base: str) -> DataFrame:
    each = entities(spark, base).groupBy("category_domain").agg(F.count("*").alias("entities"))
    return each.withColumn("pct", F.round(F.col("entities") * 100.0 / F.sum("entities").over(Window.partitionBy()), 6))


# --- sections ---


@query("sec_type_distribution", f"with {_SEC} select section_type, count(*) n, count(distinct document_id) documents from sec group by 1")
def sec_type_distribution(spark: SparkSession, base: str) -> DataFrame:
    return line_sections(spark, base).groupBy("section_type").agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("documents"))


@query("sec_heading_level", f"with {_SEC} select document_id, section_id, section_type, heading_level from sec where section_type <> 'paragraph'")
def sec_heading_level(spark: SparkSession, base: str) -> DataFrame:
    return line_sections(spark, base).filter("section_type <> 'paragraph'").select("document_id", "section_id", "section_type", "heading_level")


#: What stands before and after the names of parts, so that every rule of sections has lines.
_BEFORE = ["", "1.2.3 Big ", "Chapter IV ", "Appendix B ", "- ", "Fig. 3 ", "Table 12 ", "x ± y ", "4. ", "Table of contents, ", "7 Long ", "2.10 "]
_AFTER = ["", "", "", "", "", "", "", "", " .... 17", " .... 3", " and so on, far beyond a hundred characters, which no heading of this kind may have, however it begins", ""]


@query("sec_type_rules", f"""with named as (select p_partkey, case when p_partkey % 13 < 12 then ([{', '.join(f"'{x}'" for x in _BEFORE)}])[p_partkey % 13 + 1] || p_name || ([{', '.join(f"'{x}'" for x in _AFTER)}])[p_partkey % 13 + 1] end content_text from part),
 typed as (select *, {_TYPE} section_type from named) select p_partkey, section_type, coalesce({_LEVEL}, 0)::int heading_level from typed""")
def sec_type_rules(spark: SparkSession, base: str) -> DataFrame:
    at = (F.col("p_partkey") % 13).cast("int")
    pick = lambda values: F.get(F.array(*map(F.lit, values)), at)
    rows = load(spark, base, "part").select("p_partkey", F.when(at < 12, F.concat(pick(_BEFORE), "p_name", pick(_AFTER))).alias("content_text"))
    rows = rows.withColumn("section_type", tx.section_type(F.col("content_text")))
    return rows.select("p_partkey", "section_type", F.coalesce(tx.heading_level(F.col("content_text"), F.col("section_type")), F.lit(0)).alias("heading_level"))


_MD = f"""case when coalesce(content_text, '') = '' then '' when section_type = 'heading' then repeat('#', least(greatest(coalesce(heading_level, 1), 1), 6)) || ' ' || {_T}
 when section_type = 'list_item' then '- ' || {_T} when section_type = 'equation' and length({_T}) > 50 then '$$' || chr(10) || {_T} || chr(10) || '$$'
 when section_type = 'equation' then '$' || {_T} || '$' when section_type in ('figure_caption', 'table_caption') then '*' || {_T} || '*' else {_T} end"""


@query("sec_markdown", f"with {_SEC} select document_id, section_id, md5({_MD}) markdown_md5 from sec")
def sec_markdown(spark: SparkSession, base: str) -> DataFrame:
    made = tx.markdown(F.col("content_text"), F.col("section_type"), F.col("heading_level"))
    return line_sections(spark, base).select("document_id", "section_id", F.md5(made.cast("binary")).alias("markdown_md5"))


_NOISE = """pg as (select document_id, count(distinct page_number) pages from sec group by 1),
 noise as (select document_id, content_text from (select document_id, content_text, count(distinct page_number) c from sec where trim(content_text) <> '' group by 1, 2) join pg using (document_id) where c > pages * 0.5)"""


@query("sec_noise", f"with {_SEC}, {_NOISE} select document_id, count(*) noise_texts from noise group by 1")
def sec_noise(spark: SparkSession, base: str) -> DataFrame:
    return structure.repeated_noise(line_sections(spark, base)).groupBy("document_id").agg(F.count("*").alias("noise_texts"))


@query("sec_clean", f"with {_SEC}, {_NOISE} select document_id, count(*) kept, sum(length(content_text))::bigint chars from sec s where not exists (select 1 from noise n where n.document_id = s.document_id and n.content_text = s.content_text) group by 1")
def sec_clean(spark: SparkSession, base: str) -> DataFrame:
    rows = line_sections(spark, base)
    return structure.without_noise(rows, structure.repeated_noise(rows)).groupBy("document_id").agg(F.count("*").alias("kept"), F.sum(F.length("content_text")).alias("chars"))


def _leveled(spark: SparkSession, base: str) -> DataFrame:
    """Sections with made-up headings: every seventh line a heading, its level from the line's number."""
    rows = line_sections(spark, base)
    n = F.col("sequence_number")
    made = rows.withColumn("section_type", F.when(n % 7 == 1, "heading").otherwise("table")).withColumn("heading_level", F.when(n % 7 == 1, (n * 3 + F.col("document_id")) % 4 + 1).cast("int"))
    return structure.ordered(made)


_HIER = f"""{_SEC}, lev as (select * exclude (section_type, heading_level), case when sequence_number % 7 = 1 then 'heading' else 'table' end section_type, case when sequence_number % 7 = 1 then (sequence_number * 3 + document_id) % 4 + 1 end eff from sec),
 ord as (select *, row_number() over (partition by document_id order by page_number, sequence_number, section_id) doc_order from lev),
 lasts as (select *, last_value(case when eff = 1 then section_id end ignore nulls) over w h1, last_value(case when eff = 2 then section_id end ignore nulls) over w h2,
 last_value(case when eff = 3 then section_id end ignore nulls) over w h3, last_value(case when eff = 4 then section_id end ignore nulls) over w h4 from ord window w as (partition by document_id order by doc_order rows between unbounded preceding and current row)),
 hier as (select document_id, section_id, doc_order, eff, case when eff is null then coalesce(h4, h3, h2, h1) when eff = 2 then h1 when eff = 3 then h2 when eff = 4 then h3 end parent_section_id from lasts)"""


@query("sec_hierarchy_ref", f"with {_HIER} select document_id, section_id, parent_section_id from hier")
def sec_hierarchy_ref(spark: SparkSession, base: str) -> DataFrame:
    return structure.with_hierarchy(_leveled(spark, base)).select("document_id", "section_id", "parent_section_id")


@query("sec_hierarchy_strict", f"""with {_HIER}, cand as (select c.document_id, c.section_id, c.doc_order, c.eff, p.section_id parent, p.doc_order po, p.eff pe from hier c left join hier p on p.document_id = c.document_id and p.doc_order < c.doc_order and p.eff is not null
 and (c.eff is null or p.eff = c.eff - 1) and not exists (select 1 from hier q where q.document_id = c.document_id and q.doc_order > p.doc_order and q.doc_order < c.doc_order and q.eff < p.eff)
 and not exists (select 1 from hier q where q.document_id = c.document_id and q.doc_order > p.doc_order and q.doc_order < c.doc_order and q.eff = p.eff))
 select document_id, section_id, max_by(parent, pe) parent_section_id from cand group by 1, 2""")
def sec_hierarchy_strict(spark: SparkSession, base: str) -> DataFrame:
    return structure.with_hierarchy(_leveled(spark, base), strict=True).select("document_id", "section_id", "parent_section_id")


@query("sec_path", f"""with {_HIER} select s.document_id, s.section_id, concat_ws(' > ', p5.parent_section_id, p4.parent_section_id, p3.parent_section_id, p2.parent_section_id, s.parent_section_id, s.section_id) hierarchy_path from hier s
 left join hier p2 on p2.document_id = s.document_id and p2.section_id = s.parent_section_id left join hier p3 on p3.document_id = s.document_id and p3.section_id = p2.parent_section_id
 left join hier p4 on p4.document_id = s.document_id and p4.section_id = p3.parent_section_id left join hier p5 on p5.document_id = s.document_id and p5.section_id = p4.parent_section_id""")
def sec_path(spark: SparkSession, base: str) -> DataFrame:
    return structure.with_path(structure.with_hierarchy(_leveled(spark, base))).select("document_id", "section_id", "hierarchy_path")


@query("sec_leaf", f"with {_HIER} select document_id, count(*) sections, sum(case when not exists (select 1 from hier c where c.document_id = h.document_id and c.parent_section_id = h.section_id) then 1 else 0 end)::bigint leaves from hier h group by 1")
def sec_leaf(spark: SparkSession, base: str) -> DataFrame:
    rows = structure.with_leaf(structure.with_hierarchy(_leveled(spark, base)))
    return rows.groupBy("document_id").agg(F.count("*").alias("sections"), F.sum(F.when(F.col("is_leaf"), 1).otherwise(0)).alias("leaves"))


@query("sec_depth_hist", f"with {_HIER} select coalesce(eff, 0)::bigint depth, count(*) n from hier group by 1")
def sec_depth_hist(spark: SparkSession, base: str) -> DataFrame:
    return structure.with_hierarchy(_leveled(spark, base)).groupBy(F.coalesce("effective_level", F.lit(0)).cast("long").alias("depth")).agg(F.count("*").alias("n"))


@query("sec_merge", f"""with {_SEC}, m as (select *, case when sequence_number % 7 = 1 then 'heading' when section_type = 'heading' then 'paragraph' else section_type end kind, case when sequence_number % 7 = 1 then (sequence_number * 3 + document_id) % 4 + 1 end eff, sequence_number doc_order from sec),
 h as (select *, last_value(case when eff = 1 then section_id end ignore nulls) over w h1, last_value(case when eff = 2 then section_id end ignore nulls) over w h2,
 last_value(case when eff = 3 then section_id end ignore nulls) over w h3, last_value(case when eff = 4 then section_id end ignore nulls) over w h4 from m window w as (partition by document_id order by doc_order rows between unbounded preceding and current row)),
 s as (select *, coalesce(case when eff is null then coalesce(h4, h3, h2, h1) when eff = 2 then h1 when eff = 3 then h2 when eff = 4 then h3 end, 'ROOT') parent, (kind = 'paragraph' and {_words("content_text")} <= 200) short from h),
 f as (select *, case when short and coalesce(lag(short) over w, false) and lag(doc_order) over w = doc_order - 1 then 0 else 1 end n from s window w as (partition by document_id, page_number, parent order by doc_order)),
 g as (select *, sum(n) over (partition by document_id order by doc_order rows unbounded preceding) grp from f)
 select document_id, grp::bigint merge_group, min(doc_order)::bigint doc_order, count(*) merged_count, min_by(source, doc_order) source, min_by(section_id, doc_order) section_id, md5(string_agg(content_text, ' ' order by doc_order)) text_md5 from g group by 1, 2""")
def sec_merge(spark: SparkSession, base: str) -> DataFrame:
    """Under headings made up of every seventh line, so that parents keep paragraphs apart; a run carries its first section's attributes."""
    n = F.col("sequence_number")
    rows = line_sections(spark, base).withColumn("section_type", F.when(n % 7 == 1, "heading").when(F.col("section_type") == "heading", "paragraph").otherwise(F.col("section_type")))
    rows = rows.withColumn("heading_level", F.when(n % 7 == 1, (n * 3 + F.col("document_id")) % 4 + 1).cast("int"))
    rows = structure.with_hierarchy(structure.ordered(rows))
    return structure.merged_paragraphs(rows).select("document_id", "merge_group", F.col("doc_order").cast("long").alias("doc_order"), "merged_count", "source", "section_id", F.md5(F.col("content_text").cast("binary")).alias("text_md5"))


_CHUNK = r"""d as (select doc_id, regexp_replace(regexp_replace(text, '([.!?])\s+([A-Z])', '\1' || chr(30) || '\2', 'g'), '([.!?])\s*\n+', '\1' || chr(30), 'g') t from documents),
 s as (select doc_id, list_filter(list_transform(string_split(t, chr(30)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') sent from d where t <> ''),
 u as (select doc_id, unnest(sent) x, generate_subscripts(sent, 1) i from s), n as (select *, len(regexp_split_to_array(x, '\s+')) w from u),
 l as (select doc_id, list({done: [x], cur: w} order by i) a from n group by 1),
 r as (select doc_id, list_reduce(a, lambda p, q: case when p.cur + q.cur > 150 then {done: list_concat(p.done, q.done), cur: q.cur} else {done: list_concat(list_slice(p.done, 1, len(p.done) - 1), [p.done[-1] || ' ' || q.done[1]]), cur: p.cur + q.cur} end).done c from l)"""


@query("sec_chunk", f"with {_CHUNK} select doc_id, unnest(generate_series(1, len(c))) chunk_index, md5(unnest(c)) chunk_md5 from r")
def sec_chunk(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents").filter("text <> ''").select("doc_id", F.col("doc_id").cast("string").alias("section_id"), F.lit("paragraph").alias("section_type"), F.col("text").alias("content_text"))
    made = structure.chunked(docs, over=0, most=CHUNK_WORDS)
    return made.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5(F.col("content_text").cast("binary")).alias("chunk_md5"))


@query("sec_chunk_summary", f"with w as (select case when {_words('text')} > 200 then 'Chunked' else 'Not Chunked' end kind, length(text) n from documents) select kind, count(*) documents, sum(n)::bigint chars from w group by 1")
def sec_chunk_summary(spark: SparkSession, base: str) -> DataFrame:
    docs = load(spark, base, "documents")
    return docs.groupBy(F.when(tx.word_count(F.col("text")) > 200, "Chunked").otherwise("Not Chunked").alias("kind")).agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("chars"))


@query("sec_doc_summary", f"""with {_SEC} select document_id, count(*) sections, count(distinct page_number) pages, sum(case when section_type = 'heading' then 1 else 0 end)::bigint headings,
 sum({_words("content_text")})::bigint words, max(length(content_text)) longest from sec group by 1""")
def sec_doc_summary(spark: SparkSession, base: str) -> DataFrame:
    return line_sections(spark, base).groupBy("document_id").agg(F.count("*").alias("sections"), F.count_distinct("page_number").alias("pages"), F.sum(F.when(F.col("section_type") == "heading", 1).otherwise(0)).alias("headings"), F.sum(tx.word_count(F.col("content_text"))).alias("words"), F.max(F.length("content_text")).alias("longest"))


@query("ext_pages_from_sections", f"with {_SEC} select document_id, page_number, md5(left(string_agg(content_text, chr(10) order by sequence_number), 5000)) text_md5, count(*) section_count from sec group by 1, 2")
def ext_pages_from_sections(spark: SparkSession, base: str) -> DataFrame:
    out = extraction.pages_from_sections(line_sections(spark, base))
    return out.select("document_id", "page_number", F.md5(F.col("text").cast("binary")).alias("text_md5"), "section_count")


@query("ext_metadata", f"with {_SEC} select document_id, max(page_number)::int page_count, count(*) section_count, coalesce(string_agg(distinct page_number::varchar, ',' order by page_number::varchar) filter (section_type = 'equation'), '') equation_pages from sec group by 1")
def ext_metadata(spark: SparkSession, base: str) -> DataFrame:
    pages = F.array_join(F.array_sort(F.collect_set(F.when(F.col("section_type") == "equation", F.col("page_number").cast("string")))), ",")
    return line_sections(spark, base).groupBy("document_id").agg(F.max("page_number").alias("page_count"), F.count("*").alias("section_count"), pages.alias("equation_pages"))


@query("sec_toc_pages", r"""with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '') a, regexp_replace(text, '^\s+|\s+$', '', 'g') t from documents)
 select doc_id, length(t) >= 20 and (((contains(lower(t), 'contents') or contains(lower(t), 'index')) and regexp_matches(t, '\.{3,}\s*\d+')) or (len(a) > 5 and len(list_filter(a, lambda x: regexp_matches(x, '[.\s]+\d{1,4}\s*$'))) * 2 > len(a))) is_toc from l""")
def sec_toc_pages(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "documents").select("doc_id", tx.is_toc_page(F.col("text")).alias("is_toc"))


# --- vectors ---


@query("vec_norm", f"with {_VEC} select section_id, round(sqrt(list_inner_product(vector, vector)), 6) norm, len(list_filter(vector, lambda x: x <> 0)) = 0 is_zero, round(vector[1], 6) first, len(vector[1:5]) preview from raw")
def vec_norm(spark: SparkSession, base: str) -> DataFrame:
    v = F.col("vector")
    return vectors(spark, base).select("section_id", F.round(vx.norm(v), 6).alias("norm"), vx.is_zero(v).alias("is_zero"), F.round(F.element_at(v, 1), 6).alias("first"), F.size(F.slice(v, 1, 5)).cast("long").alias("preview"))


@query("vec_prototypes", f"with {_VEC}, {_PROTO} select label, round(prototype[1], 6) p1, round(prototype[64], 6) p64, len(prototype) dims from proto")
def vec_prototypes(spark: SparkSession, base: str) -> DataFrame:
    p = classify.prototypes(vectors(spark, base))
    return p.select("label", F.round(F.element_at("prototype", 1), 6).alias("p1"), F.round(F.element_at("prototype", 64), 6).alias("p64"), F.size("prototype").cast("long").alias("dims"))


def _classified(spark: SparkSession, base: str) -> DataFrame:
    rows = vectors(spark, base)
    return classify.classified(classify.scored(rows.withColumnRenamed("label", "truth"), classify.prototypes(rows), digits=6, k=TOP_K))


@query("vec_classify", f"""with {_VEC}, {_PROTO}, {_RANK}, {_CLS} select cls.section_id, classification, confidence, round(margin * 1000000)::bigint margin_millionths, status, top_k_labels, secondary_labels from cls
 join (select section_id, string_agg(label::varchar, ',' order by r) top_k_labels from ranked where r <= 5 group by 1) k using (section_id)
 join (select a.section_id, coalesce(string_agg(b.label::varchar, ',' order by b.r) filter (b.score >= 0.68 or a.score - b.score <= 0.04), '') secondary_labels from ranked a join ranked b on a.section_id = b.section_id and a.r = 1 and b.r between 2 and 5 group by 1) m using (section_id)""")
def vec_classify(spark: SparkSession, base: str) -> DataFrame:
    return _classified(spark, base).select("section_id", "classification", "confidence", F.round(F.col("margin") * 1_000_000).cast("long").alias("margin_millionths"), "status", F.array_join(F.col("top_k_labels").cast("array<string>"), ",").alias("top_k_labels"), F.array_join(F.col("secondary_labels").cast("array<string>"), ",").alias("secondary_labels"))


@query("vec_fuse_accuracy", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS} select truth, count(*) n, sum(case when truth = classification then 1 else 0 end)::bigint correct, sum(case when truth = classification then 1 else 0 end) * 100.0 / count(*) accuracy from cls group by 1")
def vec_fuse_accuracy(spark: SparkSession, base: str) -> DataFrame:
    return evaluate.accuracy(_classified(spark, base), "truth", "classification", by="truth")


@query("cls_status_pct", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS} select status, count(*) n, count(*) * 100.0 / sum(count(*)) over () pct from cls group by 1")
def cls_status_pct(spark: SparkSession, base: str) -> DataFrame:
    each = _classified(spark, base).groupBy("status").agg(F.count("*").alias("n"))
    return each.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


@query("cls_top15", f"with {_VEC}, {_PROTO}, {_RANK}, {_CLS} select classification, count(*) n, max(confidence) best from cls group by 1 order by n desc, classification limit 15")
def cls_top15(spark: SparkSession, base: str) -> DataFrame:
    return _classified(spark, base).groupBy("classification").agg(F.count("*").alias("n"), F.max("confidence").alias("best")).orderBy(F.desc("n"), "classification").limit(15)


def _best_sql(p: str, vector: str) -> str:
    score = "round(list_inner_product(vector, prototype) / sqrt(list_inner_product(vector, vector)), 6)"
    return f"""{p}_vec as (select section_id, label, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) vector from (select vec_id section_id, label, {vector} v from embeddings)),
 {p}_proto as (select label, list(m / n order by i) prototype from (select *, sqrt(sum(m * m) over (partition by label)) n from (select label, i, avg(x) m from (select label, unnest(vector) x, generate_subscripts(vector, 1) i from {p}_vec) group by label, i)) group by label),
 {p} as (select section_id, truth, label guess, score from (select section_id, v.label truth, p.label, {score} score, row_number() over (partition by section_id order by {score} desc, p.label) r from {p}_vec v, {p}_proto p) where r = 1)"""


_PLAIN, _BACK = "list_transform(embedding, lambda x: x::double)", "list_transform(generate_series(1, len(embedding)), lambda i: embedding[len(embedding) + 1 - i]::double * i)"


@query("cls_compare", f"""with {_best_sql('first', _PLAIN)}, {_best_sql('second', _BACK)},
 {_best_sql('dual', f"list_transform(range(1, len(embedding) + 1), lambda j: 0.7::double * embedding[j]::double / sqrt(list_inner_product({_PLAIN}, {_PLAIN})) + 0.3::double * embedding[len(embedding) + 1 - j]::double * j / sqrt(list_inner_product({_BACK}, {_BACK})))")},
 long_ as (select 'first' model, * from first union all select 'second', * from second union all select 'dual', * from dual),
 cells as (select model, (['short', 'long', 'ambiguous'])[section_id % 3 + 1] case_type, truth = guess hit, score from long_),
 sums as (select model, coalesce(case_type, 'all') case_type, count(*) n, count(*) filter (hit) correct, count(*) filter (hit) * 100.0 / count(*) accuracy, avg(score) filter (hit) sure from cells group by grouping sets ((model, case_type), (model)))
 select b.model, b.case_type, b.n, b.correct, round(b.accuracy, 6) accuracy, round(b.accuracy - a.accuracy, 6) difference, round(coalesce(b.sure, -1), 5) mean_confidence from sums b join sums a on a.model = 'first' and a.case_type = b.case_type""")
def cls_compare(spark: SparkSession, base: str) -> DataFrame:
    """Two models and their fusion, by case type: the vectors as they are, backwards and weighted, and seven to three of both."""
    rows = vectors(spark, base)
    back = F.transform(F.reverse("vector"), lambda x, i: x * (i + 1))
    rows = rows.select("section_id", "label", F.col("vector").alias("first"), back.alias("second"))
    rows = rows.withColumn("dual", vx.fused(vx.normalized(F.col("first")), vx.normalized(F.col("second"))))
    case = F.get(F.array(*map(F.lit, ("short", "long", "ambiguous"))), (F.col("section_id") % 3).cast("int"))
    every = rows.select("section_id", F.col("label").alias("truth"), case.alias("case_type"))
    for model in ("first", "second", "dual"):
        own = rows.select("section_id", "label", F.col(model).alias("vector"))
        best = F.get(F.col("ranked"), 0)
        found = classify.scored(own.drop("label"), classify.prototypes(own), digits=6, k=2).select("section_id", best["label"].alias(f"{model}_guess"), best["score"].alias(f"{model}_score"))
        every = every.join(found, "section_id")
    out = evaluate.compared(every, "truth", {m: (f"{m}_guess", f"{m}_score") for m in ("first", "second", "dual")}, "first", "case_type")
    return out.select("model", F.coalesce("case_type", F.lit("all")).alias("case_type"), "n", "correct", F.round("accuracy", 6).alias("accuracy"), F.round("difference", 6).alias("difference"), F.round(F.coalesce("mean_confidence", F.lit(-1.0)), 5).alias("mean_confidence"))


_MIXED = """mixed as (select a.section_id, list_transform(range(1, len(a.vector) + 1), lambda i: a.vector[i] * (50 - a.section_id % 50) + b.vector[i] * (a.section_id % 50)) m from
 (select e.section_id, c.vector from vec e join vec c on c.section_id = e.section_id // 50 * 50) a join (select e.section_id, c.vector from vec e join vec c on c.section_id = e.section_id // 50 * 50 + 50) b using (section_id)),
 mranked as (select mixed.section_id, p.section_id label, round(list_inner_product(list_transform(m, lambda x: x / sqrt(list_inner_product(m, m))), list_transform(p.vector, lambda x: x / sqrt(list_inner_product(p.vector, p.vector)))), 6) score from mixed cross join (select * from vec where section_id % 50 = 0) p),
 mtop as (select *, row_number() over (partition by section_id order by score desc, label) r from mranked)"""


@query("vec_status", f"""with {_VEC}, {_MIXED}, top as (select a.section_id, a.label, a.score, round(a.score - b.score, 6) margin from mtop a join mtop b using (section_id) where a.r = 1 and b.r = 2),
 more as (select section_id, string_agg(mtop.label::varchar, ',' order by r) secondary_labels from mtop join top using (section_id) where r between 2 and 5 and (mtop.score >= 0.68 or round(top.score - mtop.score, 6) <= 0.04) group by 1)
 select section_id, label classification, case when score < 0.72 then 'UNMAPPED' when margin < 0.02 then 'AMBIGUOUS' else 'SUCCESS' end status, coalesce(secondary_labels, '') secondary_labels from top left join more using (section_id)""")
def vec_status(spark: SparkSession, base: str) -> DataFrame:
    """Vectors between two of every fiftieth vector, classified by those: near one of them a success, midway ambiguous or unmapped."""
    unit = vectors(spark, base).select("section_id", vx.normalized(F.col("vector")).alias("vector"))
    own = F.floor(F.col("section_id") / 50) * 50
    bases = unit.filter("section_id % 50 = 0")
    ends = unit.select("section_id", own.alias("a"), (own + 50).alias("b"))
    ends = ends.join(bases.select(F.col("section_id").alias("a"), F.col("vector").alias("va")), "a").join(bases.select(F.col("section_id").alias("b"), F.col("vector").alias("vb")), "b")
    share = (F.col("section_id") % 50).cast("double")
    mixed = ends.select("section_id", F.zip_with("va", "vb", lambda x, y: x * (50 - share) + y * share).alias("vector"))
    protos = bases.select(F.col("section_id").alias("label"), vx.normalized(F.col("vector")).alias("prototype"))
    found = classify.classified(classify.scored(mixed, protos, digits=6, k=TOP_K))
    return found.select("section_id", "classification", "status", F.array_join(F.col("secondary_labels").cast("array<string>"), ",").alias("secondary_labels"))


@query("vec_dedup_best", f"""with {_VEC}, {_PROTO}, {_RANK}, {_CLS}, k as (select *, section_id % 7 document_id, row_number() over (partition by section_id % 7, classification order by confidence desc, section_id) r from cls)
 select section_id, document_id, case when classification in (1, 2) and r > 1 then 'OTHER_SECTION' else classification::varchar end classification from k""")
def vec_dedup_best(spark: SparkSession, base: str) -> DataFrame:
    rows = _classified(spark, base).withColumn("document_id", F.col("section_id") % 7).withColumn("classification", F.col("classification").cast("string"))
    return classify.best_of_each(rows, ["1", "2"]).select("section_id", "document_id", "classification")


# --- the published table, registry and sinks ---

_GOLD = f"""{_ENT}, one as (select protocol_id, section_id, min(classification) priority, min(category_domain) category_domain, max(confidence) confidence, string_agg(entity_text, ' ' order by entity_text) section_text from ent group by 1, 2),
 good as (select protocol_id, section_id, category_domain, confidence, section_text, case priority when '1-URGENT' then 'PRIMARY_ENDPOINT' when '2-HIGH' then 'LAB_TESTS' else 'OTHER_SECTION' end classification from one where confidence >= 0.9),
 gold as (select *, case when classification = 'PRIMARY_ENDPOINT' then 'HIGH' else 'STANDARD' end ner_priority, length(section_text) text_length, {_words("section_text")} word_count,
 count(*) over w protocol_total_sections, max(confidence) over w top from good where length(section_text) >= 10 window w as (partition by protocol_id))"""


def _gold(spark: SparkSession, base: str) -> DataFrame:
    rows = entities(spark, base).groupBy("protocol_id", "section_id").agg(F.min("classification").alias("p"), F.min("category_domain").alias("category_domain"), F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_list("entity_text")), " ").alias("section_text"))
    rows = rows.withColumn("classification", F.when(F.col("p") == "1-URGENT", "PRIMARY_ENDPOINT").when(F.col("p") == "2-HIGH", "LAB_TESTS").otherwise("OTHER_SECTION")).withColumn("status", F.when(F.col("confidence") >= 0.9, "SUCCESS").otherwise("UNMAPPED"))
    return gold.published(rows.drop("section_text", "p"), rows.select("protocol_id", "section_id", "section_text"))


@query("gold_classified_sections", f"""with {_GOLD} select protocol_id, section_id, classification, category_domain, ner_priority, case when classification = 'LAB_TESTS' then 'BIOMARKER,PATIENT_CRITERIA' when classification = 'PRIMARY_ENDPOINT' then 'ENDPOINT,ENDPOINT_TYPE' else 'CONDITION,DRUG,BIOMARKER' end expected,
 text_length, word_count, case when word_count > 200 then 'LONG' when word_count > 50 then 'MEDIUM' else 'SHORT' end section_complexity, category_domain || '_' || ner_priority ner_batch_key, protocol_total_sections from gold""")
def gold_classified_sections(spark: SparkSession, base: str) -> DataFrame:
    return _gold(spark, base).select("protocol_id", "section_id", "classification", "category_domain", "ner_priority", F.array_join("expected_entity_types", ",").alias("expected"), "text_length", "word_count", "section_complexity", "ner_batch_key", "protocol_total_sections")


@query("gold_batch_summary", f"with {_GOLD} select category_domain || '_' || ner_priority ner_batch_key, category_domain, ner_priority, count(*) section_count, avg(text_length) avg_text_length, avg(word_count) avg_word_count, count(distinct protocol_id) protocol_count from gold group by 1, 2, 3")
def gold_batch_summary(spark: SparkSession, base: str) -> DataFrame:
    return gold.batch_summary(_gold(spark, base))


@query("reg_status", "select source, count(*) documents, count(l.doc_id) labelled, min(d.doc_id) first_id, max(d.doc_id) last_id from documents d left join labels l using (doc_id) group by 1")
def reg_status(spark: SparkSession, base: str) -> DataFrame:
    labels = load(spark, base, "labels").select("doc_id", F.lit(1).alias("has"))
    return load(spark, base, "documents").join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("documents"), F.count("has").alias("labelled"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query("reg_tools", "with t as (select unnest(case when quality = 1 then ['digital'] when toxic = 1 then ['digital', 'fallback'] else ['digital', 'fallback', 'raw'] end) tool from labels) select tool, count(*) n from t group by 1")
def reg_tools(spark: SparkSession, base: str) -> DataFrame:
    def tools(*names: str):
        return F.array(*map(F.lit, names))

    used = F.when(F.col("quality") == 1, tools("digital")).when(F.col("toxic") == 1, tools("digital", "fallback")).otherwise(tools("digital", "fallback", "raw"))
    return load(spark, base, "labels").select(F.explode(used).alias("tool")).groupBy("tool").agg(F.count("*").alias("n"))


@query("reg_complete", """with s as (select o_custkey document_id, count(*) a, count(*) filter (o_orderstatus <> 'P') b from orders group by 1)
 select c_custkey document_id, case when a = b then 'DOCUMENT_PREPROCESSING_COMPLETE' else 'NEW' end processing_status from customer left join s on c_custkey = document_id""")
def reg_complete(spark: SparkSession, base: str) -> DataFrame:
    orders = load(spark, base, "orders").select(F.col("o_custkey").alias("document_id"), "o_orderstatus")
    registry = load(spark, base, "customer").select(F.col("c_custkey").alias("document_id"), F.lit("NEW").alias("processing_status"))
    return io.completed(registry, orders, orders.filter("o_orderstatus <> 'P'")).select("document_id", "processing_status")


@query("merge_upsert", """select p_partkey, case when p_size > 25 then p_name || '!' else p_name end p_name, p_size from part
 union all select -p_partkey, p_name || '!', p_size from part where p_size > 25""")
def merge_upsert(spark: SparkSession, base: str) -> DataFrame:
    """The whole part table in a stored table, into which rows come that change it and as many that are new.

    Rows are told apart by their number among those of a key, and new ones by a flag, so any keys will do: nought, negative ones whose opposite is there, null, or the same twice.
    """
    number = F.row_number().over(Window.partitionBy("p_partkey").orderBy("p_name", "p_size"))
    part = load(spark, base, "part").select("p_partkey", number.alias("number"), F.lit(False).alias("added"), "p_name", "p_size")
    path = io.shared_folder(spark)
    io.overwrite(part, path)
    large = spark.read.parquet(path).filter("p_size > 25").withColumn("p_name", F.concat("p_name", F.lit("!")))
    new = large.withColumns({"p_partkey": -F.col("p_partkey"), "added": F.lit(True)})
    io.merge_upsert(spark, path, large.union(new), ["p_partkey", "number", "added"], update=["p_name"])
    return spark.read.parquet(path).select("p_partkey", "p_name", "p_size")


@query("cls_having_correlated", "select o_custkey, count(*) n from orders o where o_orderstatus = 'F' group by 1 having count(*) = (select count(*) from orders p where p.o_custkey = o.o_custkey)")
def cls_having_correlated(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders").groupBy("o_custkey").agg(F.count("*").alias("all"), F.count_if(F.col("o_orderstatus") == "F").alias("n")).filter("n > 0 and n = all").select("o_custkey", "n")


# --- evaluation and tags ---


@query("eval_prf", """with p as (select quality::varchar t, toxic::varchar p from labels), l as (select distinct t l from p union select distinct p from p),
 e as (select l, (select count(*) from p where t = l) s, (select count(*) from p where p.p = l) g, (select count(*) from p where t = l and p.p = l) h from l),
 f as (select *, case when g > 0 then h / g else 0 end pr, case when s > 0 then h / s else 0 end re from e)
 select round(sum(pr * s) / sum(s), 9) "precision", round(sum(re * s) / sum(s), 9) recall, round(sum(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end * s) / sum(s), 9) f1, round(sum(h) / sum(s), 9) accuracy from f""")
def eval_prf(spark: SparkSession, base: str) -> DataFrame:
    out = evaluate.weighted_scores(load(spark, base, "labels"), "quality", "toxic")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("eval_class_weights", f"""with k as (select unnest([{", ".join(f"'{t}'" for t in BIO_TAGS)}]) label), t as (select {"case l_linenumber % 5 " + " ".join(f"when {i} then '{BIO_TAGS[i]}'" for i in range(4)) + " else 'O' end"} tag from lineitem),
 c as (select tag label, count(*) n from t group by 1), w as (select k.label, coalesce(n, 0) n, least(greatest((select count(*) from t) / ({len(BIO_TAGS)} * coalesce(n, 1)), 0.5), 10.0) r from k left join c using (label))
 select label, n, case when label like 'B-%' then r * 1.5 else r end weight from w""")
def eval_class_weights(spark: SparkSession, base: str) -> DataFrame:
    n = F.col("l_linenumber") % 5
    tag = F.lit("O")
    for i in range(4):
        tag = F.when(n == i, BIO_TAGS[i]).otherwise(tag)
    return evaluate.class_weights(load(spark, base, "lineitem").select(tag.alias("tag")), BIO_TAGS)


_PIECES = r'''pieces as (select conv_id, turn, text, unnest(regexp_extract_all(text, '\s*\S+')) piece, generate_subscripts(regexp_extract_all(text, '\s*\S+'), 1) i from conversations),
 placed as (select conv_id, turn, text, i, regexp_extract(piece, '\S+') word, sum(length(piece)) over (partition by conv_id, turn order by i) end_pos from pieces),
 ws as (select conv_id, turn, text, i, word, (end_pos - length(word))::int start_pos, end_pos::int end_pos, case when length(word) >= 6 and length(word) % 5 <> 0 then ''' + "([" + ", ".join(f"'{t}'" for t in ENTITY_TYPES) + "])[length(word) % 8 + 1] end entity_type from placed)"


def _tagged(spark: SparkSession, base: str) -> DataFrame:
    """Words of conversations as spans: every fifth of six characters or more, its type from its length."""
    words = ent.words_with_offsets(F.col("text"))
    long_ = F.filter(F.col("words"), lambda w: (F.length(w["word"]) >= 6) & (F.length(w["word"]) % 5 != 0))
    spans = F.transform(long_, lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.element_at(F.array(*map(F.lit, ENTITY_TYPES)), F.length(w["word"]) % 8 + 1).alias("label")))
    return load(spark, base, "conversations").select("conv_id", "turn", "text", words.alias("words")).withColumn("spans", spans)


@query("bio_encode", f"with {_PIECES}, l as (select conv_id, turn, string_agg(case when entity_type is null then 'O' else 'B-' || entity_type end, ' ' order by i) labels from ws group by 1, 2) select conv_id, turn, case when text is not null then coalesce(labels, '') end labels from conversations left join l using (conv_id, turn)")
def bio_encode(spark: SparkSession, base: str) -> DataFrame:
    rows = _tagged(spark, base)
    return rows.select("conv_id", "turn", F.array_join(ent.encoded_labels(F.col("words"), F.col("spans")), " ").alias("labels"))


def _decoded(spark: SparkSession, base: str, relaxed: bool) -> DataFrame:
    rows = _tagged(spark, base).withColumn("labels", ent.encoded_labels(F.col("words"), F.col("spans")))
    tokens = F.zip_with("words", "labels", lambda w, t: F.struct(t.alias("label"), w["start"].alias("start"), w["end"].alias("end"), F.lit(0.5).alias("confidence")))
    return rows.select("conv_id", "turn", F.inline(ent.decoded_spans(tokens, F.col("text"), relaxed)))


@query("bio_decode_strict", f"with {_PIECES} select conv_id, turn, word text, entity_type, start_pos, end_pos, 0.5::double confidence from ws where entity_type is not null")
def bio_decode_strict(spark: SparkSession, base: str) -> DataFrame:
    return _decoded(spark, base, relaxed=False)


@query("bio_decode_relaxed", f"""with {_PIECES}, r as (select *, i - row_number() over (partition by conv_id, turn, entity_type order by i) run from ws where entity_type is not null),
 s as (select conv_id, turn, entity_type, min(start_pos) start_pos, max(end_pos) end_pos, any_value(text) whole from r group by conv_id, turn, entity_type, run)
 select conv_id, turn, substr(whole, start_pos + 1, end_pos - start_pos) text, entity_type, start_pos, end_pos, 0.5::double confidence from s""")
def bio_decode_relaxed(spark: SparkSession, base: str) -> DataFrame:
    return _decoded(spark, base, relaxed=True)


@query("txt_highlight", rf"""with {_PIECES}, o as (select *, lag(end_pos, 1, 0) over (partition by conv_id, turn order by i) before from ws),
 l as (select conv_id, turn, string_agg(substr(text, before + 1, start_pos - before) || case when entity_type is null then word else '[' || word || '](' || entity_type || ')' end, '' order by i) m from o group by 1, 2)
 select conv_id, turn, case when m is null then text else m || regexp_extract(text, '\s*$') end marked from conversations left join l using (conv_id, turn)""")
def txt_highlight(spark: SparkSession, base: str) -> DataFrame:
    return _tagged(spark, base).select("conv_id", "turn", ent.highlighted(F.col("text"), F.col("spans")).alias("marked"))
