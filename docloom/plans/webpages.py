"""Registered queries over sections of web pages: types, levels, hierarchy, markdown, merging and chunks on real headings.

The pages' paragraphs are marked up by their length first (headings of three more levels, code, captions, footnotes, numbered lists), so that
every rule has rows; the markup is then read by ``sources.markup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.constants import LABEL_TYPES
from docloom.functions import embedding
from docloom.functions import text as tx
from docloom.functions import vectors as vx
from docloom.operators import structure
from docloom.plans.registry import _STRIP, _words, query
from docloom.sources import markup
from docloom.sources.tables import load

#: Paragraphs of so many characters, and the elements they become.
_BY_LENGTH = [(1, 50, "h2"), (51, 75, "h3"), (76, 100, "h4"), (101, 125, "pre"), (126, 150, "figcaption"), (151, 175, "aside"), (176, 200, "li"), (201, 220, "caption")]


def _element(name: str) -> tuple[str, str]:
    return ("<ol><li>", "</li></ol>") if name == "li" else (f"<{name}>", f"</{name}>")


def page_sections(spark: SparkSession, base: str) -> DataFrame:
    html = F.col("html")
    for low, high, name in _BY_LENGTH:
        begin, end = _element(name)
        html = F.regexp_replace(html, rf"<p>([^<>]{{{low},{high}}})</p>", f"{begin}$1{end}")
    return markup.page_sections(load(spark, base, "pages").select("page_id", html.alias("html")), "page_id", "html")


def _marked_sql() -> str:
    html = "html"
    for low, high, name in _BY_LENGTH:
        begin, end = _element(name)
        html = rf"regexp_replace({html}, '<p>([^<>]{{{low},{high}}})</p>', '{begin}\1{end}', 'g')"
    return html


_BLOCKS = ", ".join(f"'{b}'" for b in sorted(markup.BLOCKS))
_LABELS = "case tag " + " ".join(f"when '{e}' then '{LABEL_TYPES.get(label, 'paragraph')}'" for e, label in markup.ELEMENT_LABELS.items()) + " else 'paragraph' end"
_PSEC = rf"""marked as (select page_id, regexp_replace({_marked_sql()}, '<!--.*?-->|<style[^>]*>.*?</style>|<script[^>]*>.*?</script>', '', 'gs') html from pages),
 parts as (select page_id, unnest(a) part, generate_subscripts(a, 1) i from (select page_id, regexp_extract_all(html, '<[^>]*>[^<]*') a from marked)),
 tags as (select *, lower(regexp_extract(part, '^</?([a-zA-Z0-9!]+)', 1)) tag, part not like '</%' opens, case when part ilike '<br%' then chr(30) else '' end || regexp_extract(part, '>([^<]*)$', 1) piece from parts),
 numbered as (select *, sum(case when tag in ({_BLOCKS}) then 1 else 0 end) over (partition by page_id order by i rows unbounded preceding) block from tags),
 blocks as (select page_id, block, case when first(opens order by i) then first(tag order by i) else 'body' end tag, string_agg(piece, '' order by i) raw from numbered group by 1, 2),
 decoded as (select *, lag(tag) over (partition by page_id order by block) before, replace(replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') text from blocks),
 folded as (select *, case when tag = 'pre' then trim(replace(text, chr(30), chr(10)), chr(32) || chr(9) || chr(10) || chr(13) || chr(12))
  else array_to_string(list_filter(list_transform(string_split(text, chr(30)), lambda x: trim(regexp_replace(x, '[ \t\n\r\f]+', ' ', 'g'), ' ')), lambda x: x <> ''), chr(10)) end content_text from decoded),
 psec as (select page_id document_id, row_number() over (partition by page_id order by block)::integer sequence_number, {_LABELS} section_type, case when tag in ('h1', 'h2', 'h3', 'h4', 'h5', 'h6') then tag[2]::integer end heading_level,
  tag = 'li' and before = 'ol' enumerated, content_text, printf('%s_s%05d', page_id::varchar, row_number() over (partition by page_id order by block)) section_id from folded where content_text <> '')"""


@query("html_sections", f"with {_PSEC} select document_id, section_id, section_type, coalesce(heading_level, 0) heading_level, enumerated, md5(content_text) text_md5 from psec")
def html_sections(spark: SparkSession, base: str) -> DataFrame:
    return page_sections(spark, base).select("document_id", "section_id", "section_type", F.coalesce("heading_level", F.lit(0)).alias("heading_level"), "enumerated", F.md5(F.col("content_text").cast("binary")).alias("text_md5"))


@query("html_types", f"with {_PSEC} select section_type, coalesce(heading_level, 0) heading_level, count(*) n, count(distinct document_id) documents, sum(length(content_text))::bigint chars from psec group by 1, 2")
def html_types(spark: SparkSession, base: str) -> DataFrame:
    return page_sections(spark, base).groupBy("section_type", F.coalesce("heading_level", F.lit(0)).alias("heading_level")).agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("documents"), F.sum(F.length("content_text")).alias("chars"))


_POUT = f"""{_PSEC}, eff as (select *, case when section_type = 'heading' then coalesce(heading_level, 1) else heading_level end eff,
 section_type = 'heading' or heading_level is not null or (section_type in ('list_item', 'paragraph') and {_words('content_text')} < 15) is_heading from psec),
 tops as (select *, {', '.join(f"last_value(case when eff = {n} then section_id end ignore nulls) over w h{n}" for n in range(1, 5))} from eff window w as (partition by document_id order by sequence_number rows between unbounded preceding and current row)),
 tree as (select *, case when eff is null then coalesce(h4, h3, h2, h1) when eff = 2 then h1 when eff = 3 then h2 when eff = 4 then h3 end parent_section_id from tops)"""


@query("html_outline", f"""with recursive {_POUT}, path as (select document_id, section_id, parent_section_id, is_heading, eff, section_id hierarchy_path from tree where parent_section_id is null
 union all select t.document_id, t.section_id, t.parent_section_id, t.is_heading, t.eff, p.hierarchy_path || ' > ' || t.section_id from tree t join path p on t.document_id = p.document_id and t.parent_section_id = p.section_id)
 select document_id, section_id, parent_section_id, is_heading, coalesce(eff, 0) effective_level, hierarchy_path from path""")
def html_outline(spark: SparkSession, base: str) -> DataFrame:
    rows = structure.with_hierarchy(structure.ordered(page_sections(spark, base)))
    return rows.select("document_id", "section_id", "parent_section_id", "is_heading", F.coalesce("effective_level", F.lit(0)).alias("effective_level"), "hierarchy_path")


_T = _STRIP.format("content_text")
_PMD = f"""case when section_type in ('heading', 'title') then repeat('#', coalesce(heading_level, 1)) || ' ' || {_T} when section_type = 'list_item' then case when enumerated then '1. ' else '- ' end || {_T}
 when section_type = 'code' then '```' || chr(10) || {_T} || chr(10) || '```' when section_type in ('figure_caption', 'table_caption', 'caption') then '*' || {_T} || '*' when section_type = 'footnote' then '[^]: ' || {_T} else {_T} end"""


@query("html_markdown", f"with {_PSEC} select document_id, md5(string_agg({_PMD}, chr(10) || chr(10) order by sequence_number)) markdown_md5, count(*) sections from psec group by 1")
def html_markdown(spark: SparkSession, base: str) -> DataFrame:
    """Whole pages as markdown."""
    rows = page_sections(spark, base)
    made = rows.select("document_id", "sequence_number", tx.markdown(F.col("content_text"), F.col("section_type"), F.col("heading_level"), F.col("enumerated")).alias("md"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("sequence_number", "md"))), lambda x: x["md"])
    return made.groupBy("document_id").agg(F.md5(F.array_join(parts, "\n\n").cast("binary")).alias("markdown_md5"), F.count("*").alias("sections"))


_PMERGE = f"""{_POUT}, short as (select *, coalesce(parent_section_id, 'ROOT') up, section_type = 'paragraph' and {_words('content_text')} <= 200 short from tree),
 joins as (select *, case when short and coalesce(lag(short) over w, false) and lag(sequence_number) over w = sequence_number - 1 then 0 else 1 end fresh from short window w as (partition by document_id, up order by sequence_number)),
 runs as (select *, sum(fresh) over (partition by document_id order by sequence_number rows unbounded preceding) run from joins),
 merged as (select document_id, min(sequence_number) sequence_number, min_by(section_id, sequence_number) section_id, min_by(section_type, sequence_number) section_type, min_by(parent_section_id, sequence_number) parent_section_id,
  count(*) merged_count, string_agg(content_text, ' ' order by sequence_number) content_text from runs group by document_id, run)"""


def _merged(spark: SparkSession, base: str) -> DataFrame:
    return structure.merged_paragraphs(structure.with_hierarchy(structure.ordered(page_sections(spark, base))))


@query("html_merge", f"with {_PMERGE} select document_id, section_id, parent_section_id, merged_count, md5(content_text) text_md5 from merged")
def html_merge(spark: SparkSession, base: str) -> DataFrame:
    return _merged(spark, base).select("document_id", "section_id", "parent_section_id", "merged_count", F.md5(F.col("content_text").cast("binary")).alias("text_md5"))


#: Chunks of this query: paragraphs of more words than the first number, in chunks of the second.
_OVER, _MOST = 60, 40


def _folded_sql(column: str, name: str) -> str:
    return rf"""{name}_d as (select section_id, regexp_replace(regexp_replace({column}, '([.!?])\s+([A-Z])', '\1' || chr(30) || '\2', 'g'), '([.!?])\s*\n+', '\1' || chr(30), 'g') t from long_),
 {name}_u as (select section_id, unnest(s) x, generate_subscripts(s, 1) i from (select section_id, list_filter(list_transform(string_split(t, chr(30)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') s from {name}_d)),
 {name}_l as (select section_id, list({{done: [x], cur: len(regexp_split_to_array(x, '\s+'))}} order by i) a from {name}_u group by 1),
 {name}_c as (select section_id, list_reduce(a, lambda p, q: case when p.cur + q.cur > {_MOST} then {{done: list_concat(p.done, q.done), cur: q.cur}} else {{done: list_concat(list_slice(p.done, 1, len(p.done) - 1), [p.done[-1] || ' ' || q.done[1]]), cur: p.cur + q.cur}} end).done c from {name}_l)"""


@query("html_chunks", f"""with {_PMERGE}, md as (select *, replace(content_text, ',', ' ,') content_markdown, section_type = 'paragraph' and {_words('content_text')} > {_OVER} long_one from merged),
 long_ as (select * from md where long_one), {_folded_sql('content_text', 'plain')}, {_folded_sql('content_markdown', 'marked')},
 cut as (select document_id, sequence_number, unnest(range(1, greatest(len(p.c), len(m.c)) + 1)) chunk_index, section_id, p.c plain, m.c marked from long_ join plain_c p using (section_id) join marked_c m using (section_id)),
 every as (select document_id, sequence_number, section_id, null chunk_index, content_text, content_markdown from md where not long_one
  union all select document_id, sequence_number, section_id || '_c' || chunk_index, chunk_index, coalesce(plain[chunk_index], ''), coalesce(marked[chunk_index], '') from cut)
 select document_id, row_number() over (partition by document_id order by sequence_number, coalesce(chunk_index, 0), section_id)::integer section_order, section_id, coalesce(chunk_index, 0)::integer chunk_index, md5(content_text) text_md5, md5(content_markdown) markdown_md5 from every""")
def html_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Text and markdown of long merged paragraphs cut side by side, in the order of the page."""
    rows = _merged(spark, base).withColumn("content_markdown", F.replace("content_text", F.lit(","), F.lit(" ,")))
    made = structure.section_order(structure.chunked(rows, over=_OVER, most=_MOST))
    return made.select("document_id", "section_order", "section_id", F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"), *[F.md5(F.col(f"content_{c}").cast("binary")).alias(f"{c}_md5") for c in ("text", "markdown")])


@query("html_embeddings", f"""with {_POUT}, e as (select case when is_heading then 'title' else 'content' end embedding_type, {_words('content_text')} word_count from tree)
 select embedding_type, count(*) n, 64 vector_length, 0 zero_vectors, round(avg(word_count), 6) avg_word_count from e group by 1""")
def html_embeddings(spark: SparkSession, base: str) -> DataFrame:
    """Headings of pages through one model, the rest through another."""
    rows = structure.with_hierarchy(structure.ordered(page_sections(spark, base)))
    made = embedding.statistics(embedding.routed(rows, vx.hashed_embedding, vx.hashed_embedding))
    return made.withColumn("avg_word_count", F.round("avg_word_count", 6))
