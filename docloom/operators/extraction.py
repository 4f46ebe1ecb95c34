"""Rows that extraction derives: pages, sections, images, tables, formulas, and the registry of documents.

Items have ``document_id, sequence_number, page_number, section_type, content_text``.  All steps are expressions, or one
aggregation by document and page, which combines on the map side and needs no order of its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.constants import CONTEXT_CHARS, ERROR_CHARS, HEADER_TOP, PAGE_CHARS
from docloom.functions import text as tx

#: Types of the items that the counts of a page take.
COUNTED = {"images": ["figure"], "tables": ["table"], "formulas": ["equation"]}


def in_order(value: str, order: str = "sequence_number") -> Column:
    """The values of a group, in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value])


def pages(items: DataFrame, counted: dict[str, list[str]] = COUNTED) -> DataFrame:
    """Text of each page (empty on a table of contents) and how many items of each kind it has."""
    counts = [F.count_if(F.col("section_type").isin(kinds)).alias(f"{name}_count") for name, kinds in counted.items()]
    out = items.groupBy("document_id", "page_number").agg(F.array_join(in_order("content_text"), "\n").alias("text"), F.count("*").alias("section_count"), *counts)
    return out.withColumn("is_toc", tx.is_toc_page(F.col("text"))).withColumn("text", F.when(F.col("is_toc"), "").otherwise(F.col("text")))


def pages_from_sections(items: DataFrame, most: int = PAGE_CHARS) -> DataFrame:
    """Pages for a parser that gives none: their sections joined by lines, cut to ``most`` characters."""
    return items.groupBy("document_id", "page_number").agg(F.left(F.array_join(in_order("content_text"), "\n"), F.lit(most)).alias("text"), F.count("*").alias("section_count"))


def paragraph_sections(texts: DataFrame, key: str = "document_id", text: str = "text") -> DataFrame:
    """A section for each paragraph between blank lines, numbered from 1; blank ones go."""
    parts = F.filter(F.transform(F.split(F.col(text), "\n\n"), tx.stripped), lambda x: x != "")
    out = texts.select(F.col(key).alias("document_id"), F.posexplode(parts).alias("i", "content_text"))
    return out.select("document_id", (F.col("i") + 1).alias("sequence_number"), "content_text", F.lit("paragraph").alias("section_type"))


def item_sections(items: DataFrame) -> DataFrame:
    """Items that are not blank as sections with ids."""
    kept = items.filter(tx.stripped(F.col("content_text")) != "")
    return kept.withColumn("section_id", tx.section_id(F.col("document_id"), F.col("sequence_number")))


def page_sections(recognised: DataFrame) -> DataFrame:
    """One ``ocr_text`` section a page that has text."""
    kept = recognised.filter(tx.stripped(F.col("text")) != "")
    return kept.select("document_id", "page_number", F.col("page_number").alias("sequence_number"), F.lit("ocr_text").alias("section_type"), F.col("text").alias("content_text"))


def images(found: DataFrame, top: str = "bbox_y0") -> DataFrame:
    """Image rows with ids; ``is_above_header`` if the box begins near the top of its page."""
    return found.withColumns({"image_id": tx.image_id(F.col("document_id"), F.col("page_number"), F.col("image_number")), "is_above_header": F.coalesce(F.col(top) < HEADER_TOP, F.lit(False))})


def tables(parts: DataFrame) -> DataFrame:
    """Tables of parts on pages: their distinct pages, and whether they are several."""
    out = parts.groupBy("document_id", "table_id").agg(F.array_sort(F.collect_set("page_number")).alias("page_numbers"), F.count("*").alias("part_count"))
    return out.withColumn("spans_multiple_pages", F.size("page_numbers") > 1)


def formulas(items: DataFrame) -> DataFrame:
    """Equations with the beginning of their text as context."""
    return items.filter(F.col("section_type") == "equation").select("document_id", "page_number", F.format_string("%s_f%05d", F.col("document_id").cast("string"), "sequence_number").alias("formula_id"), F.left("content_text", F.lit(CONTEXT_CHARS)).alias("context"), F.lit(True).alias("needs_llm_processing"))


def errors(failed: DataFrame, stage: str) -> DataFrame:
    """Rows of what failed: stage, the message cut to its limit, and the whole report, if there is a column ``traceback``."""
    trace = F.col("traceback") if "traceback" in failed.columns else F.lit(None).cast("string")
    return failed.select("document_id", F.lit(stage).alias("error_stage"), F.left("error_message", F.lit(ERROR_CHARS)).alias("error_message"), trace.alias("traceback"))


def document_summary(pages: DataFrame) -> DataFrame:
    """A row for each document from its pages (``page_number``, ``is_toc``, ``error_message``, ``tool``, ``started``, ``ended``):
    pages, seconds, engine (the tool of most pages, ties to the first by name), and the numbers of contents and error pages."""
    tools = pages.groupBy("document_id", "tool").agg(F.count("*").alias("n")).groupBy("document_id").agg(F.min_by("tool", F.struct(-F.col("n"), "tool")).alias("engine"))
    out = pages.groupBy("document_id").agg(
        F.count_distinct("page_number").alias("page_count"), (F.unix_micros(F.max(F.col("ended").cast("timestamp"))) - F.unix_micros(F.min(F.col("started").cast("timestamp")))).alias("micros"),
        F.array_sort(F.collect_set(F.when(F.col("is_toc"), F.col("page_number")))).alias("toc_pages"),
        F.array_sort(F.collect_set(F.when(F.col("error_message").isNotNull(), F.col("page_number")))).alias("error_pages"),
    )
    return out.withColumn("duration_seconds", F.col("micros") / 1_000_000).drop("micros").join(tools, "document_id")


def registry(read: DataFrame) -> DataFrame:
    """The registry row of each document from rows of its pages: ``page_number`` (null: none), ``tool``, ``error_message``.

    A document is a success without errors, or with a page that could be read.
    """
    good = F.col("error_message").isNull() & F.col("page_number").isNotNull()
    out = read.groupBy("document_id").agg(F.count_if(good).alias("page_count"), F.count("error_message").alias("error_count"), F.array_sort(F.collect_set("tool")).alias("tools_used"), F.left(F.min("error_message"), F.lit(ERROR_CHARS)).alias("error_message"))
    return out.withColumn("processing_status", F.when((F.col("error_count") == 0) | (F.col("page_count") > 0), "SUCCESS").otherwise("FAILED"))
