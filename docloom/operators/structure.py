"""Document structure: noise, hierarchy, merging and chunking of ordered sections.

Sections have ``document_id, section_id, page_number, sequence_number, section_type, content_text, heading_level``; ``doc_order``
is their position in a document, ties settled by ``section_id``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.constants import CHUNK_OVER_WORDS, CHUNK_WORDS, HEADING_WORDS, MERGE_WORDS
from docloom.functions import text as tx


def repeated_noise(sections: DataFrame, share: float = 0.5, min_pages: int = 1) -> DataFrame:
    """``document_id, content_text`` of texts on more than a share of the distinct pages of their document."""
    pages = sections.groupBy("document_id").agg(F.count_distinct("page_number").alias("pages"))
    seen = sections.filter(F.trim("content_text") != "").groupBy("document_id", "content_text").agg(F.count_distinct("page_number").alias("on"))
    return seen.join(pages, "document_id").filter((F.col("pages") >= min_pages) & (F.col("on") > F.col("pages") * share)).select("document_id", "content_text")


def explicit_noise(pages: DataFrame) -> DataFrame:
    """Header and footer texts of pages."""
    header, footer = (pages.select("document_id", F.trim(c).alias("content_text")) for c in ("header_text", "footer_text"))
    return header.union(footer).filter("content_text != ''").distinct()


def without_noise(sections: DataFrame, noise: DataFrame) -> DataFrame:
    """Sections whose text is not noise of their document; a null text stays."""
    return sections.join(noise, ["document_id", "content_text"], "left_anti")


def ordered(sections: DataFrame) -> DataFrame:
    w = Window.partitionBy("document_id").orderBy("page_number", "sequence_number", "section_id")
    return sections.withColumn("doc_order", F.row_number().over(w))


def with_hierarchy(sections: DataFrame, strict: bool = False) -> DataFrame:
    """``is_heading``, ``effective_level``, ``parent_section_id`` and ``hierarchy_path``, of any depth.

    A heading's parent is the last heading one level up, other sections hang on the deepest level that has had a heading.
    Deeper levels outlive a new heading above them, unless ``strict``, which ends them.  The path holds the section ids from the highest
    ancestor down to the section's own, joined by " > ".  One shuffle by document and one pass in its order, which carries the last
    heading of each level and nothing else, so memory follows the levels of a document and not its length.  A null document is one.
    """
    kind, level = F.col("section_type"), F.col("heading_level")
    short = kind.isin("list_item", "paragraph") & (tx.word_count(F.col("content_text")) < HEADING_WORDS)
    out = sections.withColumn("is_heading", F.coalesce((kind == "heading") | level.isNotNull() | short, F.lit(False)))
    out = out.withColumn("effective_level", F.when(kind == "heading", F.coalesce(level, F.lit(1))).otherwise(level))
    made = T.StructType([*out.schema.fields, T.StructField("parent_section_id", out.schema["section_id"].dataType), T.StructField("hierarchy_path", T.StringType())])
    return out.repartition("document_id").sortWithinPartitions("document_id", "doc_order").mapInArrow(_outline(strict), made)


def _outline(strict: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, stack = object(), {}
        for batch in batches:
            parents, paths = [], []
            for doc, own, level in zip(*(batch.column(c).to_pylist() for c in ("document_id", "section_id", "effective_level")), strict=True):
                if doc != document:
                    document, stack = doc, {}  # level -> id and path of its last heading
                up = stack.get(level - 1) if level is not None else stack[max(stack)] if stack else None
                path = str(own) if up is None else f"{up[1]} > {own}"
                parents.append(up and up[0])
                paths.append(path)
                if level is not None and level >= 1:
                    stack[level] = (own, path)
                    if strict:
                        for deeper in [n for n in stack if n > level]:
                            del stack[deeper]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parents, batch.column("section_id").type), pa.array(paths, pa.string())], names=[*batch.schema.names, "parent_section_id", "hierarchy_path"])

    return run


def with_path(sections: DataFrame) -> DataFrame:
    """``hierarchy_path`` of any depth from given parents, which come before their children; a parent that does not is the top of its path.

    One pass in order of the document, which carries the paths of sections that have children.  What has a path keeps it.
    """
    if "hierarchy_path" in sections.columns:
        return sections
    made = T.StructType([*sections.schema.fields, T.StructField("hierarchy_path", T.StringType())])
    marked = with_leaf(sections.drop("is_leaf")).repartition("document_id").sortWithinPartitions("document_id", "doc_order")
    kept = [c for c in sections.columns if c != "is_leaf"]
    found = marked.select(*kept, "is_leaf").mapInArrow(_paths, T.StructType([*[made[c] for c in kept], T.StructField("is_leaf", T.BooleanType()), made["hierarchy_path"]]))
    return found.select(*made.names)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    document, known = object(), {}
    for batch in batches:
        paths = []
        for doc, own, up, leaf in zip(*(batch.column(c).to_pylist() for c in ("document_id", "section_id", "parent_section_id", "is_leaf")), strict=True):
            if doc != document:
                document, known = doc, {}
            paths.append(str(own) if up is None else f"{known.get(up, up)} > {own}")
            if not leaf:
                known[own] = paths[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.string())], names=[*batch.schema.names, "hierarchy_path"])


def with_leaf(sections: DataFrame) -> DataFrame:
    """``is_leaf``: no section of the document has it as its parent."""
    parents = sections.select("document_id", F.col("parent_section_id").alias("section_id")).filter("section_id is not null").distinct().withColumn("__has", F.lit(True))
    return sections.join(parents, ["document_id", "section_id"], "left").withColumn("is_leaf", F.col("__has").isNull()).drop("__has")


def merged_paragraphs(sections: DataFrame, most: int = MERGE_WORDS) -> DataFrame:
    """Runs of short paragraphs of one page and parent as one section each: all attributes of the first, joined text, how many."""
    near = Window.partitionBy("document_id", "page_number", F.coalesce("parent_section_id", F.lit("ROOT"))).orderBy("doc_order")
    short = (F.col("section_type") == "paragraph") & (tx.word_count(F.coalesce("content_text", F.lit(""))) <= most)
    out = sections.withColumn("__short", F.coalesce(short, F.lit(False)))
    joins = F.col("__short") & F.coalesce(F.lag("__short").over(near), F.lit(False)) & (F.lag("doc_order").over(near) == F.col("doc_order") - 1)
    out = out.withColumn("__new", F.when(joins, 0).otherwise(1))
    run = Window.partitionBy("document_id").orderBy("doc_order").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("merge_group", F.sum("__new").over(run))
    # The first section of a run gives all that is not made of the whole run.
    made = {"document_id", "merge_group", "page_number", "doc_order", "merged_count", "content_text", "__short", "__new"}
    first = F.min_by(F.struct(*[c for c in out.columns if c not in made]), "doc_order")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_order", F.coalesce("content_text", F.lit("")).alias("t")))), lambda x: x["t"])
    return out.groupBy("document_id", "merge_group").agg(first.alias("f"), F.min("page_number").alias("page_number"), F.min("doc_order").alias("doc_order"), F.count("*").alias("merged_count"), F.array_join(texts, " ").alias("content_text")).select("document_id", "merge_group", "f.*", "page_number", "doc_order", "merged_count", "content_text")


def chunked(sections: DataFrame, over: int = CHUNK_OVER_WORDS, most: int = CHUNK_WORDS) -> DataFrame:
    """Long paragraphs as chunks of whole sentences (``chunk_index`` from 1, ids with _c and it); others with a null index.

    Where there is a column ``content_markdown``, it is cut by the same rule; the two are set side by side, and where one has fewer
    chunks it is empty.
    """
    marked = "content_markdown" in sections.columns
    long_ = F.coalesce((F.col("section_type") == "paragraph") & (tx.word_count(F.col("content_text")) > over), F.lit(False))
    texts = ["content_text", "content_markdown"] if marked else ["content_text"]
    rest = [c for c in sections.columns if c not in ("section_id", *texts)]
    whole = F.array(F.struct(*[F.col(c).alias(c) for c in texts]))
    parts = F.when(F.col("__long"), tx.chunk_pairs(F.col("content_text"), F.col("content_markdown") if marked else None, most)).otherwise(whole)
    out = sections.withColumn("__long", long_).select(*rest, F.col("section_id").alias("__id"), "__long", F.posexplode(parts).alias("__i", "__part"))
    index = F.when(F.col("__long"), F.col("__i") + 1)
    return out.select(*rest, F.when(F.col("__long"), F.concat("__id", F.lit("_c"), index)).otherwise(F.col("__id")).alias("section_id"), *[F.col(f"__part.{c}").alias(c) for c in texts], index.alias("chunk_index"))


def section_order(sections: DataFrame) -> DataFrame:
    """``section_order``: place in the document by page, sequence and chunk, ties by id."""
    w = Window.partitionBy("document_id").orderBy("page_number", "sequence_number", F.coalesce("chunk_index", F.lit(0)), "section_id")
    return sections.withColumn("section_order", F.row_number().over(w))


def stacked(parts: list[DataFrame]) -> DataFrame:
    """Tables one below the other, columns by name; what one lacks is null."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def unique_by(rows: DataFrame, key: str = "section_id") -> DataFrame:
    """One row for each key: the one whose other columns sort first, so the choice repeats."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("__one")).select(*[F.col(key) if c == key else F.col(f"__one.{c}") for c in rows.columns])


def repeated_keys(rows: DataFrame, key: str = "section_id") -> DataFrame:
    """Keys that several rows have, and how many."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def empty_like(rows: DataFrame) -> DataFrame:
    """No rows, with the columns of a table; nothing is read."""
    return rows.sparkSession.createDataFrame([], rows.schema)
