"""Tables by name, and the shapes in which the engine sees the provided ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as tx


def load(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def line_sections(spark: SparkSession, base: str, lines_a_page: int = 5) -> DataFrame:
    """Sections of documents: a line each, five to a page."""
    docs = load(spark, base, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("i", "content_text"))
    docs = docs.withColumn("__plain", tx.stripped(F.col("content_text")))  # once, for all rules
    kind = tx.section_type(F.col("content_text"), F.col("__plain"))
    out = docs.select(F.col("doc_id").alias("document_id"), "source", (F.col("i") + 1).alias("sequence_number"), (F.floor(F.col("i") / lines_a_page) + 1).cast("int").alias("page_number"), "content_text", kind.alias("section_type"), "__plain")
    return out.withColumns({"section_id": tx.section_id(F.col("document_id"), F.col("sequence_number")), "heading_level": tx.heading_level(F.col("content_text"), F.col("section_type"), F.col("__plain"))}).drop("__plain")


def entities(spark: SparkSession, base: str) -> DataFrame:
    """Exploded entities, from the star schema.  Lines, the largest, move twice, by part and by order; customers meet orders first."""
    lines = load(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_discount")
    orders = load(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = load(spark, base, "part").select("p_partkey", "p_name", "p_type")
    customers = load(spark, base, "customer").select("c_custkey", "c_mktsegment")
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")
    out = named.join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
    return out.select(F.col("o_custkey").alias("protocol_id"), F.col("l_orderkey").alias("section_id"), F.col("o_orderpriority").alias("classification"), F.col("c_mktsegment").alias("category_domain"), F.col("p_name").alias("entity_text"), F.col("p_type").alias("entity_type"), (1 - F.col("l_discount")).alias("confidence"))


def vectors(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "embeddings").select(F.col("vec_id").alias("section_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
