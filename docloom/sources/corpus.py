"""Annotated texts: the JSON of labelling tools, and training rows made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import entities as ent

_SCHEMA = """id long, data struct<text:string>,
 annotations array<struct<result:array<struct<type:string,value:struct<start:int,end:int,labels:array<string>>>>>>"""


def annotated_texts(spark: SparkSession, path: str) -> DataFrame:
    """``id, text, spans`` (start, end, label, in order of start) of tasks; only the first annotation of a task counts."""
    tasks = spark.read.schema(_SCHEMA).option("multiLine", True).json(path)
    result = F.coalesce(F.get("annotations", 0)["result"], F.array())
    marks = F.filter(result, lambda r: (r["type"] == "labels") & r["value"].isNotNull())
    spans = F.transform(marks, lambda r: F.struct(r["value"]["start"].alias("start"), r["value"]["end"].alias("end"), F.get(r["value"]["labels"], 0).alias("label")))
    return tasks.select("id", F.col("data.text").alias("text"), F.array_sort(spans).alias("spans"))


def api_entities(responses: DataFrame, body: str = "body") -> DataFrame:
    """A row for each entity of a service's JSON answers (``{"entities": [{"text", "label", "start", "end", "score"}]}``); a broken answer has none."""
    schema = "entities array<struct<text:string,label:string,start:int,end:int,score:double>>"
    rest = [c for c in responses.columns if c != body]
    return responses.select(*rest, F.inline(F.from_json(F.col(body), schema)["entities"]))


def training_rows(texts: DataFrame) -> DataFrame:
    """``texts`` with ``tokens`` and their ``ner_tags``."""
    words = ent.words_with_offsets(F.col("text"))
    out = texts.withColumn("__words", words)
    return out.withColumns({"tokens": F.transform("__words", lambda w: w["word"]), "ner_tags": ent.encoded_labels(F.col("__words"), F.col("spans"))}).drop("__words")


def label_counts(rows: DataFrame) -> DataFrame:
    """Tokens of each type over tags, whatever their prefix; O is none."""
    tags = rows.select(F.explode("ner_tags").alias("tag")).filter("tag <> 'O'")
    return tags.groupBy(F.substring("tag", 3, 1000).alias("entity_type")).agg(F.count("*").alias("n"))
