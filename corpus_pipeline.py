"""A training-corpus pipeline: language ID, near duplicates, decontamination, surrogates, packing.

Every stage but the last returns the columns of documents, whatever they are; each works on all that the one before kept.

Defined results, for each stage: an empty table stays empty.  Repeated rows are judged alike, but of equal ones near_duplicates
keeps one.  Texts of any length are read whole.  Null and empty texts, and those without a letter, go in language_id, and only there;
the other stages keep them, and packing makes a piece of each.  Without any label, language_id drops only those.  Columns of
other names, those that an operator adds among them, pass through as they are; ``n_chars`` follows the text where there is one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import decontam, jaccard_join, langid, packing, pii
from docloom.llm.queries import pii_key, table, tokenizer
from docloom.llm.store import Table, put_back, scratch, set_aside


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go: those that language ID calls und, which have no letter; a null ``lang`` becomes the predicted one."""
    return langid.drop_unknown(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard_join.keep_one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars, if there is one, follows the text."""
    made = put_back(pii.replace_private(set_aside(docs, ("n_entities",)), pii_key(spark)), docs.columns, ("n_entities",))
    if "n_chars" not in docs.columns:
        return made
    return made.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    pieces = packing.token_pieces(docs, tokenizer("byte_bpe_50k.json"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("private_data", without_private_data),
    ("packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch():  # what a stage writes besides its result goes with it
            made = Table(stage(spark, docs, sf_dir), name).keep()
        if last is not None:
            last.drop()
        docs, last = made.df, made
    return STAGES[-1][1](spark, docs, sf_dir)
