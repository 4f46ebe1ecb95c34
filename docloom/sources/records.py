"""Results of extraction, one JSON document each, as seven child tables: one scan, rows tagged by kind, one partitioned write.

Records come in many shapes: other names for a field, numbers as texts, boxes nested or flat, a list or a single text.  Each is a VARIANT, and a field is
the first of its names (paths) that holds something of its type, or its default; what has another type is as if it were not there.

Defined results: a body that is null or no JSON object, and elements that are no objects, give no rows, nor does a missing or empty list; a registry is one object.  Unknown fields
are left out.  A flag is false if it is missing, false, 0, an empty text or the text "false".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as tx

# Kinds of records, and for each the fields with their type, names in order, and default.
PATHS = ["source_path", "source_pdf", "path"]
PLACE = {"page_number": ("int", ["page_number", "page"], 0)}
KINDS: dict[str, dict[str, tuple[str, list[str], object]]] = {
    "pages": PLACE | {"text": ("string", ["text"], ""), "has_header": ("boolean", ["has_header"], False), "has_footer": ("boolean", ["has_footer"], False), "header_text": ("string", ["header_text"], ""), "footer_text": ("string", ["footer_text"], "")},
    "sections": PLACE
    | {
        "section_id": ("string", ["section_id", "id"], ""), "sequence_number": ("int", ["sequence_number", "seq"], 0), "section_type": ("string", ["section_type", "type"], ""),
        "content_text": ("string", ["content_text", "text", "content"], ""), "content_markdown": ("string", ["content_markdown", "markdown"], ""), "heading_level": ("int", ["heading_level"], None),
        "is_strikethrough": ("boolean", ["is_strikethrough"], False), "is_toc": ("boolean", ["is_toc"], False), "extracted_at": ("string", ["extracted_at", "extracted_ts"], None),
    }
    | {f"bbox_{c}": ("double", [f"bbox.{c}", f"bbox_{c}"], None) for c in ("x0", "y0", "x1", "y1")},
    "images": PLACE | {"image_id": ("string", ["image_id", "id"], ""), "image_format": ("string", ["format", "image_format"], ""), "image_path": ("string", ["image_path", "path"], None)},
    "tables": PLACE | {"table_id": ("string", ["table_id", "id"], ""), "html": ("string", ["html", "table_html"], "")},
    "formulas": PLACE | {"formula_id": ("string", ["formula_id", "id"], ""), "content": ("string", ["content", "latex"], "")},
    "errors": {"error_stage": ("string", ["error_stage", "stage"], ""), "error_message": ("string", ["error_message", "message"], "")},
    "registry": {
        "processing_status": ("string", ["processing_status"], "failed"), "page_count": ("int", ["page_count"], 0), "error_count": ("int", ["error_count"], 0),
        "processed_at": ("string", ["processed_at"], None), "tools_used": ("array<string>", ["tools_used"], None), "error_message": ("string", ["error_message"], ""),
    },
}
KEYS = ["source_path", "protocol_id", "document_id"]


#: All names of fields, read as texts by one pass over a record; what has two forms stays a variant.
_SHAPE: dict[str, dict[str, object]] = {}
for _name in [*PATHS, "document_id", "doc_id", *(n for spec in KINDS.values() for _, names, _ in spec.values() for n in names)]:
    _at = _SHAPE
    for _step in _name.split("."):
        _at = _at.setdefault(_step, {})
_VARIANTS = {n for spec in KINDS.values() for kind, names, _ in spec.values() if kind.startswith("array") for n in names}


def _shape(names: dict) -> str:
    return "struct<" + ",".join(f"{n}:{'variant' if n in _VARIANTS else _shape(inner) if inner else 'string'}" for n, inner in names.items()) + ">"


def _field(record: Column, kind: str, names: list[str], default: object) -> Column:
    values = [F.col("record." + n) for n in names]
    if kind == "array<string>":
        lists = [F.try_variant_get(v, "$", "array<string>") for v in values]
        texts = [F.try_variant_get(v, "$", "string") for v in values]
        return F.coalesce(*lists, *[F.when(t != "", F.array(t)) for t in texts], F.array().cast(kind))
    if kind == "boolean":
        return F.coalesce(*[F.when(t != "", ~t.isin("false", "0", "0.0")) for t in values], F.lit(default))
    if kind == "string":
        return F.coalesce(*[F.when(t != "", t) for t in values], F.lit(default).cast(kind))
    return F.coalesce(*[F.nullif(F.trim(t), F.lit("")).try_cast(kind) for t in values], F.lit(default).cast(kind))


def tagged(results: DataFrame, body: str = "body") -> DataFrame:
    """``kind`` and the fields of all kinds of each record; those that a kind does not have are null."""
    whole = results.select(F.try_parse_json(F.col(body)).alias("__v"))
    shape = _shape(_SHAPE)
    none = F.array().cast(f"array<{shape}>")
    lists = [F.coalesce(F.try_variant_get("__v", f"$.{kind}", f"array<{shape}>"), none) for kind in KINDS if kind != "registry"]
    lists.append(F.array(F.try_variant_get("__v", "$.registry", shape)))

    def named(kind: str, list_: Column) -> Column:
        return F.transform(list_, lambda r: F.struct(F.lit(kind).alias("kind"), r.alias("record")))

    every = F.concat(*map(named, KINDS, lists))
    rows = whole.select(F.explode(every).alias("x")).select("x.*").filter("record is not null")  # what is no object
    record = F.col("record")
    path = F.coalesce(tx.normalized_path(_field(record, "string", PATHS, "")), F.lit(""))
    rows = rows.withColumn("source_path", path).withColumn("protocol_id", tx.document_id(F.col("source_path")))
    rows = rows.withColumn("document_id", F.coalesce(F.nullif(record["document_id"], F.lit("")), F.nullif(F.col("protocol_id"), F.lit("")), record["doc_id"]))
    fields: dict[str, Column] = {}
    for kind, spec in KINDS.items():
        for name, (type_, names, default) in spec.items():
            value = F.when(F.col("kind") == kind, _field(record, type_, names, default))
            fields[name] = F.coalesce(fields[name], value) if name in fields else value
    return rows.select("kind", *KEYS, *[c.alias(n) for n, c in fields.items()])


def write_children(results: DataFrame, path: str, body: str = "body") -> dict[str, int]:
    """Writes the child tables beneath ``path``, partitioned by kind, in one pass over ``results``; returns how many rows each has."""
    seen = Observation("records")
    rows = tagged(results, body).observe(seen, *[F.count_if(F.col("kind") == kind).alias(kind) for kind in KINDS])
    rows.hint("rebalance", "kind").write.partitionBy("kind").parquet(path)
    return {kind: seen.get[kind] for kind in KINDS}


def child(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """One child table, with its own columns; only its partition is read."""
    return spark.read.parquet(path).filter(F.col("kind") == kind).select(*KEYS, *KINDS[kind])
