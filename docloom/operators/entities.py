"""Entity operators: spans from tags, catalog, summaries, co-occurrence.

Exploded entities have ``protocol_id, section_id, classification, category_domain, entity_text, entity_type, confidence``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from html import escape
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from docloom.sources.io import shared_folder


def mean(c: str) -> Column:
    """Average of a score, summed in trillionths as decimals, so the result does not depend on the order of rows."""
    return F.sum(F.col(c).cast("decimal(28,12)")).cast("double") / F.count(c)


def joined_set(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",")


def normalized(entities: DataFrame) -> DataFrame:
    return entities.withColumn("entity_norm", F.lower(F.trim("entity_text")))


def exploded(sections: DataFrame) -> DataFrame:
    """One row for each span of ``entities``."""
    rest = [c for c in sections.columns if c != "entities"]
    return sections.filter(F.size("entities") > 0).select(*rest, F.inline("entities"))


def catalog(entities: DataFrame) -> DataFrame:
    """Distinct entities with where they occur; ``protocol_list`` and ``text_variants`` are sorted.

    Entities are written once to the shared folder.  What is counted of an entity comes from a grouping of its own, each over the columns it needs, so no row is
    repeated for each distinct count; the parts are put together by entity, of which they have a row each.
    """
    spark, path, e = entities.sparkSession, shared_folder(entities.sparkSession), ["entity_norm", "entity_type"]
    normalized(entities).write.parquet(path)
    rows = spark.read.parquet(path)
    score = F.col("confidence").cast("decimal(28,12)")
    each = rows.groupBy(*e, "classification", "category_domain", "entity_text").agg(F.count("*").alias("n"), F.sum(score).alias("s"), F.count("confidence").alias("k"), F.min("confidence").alias("low"), F.max("confidence").alias("high"))
    stats = each.groupBy(*e).agg(
        F.sum("n").alias("occurrence_count"), (F.sum("s").cast("double") / F.sum("k")).alias("avg_confidence"), F.min("low").alias("min_confidence"), F.max("high").alias("max_confidence"),
        joined_set("classification").alias("found_in_classifications"), joined_set("category_domain").alias("found_in_domains"),
        F.min("entity_text").alias("canonical_text"), F.sort_array(F.collect_set("entity_text")).alias("text_variants"),
    )
    places = {c: rows.filter(F.col(c).isNotNull()).select(*e, c).distinct().groupBy(*e) for c in ("section_id", "protocol_id")}
    sections = places["section_id"].agg(F.count("*").alias("section_count"))
    protocols = places["protocol_id"].agg(F.sort_array(F.collect_list("protocol_id")).alias("protocol_list"))
    ranks = with_rank(rows.groupBy(*e).agg(F.count("*").alias("occurrence_count"))).select(*e, "rank_in_type")
    parts = stats.unionByName(sections, True).unionByName(protocols, True).unionByName(ranks, True)
    out = parts.groupBy(*e).agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns if c not in e])
    out = out.withColumns({"section_count": F.coalesce("section_count", F.lit(0)), "protocol_list": F.coalesce("protocol_list", F.array().cast(parts.schema["protocol_list"].dataType))})
    return out.select(
        "entity_type", "occurrence_count", "entity_norm", F.size("protocol_list").cast("long").alias("protocol_count"), "section_count", "avg_confidence", "min_confidence", "max_confidence", "found_in_classifications", "found_in_domains",
        "canonical_text", F.size("text_variants").cast("long").alias("variant_count"), "protocol_list", "text_variants", "rank_in_type", F.concat_ws("_", "entity_type", F.md5("entity_norm")).alias("entity_id"),
    )


def with_rank(rows: DataFrame, prefix: int = 3) -> DataFrame:
    """``rank_in_type`` by count, then text.  A type is ranked in groups of equal counts and beginnings of texts: how many rows the
    groups before one hold is summed over groups, so no task sorts a whole type."""
    keys = ["entity_type", "occurrence_count", "__prefix"]
    rows = rows.withColumn("__prefix", F.substring("entity_norm", 1, prefix))
    groups = rows.groupBy(*keys).agg(F.count("*").alias("__many"))
    before = Window.partitionBy("entity_type").orderBy(F.desc("occurrence_count"), "__prefix").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(*keys, F.coalesce(F.sum("__many").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*keys).orderBy("entity_norm"))
    same = reduce(and_, [rows[k].eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    ranked = rows.withColumn("__own", own).join(groups.withColumnsRenamed({k: f"__g_{k}" for k in keys}), same)
    return ranked.withColumn("rank_in_type", (F.col("__before") + F.col("__own")).cast("int")).drop("__prefix", "__own", "__before", *[f"__g_{k}" for k in keys])


def type_counts(entities: DataFrame, key: str = "protocol_id") -> DataFrame:
    """Type to count as a map, and as text sorted by type."""
    each = entities.groupBy(key, "entity_type").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("entity_type", "n")))
    out = each.groupBy(key).agg(pairs.alias("p"))
    return out.select(key, F.map_from_entries("p").alias("entity_type_counts"), F.array_join(F.transform("p", lambda x: F.concat_ws("=", x["entity_type"], x["n"])), ",").alias("type_counts"))


def protocol_summary(entities: DataFrame) -> DataFrame:
    """Counts of each protocol.  Its rows meet once; the first row of each value is marked in order of the value, so nothing is repeated or held for distinct counts."""
    counted = {"unique_entities": "entity_norm", "unique_entity_types": "entity_type", "unique_classifications": "classification", "unique_domains": "category_domain"}
    rows = normalized(entities).select("protocol_id", "confidence", *counted.values()).repartition("protocol_id")
    for c in counted.values():
        own = Window.partitionBy("protocol_id", c).orderBy(c)
        rows = rows.withColumn(f"__{c}", F.when(F.col(c).isNotNull() & (F.row_number().over(own) == 1), 1))
    first = {name: F.count(f"__{c}").alias(name) for name, c in counted.items()}
    out = rows.groupBy("protocol_id").agg(F.count("*").alias("total_entities"), first["unique_entities"], first["unique_entity_types"], mean("confidence").alias("avg_entity_confidence"), first["unique_classifications"], first["unique_domains"])
    return out.withColumn("entity_density", F.col("unique_entities") / F.col("total_entities"))


_SECTION = ["protocol_id", "section_id", "classification"]


def _in_sections(entities: DataFrame) -> DataFrame:
    """Entities in sections that have all their keys; others meet nothing."""
    return normalized(entities).dropna(subset=_SECTION).select(*_SECTION, "entity_norm", "entity_type")


def _met(sections: DataFrame, own: bool) -> DataFrame:
    """``a`` and ``b``: each element of a section's sorted list with those after it, and with itself if ``own``."""
    at = sections.select(*_SECTION, "list", F.posexplode("list").alias("i", "a"))
    return at.select(*_SECTION, "a", F.explode(F.slice("list", F.col("i") + (1 if own else 2), F.size("list"))).alias("b"))


_PAIR = ["entity1", "entity2", "type1", "type2"]


def _pair() -> list[Column]:
    return [F.col(f"{x}.{c}").alias(f"{name}{n}") for name, c in (("entity", "entity_norm"), ("type", "entity_type")) for n, x in ((1, "a"), (2, "b"))]


def pairs(entities: DataFrame) -> DataFrame:
    """All unordered pairs of a section's entities, the smaller text first (type settles ties).

    A pair row is the operator's output, so a section's pairs are as many as asked for; they are made one by one from the list of its entities,
    which is in memory, while pairs are not.
    """
    lists = _in_sections(entities).groupBy(*_SECTION).agg(F.sort_array(F.collect_list(F.struct("entity_norm", "entity_type"))).alias("list"))
    return _met(lists, own=False).select(*_SECTION, *_pair())


def cooccurrence(entities: DataFrame) -> DataFrame:
    """How often two entities share a section.  Repeats in a section are counted before they meet, so they do not multiply rows.

    Pairs never move: they are made where all rows of a protocol are, and again where all of a section are, so protocols and sections are counted in place and
    only sums by pair are dealt out.
    """
    rows = _in_sections(entities)

    def met(key: str) -> DataFrame:
        each = rows.repartition(key).groupBy(*_SECTION, "entity_norm", "entity_type").agg(F.count("*").alias("c"))
        lists = each.groupBy(*_SECTION).agg(F.sort_array(F.collect_list(F.struct("entity_norm", "entity_type", "c"))).alias("list"))
        same = (F.col("a.entity_norm").eqNullSafe(F.col("b.entity_norm"))) & (F.col("a.entity_type").eqNullSafe(F.col("b.entity_type")))
        many = F.when(same, F.expr("a.c * (a.c - 1) div 2")).otherwise(F.col("a.c") * F.col("b.c"))
        return _met(lists, own=True).select(*_SECTION, *_pair(), many.alias("many")).filter("many > 0")

    by_class = met("protocol_id").groupBy(*_PAIR, "classification").agg(F.sum("many").alias("many"))
    protocols, sections = (met(key).select(*_PAIR, key).distinct().groupBy(*_PAIR).agg(F.count("*").alias(name)) for key, name in (("protocol_id", "protocol_count"), ("section_id", "section_count")))
    parts = by_class.unionByName(protocols, True).unionByName(sections, True)
    return parts.groupBy(*_PAIR).agg(F.sum("many").alias("cooccurrence_count"), F.max("protocol_count").alias("protocol_count"), F.max("section_count").alias("section_count"), joined_set("classification").alias("cooccurring_in"))


def category_distribution(entities: DataFrame, top: int = 10) -> DataFrame:
    keys = ["classification", "category_domain", "entity_type"]
    rows = normalized(entities)
    stats = rows.groupBy(*keys).agg(F.count("*").alias("entity_count"), F.count_distinct("entity_norm").alias("unique_entities"), F.count_distinct("protocol_id").alias("protocol_count"), mean("confidence").alias("avg_confidence"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), "entity_norm")
    best = rows.groupBy(*keys, "entity_norm").agg(F.count("*").alias("n")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top)
    names = best.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "entity_norm"))), lambda x: x["entity_norm"]), ",").alias("top_entities"))
    return stats.join(names, keys)


def top_per_type(entities: DataFrame, types: int = 5, top: int = 10) -> DataFrame:
    """The most frequent texts of the most frequent types, in one query."""
    each = normalized(entities).groupBy("entity_type", "entity_norm").agg(F.count("*").alias("n"))
    kinds = each.groupBy("entity_type").agg(F.sum("n").alias("type_total")).orderBy(F.desc("type_total"), "entity_type").limit(types)
    w = Window.partitionBy("entity_type").orderBy(F.desc("n"), "entity_norm")
    best = each.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return best.join(F.broadcast(kinds), "entity_type").select("entity_type", "type_total", "entity_norm", "n", "rank")


def type_distribution(entities: DataFrame) -> DataFrame:
    return normalized(entities).groupBy("entity_type").agg(F.count("*").alias("entity_count"), mean("confidence").alias("avg_confidence"), F.count_distinct("entity_norm").alias("unique_entities"))


# --- spans and tags: one pass over each row's words, in Arrow batches, so that work follows the length of a text ---

WORD = "struct<word:string,start:int,end:int>"
TOKEN = "struct<label:string,start:int,end:int,confidence:double>"
SPAN = "struct<text:string,entity_type:string,start_pos:int,end_pos:int,confidence:double>"
#: White space as the JVM's expressions know it.
_BLANK = " \t\n\x0b\f\r"
_WORDS = re.compile(f"[^{_BLANK}]+")


def arrow_type(ddl: str) -> pa.DataType:
    return to_arrow_type(_parse_datatype_string(ddl))


def by_row(kind: str, run: Callable, *columns: Column) -> Column:
    """A function of a row's Python values over Arrow batches; null if its first value is."""
    made = arrow_type(kind)

    @F.arrow_udf(kind)
    def apply(*arrays: pa.Array) -> pa.Array:
        parts = [pa.array([], made)]
        for at, many in slices(arrays):
            rows = zip(*(a.slice(at, many).to_pylist() for a in arrays), strict=True)
            parts.append(pa.array([None if r[0] is None else run(*r) for r in rows], made))
        return pa.concat_arrays(parts)

    return apply(*columns)


def slices(arrays: Sequence[pa.Array], most: int = 256, most_bytes: int = 262_144) -> Iterator[tuple[int, int]]:
    """Beginnings and sizes of runs of rows that are made Python values together, which take many times the bytes of Arrow's: by the mean bytes of a row."""
    n = len(arrays[0])
    many = max(1, min(most, most_bytes * n // max(1, sum(a.nbytes for a in arrays))))
    for at in range(0, n, many):
        yield at, min(many, n - at)


def list_array(counts: list[int], missing: list[bool], kind: pa.ListType, **fields: list | np.ndarray | pa.Array) -> pa.Array:
    """An array of lists of structs from the fields of all their elements, in order, and how many each list has."""
    element = kind.value_type
    columns = [pa.array(v, f.type) if not isinstance(v, pa.Array) else v.cast(f.type) for v, f in zip(fields.values(), element, strict=True)]
    ends = pa.array(np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, fields=list(element)), mask=pa.array(missing, pa.bool_()))


def words_in(text: str) -> Iterator[re.Match]:
    return _WORDS.finditer(text)


def words_of(text: str) -> list[dict]:
    return [{"word": m.group(), "start": m.start(), "end": m.end()} for m in words_in(text)]


def _spans(tokens: pa.Array, texts: pa.Array, relaxed: bool, made: pa.ListType) -> pa.Array:
    """Spans of rows; only tokens that are neither empty nor O are looked at one by one."""
    flat = tokens.flatten()
    label = flat.field("label").dictionary_encode()
    names = label.dictionary.to_pylist()
    marks = np.array([name[:2] in ("B-", "I-") for name in names] or [False])
    code = label.indices.to_numpy(zero_copy_only=False)
    start, end = (flat.field(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("start", "end"))
    whole = start != end
    # A token's number among those that are not empty: a span goes on only at the next one.
    number = np.cumsum(whole)
    owner = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    looked = np.flatnonzero(whole & marks[code]) if len(code) else np.empty(0, np.int64)
    counts = [0] * len(tokens)
    kinds, starts, ends, shares, rows = [], [], [], [], []
    last = (-1, -1, "")  # row, number, kind
    sure = flat.field("confidence").take(pa.array(looked)).to_pylist()
    for row, n, c, a, b, x in zip(*(v[looked].tolist() for v in (owner, number, code, start, end)), sure, strict=True):
        mark, kind = names[c][:2], names[c][2:]
        if last == (row, n - 1, kind) and (relaxed or mark == "I-"):
            ends[-1], shares[-1] = b, (shares[-1] + x) / 2
        else:
            kinds.append(kind), starts.append(a), ends.append(b), shares.append(x), rows.append(row)
            counts[row] += 1
        last = (row, n, kind)
    found, at, shown = -1, "", []
    for row, a, b in zip(rows, starts, ends, strict=True):
        if row != found:
            found, at = row, texts[row].as_py() or ""
        shown.append(at[a:b])
    return list_array(counts, tokens.is_null().to_pylist(), made, text=shown, entity_type=kinds, start_pos=starts, end_pos=ends, confidence=shares)


def tags_of(words: list[dict], spans: list[dict] | None) -> list[str]:
    out: list[str] = []
    marks = sorted(enumerate(spans or []), key=lambda x: x[1]["start"])
    live: list[tuple[int, dict]] = []
    at = 0
    for w in words:
        while at < len(marks) and marks[at][1]["start"] <= w["start"]:
            live.append(marks[at])
            at += 1
        live = [x for x in live if x[1]["end"] > w["start"]]
        if not live:
            out.append("O")
            continue
        last = max(live, key=lambda x: x[0])[1]  # later spans overwrite earlier ones
        begins = last["start"] == w["start"] or not out or out[-1] == "O"
        out.append(("B-" if begins else "I-") + last["label"])
    return out


def marked_of(text: str, spans: list[dict] | None, html: bool) -> str:
    out, at = [], 0
    plain = escape if html else str
    for s in sorted(spans or [], key=lambda s: (s["start"], s["end"], s["label"])):
        inside = plain(text[s["start"] : s["end"]])
        made = f'<mark class="entity" data-type="{plain(s["label"])}">{inside}</mark>' if html else f"[{inside}]({s['label']})"
        out += [plain(text[at : s["start"]]) if at <= s["start"] else "", made]
        at = s["end"]
    return "".join([*out, plain(text[at:])])


def decoded_spans(tokens: Column, text: Column, relaxed: bool = False) -> Column:
    """Spans from an array of (label, start, end, confidence) in order.

    A B- tag begins a span and an I- tag of the same type extends it; relaxed, a B- tag of the same type extends as well.  O, or
    another type, ends it.  A span's confidence is folded as the mean of what it has and the next.  Empty tokens are skipped.
    """
    kind = arrow_type(f"array<{SPAN}>")

    @F.arrow_udf(f"array<{SPAN}>")
    def decode(tags: pa.Array, texts: pa.Array) -> pa.Array:
        parts = [_spans(tags.slice(at, many), texts.slice(at, many), relaxed, kind) for at, many in slices((tags, texts), 4_096, 4_000_000)]
        return pa.concat_arrays([pa.array([], kind), *parts])

    return decode(tokens, text)


def words_with_offsets(text: Column) -> Column:
    """Words between white space as (word, start, end)."""

    kind = arrow_type(f"array<{WORD}>")

    @F.arrow_udf(f"array<{WORD}>")
    def split(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for at, many in slices((texts,)):
            part = texts.slice(at, many)
            found = [[(m.group(), *m.span()) for m in words_in(x or "")] for x in part.to_pylist()]
            word, start, end = zip(*(w for ws in found for w in ws), strict=True) if any(found) else ((), (), ())
            parts.append(list_array([len(ws) for ws in found], part.is_null().to_pylist(), kind, word=word, start=start, end=end))
        return pa.concat_arrays(parts)

    return split(text)


def encoded_labels(words: Column, spans: Column) -> Column:
    """A tag for each word, by its first character; a word that begins inside a span after O, or at the start, is B-."""
    return by_row("array<string>", tags_of, words, spans)


def highlighted(text: Column, spans: Column, html: bool = False) -> Column:
    """Text with ``[span](LABEL)`` in place of each span, in order of start; in HTML a mark element, the rest escaped."""
    return by_row("string", lambda t, s: marked_of(t, s, html), text, spans)
