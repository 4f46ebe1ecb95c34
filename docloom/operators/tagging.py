"""Entities of sections: a pluggable tagger gives tokens, spans come from their tags.

The built-in tagger looks phrases up in a gazetteer; a learned one is any function from a text column to a column of tokens
(label, start, end, confidence), such as a Pandas UDF that loads its model once a worker.
"""

from __future__ import annotations

from collections.abc import Callable

import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.binding import let
from docloom.operators import entities as ent

Tagger = Callable[[Column], Column]
_EDGES = re.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def gazetteer(terms: dict[str, str], confidence: float = 1.0) -> Tagger:
    """A tagger of phrases (in lower case) and their types: the longest phrase at a word wins, from left to right.

    Phrases may be of any number and length; they go to the workers with the function, once a task.
    """
    by_first: dict[str, list[int]] = {}
    for term in terms:
        by_first.setdefault(term.split()[0] if term.split() else "", []).append(len(term.split()))
    sizes = {first: sorted(set(many), reverse=True) for first, many in by_first.items()}

    def tokens(text: str) -> list[dict]:
        words = ent.words_of(text)
        plain = [_EDGES.sub("", w["word"].lower()) for w in words]
        out, i = [], 0
        while i < len(words):
            n = next((n for n in sizes.get(plain[i], ()) if i + n <= len(words) and " ".join(plain[i : i + n]) in terms), 0)
            kind = terms[" ".join(plain[i : i + n])] if n else ""
            for j in range(i, i + max(n, 1)):
                out.append({"label": f"{'B-' if j == i else 'I-'}{kind}" if n else "O", "start": words[j]["start"], "end": words[j]["end"], "confidence": confidence})
            i += max(n, 1)
        return out

    return lambda text: ent.by_row(f"array<{ent.TOKEN}>", tokens, text)


def forgiving(tokens: Callable[[str], list[dict]]) -> Tagger:
    """A tagger from a function of a text that may fail: a text that it fails on has no tokens."""

    def run(text: str) -> list[dict]:
        try:
            return tokens(text)
        except Exception:  # noqa: BLE001  one bad text is no reason to lose the others
            return []

    return lambda text: ent.by_row(f"array<{ent.TOKEN}>", run, text)


def ready(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("ready_for_ner"))


def extracted(sections: DataFrame, tagger: Tagger, text: str = "section_text", version: str = "1.0") -> DataFrame:
    """``sections`` with ``entities``, ``entity_count``, and ``entity_type_counts`` (true counts); a null text has none."""
    return with_entities(sections.withColumn("__tokens", tagger(F.col(text))), "__tokens", text, version)


def with_entities(tagged: DataFrame, tokens: str = "tokens", text: str = "section_text", version: str = "1.0") -> DataFrame:
    """The same from a column of tokens, which goes."""
    spans = tagged.withColumn("entities", ent.decoded_spans(F.coalesce(tokens, F.array()), F.col(text))).drop(tokens)
    kinds = F.transform("entities", lambda e: e["entity_type"])
    counts = let(kinds, lambda all_: F.map_from_entries(F.transform(F.array_sort(F.array_distinct(all_)), lambda t: F.struct(t, F.size(F.filter(all_, lambda x: x == t))))))
    return spans.withColumns({"entity_count": F.size("entities"), "entity_type_counts": counts, "model_version": F.lit(version)})


def clinical_entities(extracted: DataFrame, keys: list[str], section: str) -> DataFrame:
    """The flat view: a row for each span, with an id made of its section and its number there."""
    out = extracted.select(*keys, F.posexplode("entities").alias("i", "e"))
    number = F.concat_ws("_", F.col(section).cast("string"), F.format_string("e%04d", F.col("i") + 1))
    return out.select(number.alias("entity_id"), *keys, F.col("e.text").alias("entity_text"), F.col("e.entity_type").alias("entity_type"), F.col("e.start_pos").alias("start_position"), F.col("e.end_pos").alias("end_position"), F.col("e.confidence").alias("confidence"))
