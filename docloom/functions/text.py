"""Section rules as column expressions; all stay in the JVM."""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import reduce
from itertools import accumulate, zip_longest

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.constants import CONTENTS_WORDS, LABEL_TYPES, LEADERS, LINE_NUMBER, SECTION_RULES


def stripped(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\n\x0b\f\r"))


def word_count(c: Column) -> Column:
    """Words between white space; 0 for an empty text."""
    return F.regexp_count(c, F.lit(r"\S+"))


def is_toc_page(c: Column, plain: Column | None = None) -> Column:
    """A contents word with dot leaders, or more than five lines of which over half end in a page number; cheap conditions of each come first."""
    low = F.lower(c)
    named = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in CONTENTS_WORDS])
    lines = F.filter(F.split(c, "\n"), lambda x: stripped(x) != "")
    numbered = F.filter(lines, lambda x: x.rlike(LINE_NUMBER))
    many = F.contains(c, F.lit("\n")) & (F.size(lines) > 5) & (F.size(numbered) * 2 > F.size(lines))
    long_ = F.length(stripped(c) if plain is None else plain) >= 20
    return F.coalesce(long_ & ((F.contains(c, F.lit("...")) & named & c.rlike(LEADERS)) | many), F.lit(False))


#: First characters without which a rule's pattern cannot fit (in lower case, where the rule looks at that).
_FIRST = {r"^[\d.]": "0123456789.", "^(chapter|section|article|part)": "csap", "^appendix": "a", "^[-•*]": "-•*", "^(figure|fig": "f", "^(table|tbl": "t"}


def _may_fit(t: Column, pattern: str, low: bool) -> Column:
    """A condition that all texts fulfil which the pattern fits, and that costs little."""
    for begin, first in _FIRST.items():
        if pattern.startswith(begin):
            own = F.substring(t, 1, 1)
            return (F.lower(own) if low else own).isin(*first)
    if re.fullmatch(r"\[[^\x00-\x7F]+\]", pattern):  # signs beyond ASCII alone
        return F.octet_length(t) != F.length(t)
    return F.lit(True)


def section_type(c: Column, plain: Column | None = None) -> Column:
    """``plain``: the stripped text, where a column has it; each rule looks at it."""
    t = stripped(c) if plain is None else plain
    out = F.lit("paragraph")
    for kind, pattern, low in reversed(SECTION_RULES):
        fits = _may_fit(t, pattern, low) & (F.lower(t) if low else t).rlike(pattern)
        if kind == "heading" and not low:
            fits = fits & (F.length(t) < 100)
        out = F.when(fits, kind).otherwise(out)
    return F.when(c.isNull() | (c == ""), "unknown").when(is_toc_page(t, t), "toc").otherwise(out)


def label_type(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LABEL_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(label)), F.lit("paragraph"))


def heading_level(c: Column, kind: Column, plain: Column | None = None) -> Column:
    """Depth of a dotted number, 1 without one; null unless a heading."""
    number = F.regexp_replace(F.regexp_extract(stripped(c) if plain is None else plain, r"^([\d.]+)", 1), r"^\.+|\.+$", "")
    return F.when(kind == "heading", F.size(F.split(number, r"\.")))


def markdown(c: Column, kind: Column, level: Column, enumerated: Column | None = None, language: Column | None = None) -> Column:
    t = stripped(c)
    depth = F.least(F.greatest(F.coalesce(F.when(level == 0, 1).otherwise(level), F.lit(1)), F.lit(1)), F.lit(6))
    mark = F.when(F.coalesce(enumerated, F.lit(False)), "1. ").otherwise("- ") if enumerated is not None else F.lit("- ")
    fence = F.coalesce(language, F.lit("")) if language is not None else F.lit("")
    return (
        F.when(F.coalesce(c, F.lit("")) == "", "")
        .when(kind.isin("heading", "title", "section_header"), F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), t))
        .when(kind == "list_item", F.concat(mark, t))
        .when(kind == "code", F.concat(F.lit("```"), fence, F.lit("\n"), t, F.lit("\n```")))
        .when((kind == "equation") & (F.contains(t, F.lit("\n")) | (F.length(t) > 50)), F.concat(F.lit("$$\n"), t, F.lit("\n$$")))
        .when(kind == "equation", F.concat(F.lit("$"), t, F.lit("$")))
        .when(kind.isin("caption", "figure_caption", "table_caption"), F.concat(F.lit("*"), t, F.lit("*")))
        .when(kind == "footnote", F.concat(F.lit("[^]: "), t))
        .otherwise(t)
    )


def markdown_table(rows: Column) -> Column:
    """An array of arrays of cells as a pipe table with a rule after its first row."""
    lines = F.transform(rows, lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(F.get(rows, 0), lambda c: F.lit("---")), " | "), F.lit(" |"))
    return F.when(F.size(rows) == 0, "").otherwise(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))), "\n"))


def struck_through(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit("̶")), F.lit(False))


def section_id(doc: Column, sequence: Column) -> Column:
    return F.format_string("%s_s%05d", doc.cast("string"), sequence)


def image_id(doc: Column, page: Column, number: Column) -> Column:
    return F.format_string("%s_p%03d_img%03d", doc.cast("string"), page, number)


def normalized_path(c: Column) -> Column:
    """Local form of a path: without its scheme, percent escapes decoded (a plus stays); null if empty."""
    plain = F.regexp_replace(F.regexp_replace(c, r"^dbfs:/Volumes/", "/Volumes/"), r"^dbfs:/", "/dbfs/")
    decoded = F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)
    return F.when(stripped(c) != "", decoded)


def document_id(path: Column) -> Column:
    """The parent folder's name, or the file's stem where that is a drop folder."""
    parts = F.split(path, "/")
    parent = F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    return F.when(parent.isin("tmp", "uploads", "documents", ""), stem).otherwise(parent)


def protocol_id(c: Column) -> Column:
    return F.regexp_extract(c, r"^([^_]+)", 1)


def is_scanned(chars: Column, images: Column) -> Column:
    """Over arrays of characters and images of the pages: the first three hold under 100 characters each, and an image."""
    first, shown = F.slice(chars, 1, 3), F.slice(images, 1, 3)
    total = F.aggregate(first, F.lit(0).cast("double"), lambda a, x: a + x)
    return F.coalesce((F.size(first) > 0) & (total < 100 * F.size(first)) & (F.aggregate(shown, F.lit(0).cast("double"), lambda a, x: a + x) > 0), F.lit(False))


#: White space as the JVM's expressions know it, whatever the text.
_ENDS = re.compile(r"(?<=[.!?])\s+(?=[A-Z])|(?<=[.!?])\s*\n+", re.ASCII)
_BLANK = " \t\n\x0b\f\r"
_SPACE = re.compile(r"\s+", re.ASCII)


def chunks_of(text: str, most: int) -> list[str]:
    """Sentences (split after . ! ? before a capital or at line ends) packed greedily into chunks of at most ``most`` words; a longer one is a chunk of its own."""
    parts = [p for p in (p.strip(_BLANK) for p in _ENDS.split(text)) if p]
    if not parts:
        return [text]
    ends = list(accumulate(len(_SPACE.split(p)) for p in parts))  # words up to each sentence's end
    out, at, done = [], 0, 0
    while at < len(parts):
        to = max(at + 1, bisect_right(ends, done + most, at))
        out.append(" ".join(parts[at:to]))
        at, done = to, ends[to - 1]
    return out


def chunk_pairs(text: Column, marked: Column | None, most: int) -> Column:
    """Chunks of a text, and of its markdown beside them if there is one, as structs; the shorter list is filled with empty texts."""
    names = ["content_text"] if marked is None else ["content_text", "content_markdown"]
    kind = pa.list_(pa.struct([(n, pa.string()) for n in names]))

    @F.arrow_udf(f"array<struct<{','.join(f'{n}:string' for n in names)}>>")
    def pairs(*columns: pa.Array) -> pa.Array:
        rows = []
        for values in zip(*(c.to_pylist() for c in columns), strict=True):
            rows.append([dict(zip(names, made, strict=True)) for made in zip_longest(*(chunks_of(v or "", most) for v in values), fillvalue="")])
        return pa.array(rows, kind)

    return pairs(*[text, marked][: len(names)])


def chunks(c: Column, most: int) -> Column:
    """Chunks of a text alone."""
    return F.transform(chunk_pairs(c, None, most), lambda x: x["content_text"])
