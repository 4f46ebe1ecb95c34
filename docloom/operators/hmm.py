"""A tagger learned in Spark: a hidden Markov model of tags, counted from annotated texts, decoded by Viterbi in overlapping windows.

Counting is two groupings: words by tag, and tags by the tag before.  Words that the annotations hold fewer than ``min_count``
times count as their shape (capital, digits, length, last mark), and so do unknown words of a text, so the model knows what to expect of them.
Scores are whole millionths of logarithms of smoothed shares, so sums are exact and ties, which go to the tag that sorts first, repeat.

Decoding takes windows of ``step`` words with ``overlap`` words more on either side, 512 in all; a word's tag is the one of the window whose
middle it is in, so a text of any length is read whole and no window's edge decides.  A model whose measured size allows is
broadcast, and texts are tagged where they are.  A larger one is joined to the words, which then meet in their windows; no task holds more than windows.

Defined results: a null text has no tags; a text without words has none either.  A model of no annotations tags every word O.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators import entities as ent
from docloom.sources.io import shared_folder

UNIT = 1_000_000
STEP, OVERLAP = 384, 64
#: A model of up to so many bytes of scores and words is broadcast.
BROADCAST_BYTES = 32_000_000
#: Windows that are decoded side by side.
_TOGETHER = 256
#: Different words whose places in the model a batch remembers.
_MET = 100_000


def form(word: Column) -> Column:
    """A word as the model knows it."""
    return F.lower(word)


def shape(word: Column) -> Column:
    """What an unknown word looks like; it holds a space, as no word does."""
    first = F.when(word.rlike(r"^[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"), "A").when(word.rlike("^[0-9]"), "0").otherwise("a")
    last = F.when(word.rlike("[.!?]$"), ".").when(word.rlike("[,;:]$"), ",").otherwise("")
    return F.concat(F.lit(" "), first, F.when(F.length(word) > 5, "long").otherwise("short"), last)


@dataclass
class Model:
    """``tags`` in order; ``forms``: a row for each known word or shape with its scores by tag; scores of first tags and of pairs; and the scores
    of a shape that no annotation has."""

    tags: list[str]
    forms: DataFrame
    first: list[int]
    pairs: list[list[int]]
    unseen: list[int]
    size: int


def learn(annotated: DataFrame, words: str = "words", tags: str = "tags", min_count: int = 2) -> Model:
    """A model of rows with an array of words and one of their tags."""
    rows = annotated.filter(F.col(words).isNotNull() & F.col(tags).isNotNull())
    # The tags moved on by one stand beside them; a lambda that looks back would make the whole array again for each word.
    before = F.concat(F.array(F.lit(None).cast("string")), F.col(tags))
    tokens = rows.select(F.inline(F.arrays_zip(F.col(words).alias("word"), F.col(tags).alias("tag"), before.alias("before")))).filter("word is not null and tag is not null")
    # Texts are read once, for words and their shapes by tag and the tag before; all counts are sums of these.
    counts = shared_folder(annotated.sparkSession)
    tokens.groupBy("before", "tag", form(F.col("word")).alias("form"), shape(F.col("word")).alias("shape")).agg(F.count("*").alias("n")).write.parquet(counts)
    counted = annotated.sparkSession.read.schema("before string, tag string, form string, shape string, n long").parquet(counts)
    pairs = {(r.before, r.tag): r.n for r in counted.groupBy("before", "tag").agg(F.sum("n").alias("n")).collect()}  # tags squared
    names = sorted({t for _, t in pairs})
    if not names:
        spark = annotated.sparkSession
        return Model(["O"], spark.createDataFrame([], "form string, scores array<long>"), [0], [[0]], [0], 0)
    known = counted.groupBy("form").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count).select("form", F.lit(True).alias("known"))
    seen = counted.join(known, "form", "left").groupBy(F.when(F.col("known"), F.col("form")).otherwise(F.col("shape")).alias("form"), "tag").agg(F.sum("n").alias("n"))
    by_form = seen.groupBy("form").agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("by"))
    path = shared_folder(annotated.sparkSession)  # counted once, read by all that follows
    by_form.write.parquet(path)
    by_form = annotated.sparkSession.read.parquet(path)
    many = by_form.count()
    total = {t: sum(n for (_, x), n in pairs.items() if x == t) for t in names}
    scores = F.array(*[_score(F.coalesce(F.try_element_at("by", F.lit(t)), F.lit(0)), total[t], many) for t in names])
    after = {b: sum(n for (x, _), n in pairs.items() if x == b) for b in [None, *names]}
    share = lambda b, t: round(UNIT * float(np.log((pairs.get((b, t), 0) + 1) / (after[b] + len(names)))))
    unseen = [round(UNIT * float(np.log(1 / (total[t] + many)))) for t in names]
    size = many * 8 * (len(names) + 12)
    return Model(names, by_form.select("form", scores.alias("scores")), [share(None, t) for t in names], [[share(b, t) for t in names] for b in names], unseen, size)


def _score(n: Column, total: int, many: int) -> Column:
    return F.round(UNIT * F.log((n + 1) / F.lit(float(total + many)))).cast("long")


def viterbi(scores: list[np.ndarray], starts: list[bool], first: np.ndarray, pairs: np.ndarray) -> list[np.ndarray]:
    """The best tags of windows, side by side; a window that is no text's beginning may begin with any tag."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    order = sorted((i for i in range(len(scores)) if len(scores[i])), key=lambda i: -len(scores[i]))
    for a in range(0, len(order), _TOGETHER):
        some = order[a : a + _TOGETHER]
        lengths = np.array([len(scores[i]) for i in some])
        padded = np.zeros((lengths[0], len(some), len(first)), np.int64)
        for j, i in enumerate(some):
            padded[: lengths[j], j] = scores[i]
        live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # longer windows come first
        best = padded[0] + np.where(np.array([starts[i] for i in some])[:, None], first, 0)
        back = np.zeros(padded.shape, np.int16)
        for t in range(1, lengths[0]):
            ways = best[: live[t], :, None] + pairs[None]
            back[t, : live[t]] = ways.argmax(1)
            best[: live[t]] = ways.max(1) + padded[t, : live[t]]
        tags = np.empty((lengths[0], len(some)), np.int64)
        tags[lengths - 1, np.arange(len(some))] = best.argmax(1)
        for t in range(lengths[0] - 1, 0, -1):
            tags[t - 1, : live[t]] = back[t, np.arange(live[t]), tags[t, : live[t]]]
        for j, i in enumerate(some):
            out[i] = tags[: lengths[j], j].copy()
    return out


def _confidence(scores: np.ndarray, tags: np.ndarray, begins: np.ndarray, bound: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The share of each tag among all tags at its word, given the tag before; ``begins`` are texts' first words, ``bound`` all first words of windows."""
    ahead = np.zeros_like(scores)
    ahead[1:] = pairs[tags[:-1]]
    ahead[bound] = 0
    ahead[begins] = first
    x = (scores + ahead) / UNIT
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e[np.arange(len(tags)), tags] / e.sum(axis=1)


def _decoded(scores: list[np.ndarray], begins: list[bool], first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tags and confidences of all words of windows, one window after the other."""
    if not any(map(len, scores)):
        return np.empty(0, np.int64), np.empty(0)
    found = np.concatenate(viterbi(scores, begins, first, pairs))
    at = np.cumsum([0, *map(len, scores)])
    filled = np.array(list(map(len, scores))) > 0
    bound = at[:-1][filled]
    return found, _confidence(np.concatenate(scores), found, bound[np.array(begins)[filled]], bound, first, pairs)


_TOKENS = f"array<{ent.TOKEN}>"
_SHAPES = ((re.compile(r"^[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]"), "A"), (re.compile("^[0-9]"), "0"))


def shape_of(word: str) -> str:
    first = next((mark for pattern, mark in _SHAPES if pattern.match(word)), "a")
    last = "." if word[-1:] in (".", "!", "?") else "," if word[-1:] in (",", ";", ":") else ""
    return f" {first}{'long' if len(word) > 5 else 'short'}{last}"


def tagged(texts: DataFrame, model: Model, keys: list[str], text: str = "text", step: int = STEP, overlap: int = OVERLAP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``texts`` with ``tokens``: label, start, end and confidence of each word.  ``keys`` tell the rows apart where words have to meet."""
    if model.size <= broadcast_bytes:
        return _in_place(texts, model, text, step, overlap)
    return _by_join(texts, model, keys, text, step, overlap)


def _in_place(texts: DataFrame, model: Model, text: str, step: int, overlap: int) -> DataFrame:
    rows = model.forms.select("form", "scores").toPandas()  # bounded by broadcast_bytes
    matrix = np.array([*rows["scores"].map(list), model.unseen], np.int64).reshape(-1, len(model.tags))
    shared = texts.sparkSession.sparkContext.broadcast((model.tags, {f: i for i, f in enumerate(rows["form"])}, matrix, np.array(model.first), np.array(model.pairs)))
    kind = ent.arrow_type(_TOKENS)

    @F.arrow_udf(_TOKENS)
    def tag(column: pa.Array) -> pa.Array:
        tags, known, matrix, first, pairs = shared.value
        unseen, met = len(matrix) - 1, {}

        def place(word: str) -> int:
            found = known.get(word.lower())
            return known.get(shape_of(word), unseen) if found is None else found

        parts = [pa.array([], kind)]
        for at, many in ent.slices((column,), 1_024):
            part = column.slice(at, many)
            spans, lows, begins, cut, keep, counts = [], [], [], [], [], []
            for text in part.to_pylist():
                words = list(ent.words_in(text or ""))
                counts.append(len(words))
                spans += [m.span() for m in words]
                places = []
                for m in words:
                    if (p := met.get(m.group())) is None:
                        p = met[m.group()] = place(m.group())
                    places.append(p)
                for a in range(0, len(words), step):
                    low, high = max(0, a - overlap), min(len(words), a + step + overlap)
                    cut.append(matrix[places[low:high]])
                    begins.append(low == 0)
                    mine = np.zeros(high - low, bool)
                    mine[a - low : min(len(words), a + step) - low] = True
                    keep.append(mine)
                if len(met) > _MET:
                    met.clear()
            found, sure = _decoded(cut, begins, first, pairs)
            mine = np.concatenate([np.empty(0, bool), *keep])
            start, end = np.array(spans, np.int32).reshape(-1, 2).T
            parts.append(ent.list_array(counts, part.is_null().to_pylist(), kind, label=pa.array(tags).take(pa.array(found[mine])), start=start, end=end, confidence=sure[mine]))
        return pa.concat_arrays(parts)

    return texts.withColumn("tokens", tag(F.col(text)))


def _by_join(texts: DataFrame, model: Model, keys: list[str], text: str, step: int, overlap: int) -> DataFrame:
    words = texts.select(*keys, F.posexplode(ent.words_with_offsets(F.col(text))).alias("p", "w")).select(*keys, "p", "w.*")
    own = (F.col("p") / step).cast("int")
    at = F.col("p") - own * step
    near = F.array_compact(F.array(own, F.when((at < overlap) & (own > 0), own - 1), F.when(at >= step - overlap, own + 1)))
    forms = model.forms
    scored = words.withColumns({"form": form(F.col("word")), "shape": shape(F.col("word"))})
    scored = scored.join(forms, "form", "left").withColumnRenamed("scores", "known").drop("form")
    shapes = F.broadcast(forms.filter(F.startswith("form", F.lit(" "))).select(F.col("form").alias("shape"), F.col("scores").alias("like")))  # there are eighteen
    scored = scored.join(shapes, "shape", "left").withColumn("scores", F.coalesce("known", "like", F.array(*map(F.lit, model.unseen)).cast("array<long>")))
    entry = F.struct("p", "start", "end", "scores")
    windows = scored.withColumn("window", F.explode(near)).groupBy(*keys, "window").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    tags, first, pairs = model.tags, np.array(model.first), np.array(model.pairs)
    kind = ent.arrow_type(_TOKENS)

    @F.arrow_udf(_TOKENS)
    def tag(numbers: pa.Array, column: pa.Array) -> pa.Array:
        parts = [pa.array([], kind)]
        for at, many in ent.slices((column,), 64):
            rows, w = column.slice(at, many).to_pylist(), numbers.slice(at, many).to_pylist()
            scores = [np.array([x["scores"] for x in row], np.int64).reshape(-1, len(tags)) for row in rows]
            found, sure = _decoded(scores, [row[0]["p"] == 0 for row in rows], first, pairs)
            every, out = iter(zip(found.tolist(), sure.tolist(), strict=True)), []
            for row, n in zip(rows, w, strict=True):
                out.append([{"label": tags[k], "start": x["start"], "end": x["end"], "confidence": c} for x, (k, c) in zip(row, every) if n * step <= x["p"] < (n + 1) * step])
            parts.append(pa.array(out, kind))
        return pa.concat_arrays(parts)

    made = windows.select(*keys, "window", tag(F.col("window"), F.col("all")).alias("tokens"))
    whole = made.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("window", "tokens"))), lambda x: x["tokens"])).alias("tokens"))
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    joined = texts.alias("t").join(whole.alias("m"), on, "left")
    none = F.when(F.col(f"t.{text}").isNotNull(), F.array().cast(_TOKENS))
    return joined.select("t.*", F.coalesce(F.col("m.tokens"), none).alias("tokens"))
