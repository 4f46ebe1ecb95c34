"""Benchmark decontamination by a prefix-filtered set join with exact verification.

A benchmark item is cut into windows of ten consecutive words (an item of fewer
words is one window).  A window's set is its five-word shingles (a shorter
window is one shingle).  Containment of the whole window is asked for, so the
prefix that a match cannot avoid is the window's single rarest shingle, rarity
being the count over all documents.  Every place of a document that holds such
a shingle fixes where the window would start (positional bound); the window must
lie inside the document (length bound), and is then verified word by word: hashes first, then the words' bytes.

The windows are broadcast, in blocks of items of at most ``BLOCK_BYTES`` of
text.  Documents never move: both the count and the join are map-side, and only
counts of benchmark shingles are shuffled.  A larger benchmark takes two passes
over the texts for each block; what a block hits is kept under the digest of the text,
and the few hits of all blocks meet the documents in one join.

Defined results: nulls and texts without words hit nothing and are not hit.
Repeated items count once by id; an item with a null id hits words but is not listed.
Repeated documents each get the same result.  Columns that clash with added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.store import Table, extended, put_back, set_aside

WINDOW = 10
SHINGLE = 5
#: Text of the items of one block; its arrays are some 40 times that in a worker at the most.
BLOCK_BYTES = 4_000_000
_FLAG_BITS = 16


class _Windows:
    """Distinct windows of a block's items: word hashes, where their words' bytes are, and which items have each."""

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int, shingle: int, rule: k.WordRule):
        w = k.words(texts, rule)
        found: dict[bytes, tuple[np.ndarray, int, set[str | None]]] = {}
        for i, name in enumerate(ids):
            a, b = int(w.first[i]), int(w.first[i + 1])
            size = min(window, b - a)
            for s in range(a, b - size + 1 if size else a):
                # Words joined by one space tell windows apart by their bytes.
                words = b" ".join(w.data[x:y].tobytes() for x, y in zip(w.start[s : s + size], w.end[s : s + size], strict=True))
                found.setdefault(words, (w.hash[s : s + size], s, set()))[2].add(name)
        self.source = w
        self.windows = [x[0] for x in found.values()]
        self.at = np.array([x[1] for x in found.values()], np.int64)
        self.items = [sorted(n for n in x[2] if n is not None) for x in found.values()]
        self.shingles = [self.grams(x, shingle) for x in self.windows]

    @staticmethod
    def grams(window: np.ndarray, shingle: int) -> tuple[int, np.ndarray]:
        n = min(shingle, len(window))
        return n, k.gram_hashes(window, n)


class _Lookup:
    """Finds which of some hashes are in a sorted list; most are ruled out by a table of their top bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.flag = np.zeros(1 << _FLAG_BITS, bool)
        self.flag[(self.hashes >> np.uint64(64 - _FLAG_BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h``, and in the list, of those that are in it."""
        if not len(self.hashes) or not len(h):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.flag[(h >> np.uint64(64 - _FLAG_BITS)).astype(np.int64)])
        to = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        ok = self.hashes[to] == h[at]
        return at[ok], to[ok]


def _count(shared, rule: k.WordRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups: dict[int, _Lookup] = shared.value
        total = {n: np.zeros(len(x.hashes), np.int64) for n, x in lookups.items()}
        for batch in batches:
            for a, b in k.slices(batch.column(0)):
                w = k.words(batch.column(0).slice(a, b - a), rule)
                for n, x in lookups.items():
                    _, h = k.grams(w, n)
                    _, to = x.find(h)
                    total[n] += np.bincount(to, minlength=len(x.hashes))
        for n, x in lookups.items():
            m = total[n] > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(m.sum()), n, np.int64)), pa.array(k.as_signed(x.hashes[m])), pa.array(total[n][m])], names=["size", "hash", "n"])

    return run


class _Index:
    """Prefix shingles of a block, and for each the windows that have it and where."""

    def __init__(self, block: _Windows, rarity: dict[tuple[int, int], int]):
        self.items = block.items
        self.length = np.array([len(x) for x in block.windows], np.int64)
        self.first = np.r_[0, np.cumsum(self.length)]
        self.words = np.concatenate([*block.windows, np.empty(0, np.uint64)])
        self.at, self.data, self.start, self.end = block.at, block.source.data, block.source.start, block.source.end
        by: dict[int, list[tuple[int, int, int]]] = {}
        for i, (n, g) in enumerate(block.shingles):
            at = min(range(len(g)), key=lambda j: (rarity.get((n, int(g[j])), 0), int(g[j])))
            by.setdefault(n, []).append((int(g[at]), i, at))
        self.by = {}
        for n, rows in by.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            look = _Lookup(h)
            self.by[n] = (look, np.searchsorted(h, look.hashes), np.searchsorted(h, look.hashes, side="right"), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))

    def match(self, w: k.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word (in the slice) and window of every occurrence."""
        out = [(np.empty(0, np.int64),) * 3]
        for n, (look, lo, hi, window, offset) in self.by.items():
            at, h = k.grams(w, n)
            place, to = look.find(h)
            many = hi[to] - lo[to]
            place = np.repeat(at[place], many)
            entry = np.repeat(lo[to], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            win = window[entry]
            start, text = place - offset[entry], w.text[place]
            ok = (start >= w.first[text]) & (start + self.length[win] <= w.first[text + 1])
            start, text, win = start[ok], text[ok], win[ok]
            for i in range(int(self.length[win].max()) if len(win) else 0):
                ok = (i >= self.length[win]) | (w.hash[np.minimum(start + i, len(w.hash) - 1)] == self.words[np.minimum(self.first[win] + i, len(self.words) - 1)])
                start, text, win = start[ok], text[ok], win[ok]
            ok = self._same(w, start, win)
            out.append((text[ok], start[ok], win[ok]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


    def _same(self, w: k.Words, start: np.ndarray, win: np.ndarray) -> np.ndarray:
        """Whether the words of each place and window hold the same bytes."""
        many = self.length[win]
        row = np.repeat(np.arange(len(win)), many)
        step = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        mine, theirs = start[row] + step, self.at[win][row] + step
        same = k.same_words(w.data, w.start[mine], w.end[mine], self.data, self.start[theirs], self.end[theirs])
        return np.bincount(row[~same], minlength=len(win)) == 0


def _spans(start: np.ndarray, end: np.ndarray) -> list[int]:
    """Ascending starts and their ends as maximal flat [from, to) intervals."""
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > reach[:-1])
    return np.stack([start[np.r_[0, cut + 1]], reach[np.r_[cut, len(start) - 1]]], axis=1).ravel().tolist()


def _mark(shared, rule: k.WordRule, text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: _Index = shared.value
        for batch in batches:
            for a, b in k.slices(batch.column(text_at)):
                here = batch.slice(a, b - a)
                w = k.words(here.column(text_at), rule)
                text, start, win = index.match(w)
                order = np.lexsort((start, text))
                text, start, win = text[order], start[order], win[order]
                edge = np.searchsorted(text, np.arange(b - a + 1))
                spans, items = [], []
                for r, (x, y) in enumerate(zip(edge.tolist(), edge[1:].tolist(), strict=False)):
                    spans.append(_spans(start[x:y] - w.first[r], start[x:y] - w.first[r] + index.length[win[x:y]]) if x < y else [])
                    items.append(sorted({n for i in win[x:y] for n in index.items[i]}))
                cols = [pa.array(np.diff(w.first)), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([here.column(i) for i in keep] + cols, names=names)

    return run


ADDED = ("n_words", "hit_spans", "hit_items", "n_hit")


def mark_benchmark_words(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word intervals, flat), ``hit_items`` (sorted ids as strings) and ``n_hit``."""
    spark = docs.sparkSession
    rule = k.keyed(k.ALNUM_LOWER)
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text")).filter(F.length("text") > 0).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-2 * size // block_bytes) if size > block_bytes else 1
    keep = [i for i, c in enumerate(docs.columns) if c not in ADDED]
    names = [docs.columns[i] for i in keep]
    added = {"n_words": T.LongType(), "hit_spans": T.ArrayType(T.LongType()), "hit_items": T.ArrayType(T.StringType())}

    def index_of(rows: list) -> Broadcast:
        block = _Windows([r.id for r in rows], pa.array([r.text for r in rows], pa.large_string()), window, shingle, rule)
        lookups = {n: _Lookup(np.concatenate([g for m, g in block.shingles if m == n])) for n in {n for n, _ in block.shingles}}
        rarity = {}
        if lookups:
            wanted = spark.sparkContext.broadcast(lookups)
            texts = docs.select(F.col(f"`{text_col}`")).filter(F.col(f"`{text_col}`").isNotNull())
            counts = texts.mapInArrow(_count(wanted, rule), "size long, hash long, n long").groupBy("size", "hash").agg(F.sum("n").alias("n")).collect()
            rarity = {(r["size"], r["hash"] & (2**64 - 1)): r.n for r in counts}
            wanted.unpersist()
        return spark.sparkContext.broadcast(_Index(block, rarity))

    def marked(rows: DataFrame, at: int, keep: list[int], names: list[str], index: Broadcast) -> DataFrame:
        return rows.mapInArrow(_mark(index, rule, at, keep, [*names, *added]), extended(rows, names, **added))

    if blocks == 1:
        out = marked(docs, docs.columns.index(text_col), keep, names, index_of(items.orderBy("id", "text").collect()))
    else:
        out = _with_blocks(docs, text_col, blocks, items, index_of, marked, keep, names)
    spans = F.col("hit_spans")
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size(spans) - 2, F.lit(2)), F.lit(0).cast("long"), lambda acc, i: acc + F.get(spans, i + 1) - F.get(spans, i))
    return out.withColumn("n_hit", F.when(F.size(spans) > 0, n_hit).otherwise(F.lit(0).cast("long")))


def _with_blocks(docs: DataFrame, text_col: str, blocks: int, items: DataFrame, index_of, marked, keep: list[int], names: list[str]) -> DataFrame:
    """Hits of all blocks of items: those of a block are kept under the digest of their text, merged by digest, and joined to the documents once."""
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256))
    texts = docs.select(digest.alias("__docloom_digest"), F.col(f"`{text_col}`").alias("text")).filter(F.col("text").isNotNull())
    hits = []
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).orderBy("id", "text").collect()
        here = marked(texts, 1, [0], ["__docloom_digest"], index_of(rows)).filter(F.size("hit_spans") > 0)
        hits.append(Table(here.select("__docloom_digest", "hit_spans", "hit_items").dropDuplicates(["__docloom_digest"]), "hits"))
    every = hits[0].df
    for table in hits[1:]:
        every = every.unionByName(table.df)
    none = F.array().cast("array<bigint>")
    spans = F.aggregate(F.array_sort(F.flatten(F.collect_list(_pairs("hit_spans")))), none, _push)
    merged = every.groupBy("__docloom_digest").agg(spans.alias("__docloom_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("__docloom_items"))
    merged = Table(merged, "hits")
    for table in hits:
        table.drop()
    plain = marked(docs, docs.columns.index(text_col), keep, names, spark.sparkContext.broadcast(_Index(_Windows([], pa.array([], pa.large_string()), WINDOW, SHINGLE, k.ALNUM_LOWER), {})))
    joined = plain.withColumn("__docloom_digest", digest).join(merged.side(), "__docloom_digest", "left")
    columns = [F.col(f"`{c}`") for c in names]
    return joined.select(*columns, "n_words", F.coalesce("__docloom_spans", none).alias("hit_spans"), F.coalesce("__docloom_items", F.array().cast("array<string>")).alias("hit_items"))


def _pairs(name: str):
    c = F.col(name)
    return F.transform(F.sequence(F.lit(0), F.size(c) - 2, F.lit(2)), lambda i: F.struct(F.get(c, i).alias("a"), F.get(c, i + 1).alias("b")))


def _push(done, x):
    return F.when((F.size(done) > 0) & (x["a"] <= F.coalesce(F.try_element_at(done, F.lit(-1)), x["a"] - 1)), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.greatest(F.try_element_at(done, F.lit(-1)), x["b"])))).otherwise(F.concat(done, F.array(x["a"], x["b"])))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold an occurrence of a benchmark window; the columns stay as they are."""
    marked = mark_benchmark_words(set_aside(docs, ADDED), benchmark, **options)
    return put_back(marked.filter("n_hit = 0"), docs.columns, ADDED)
