"""Exact substring removal: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

A window is ``window`` consecutive words of one text.  Every word that lies in
a window whose word sequence also starts earlier (smaller id, or the same id
and an earlier start) is removed; all windows are judged on the input.

Plan.  One pass hashes every window of every text.  Each chunk of texts sorts
its hashes, settles repeats inside the chunk on the spot and keeps the first
occurrence of each hash, so a passage that a third of all documents share
reaches the shuffle once a chunk, not once a document.  Chunks are cut into
buckets by hash range and shuffled as packed byte planes (about fifteen bytes a
window).  A bucket finds, for each hash, the first occurrence in the corpus,
and answers each chunk with the windows that are not it.  A chunk merges its
repeated windows into maximal removal intervals of each text.  The intervals
(few per text) then meet the texts, by a broadcast if their measured size
allows and by a shuffle join otherwise, and the words outside stay.

Defined results: a null text has no words, so nothing is removed and the kept
text is empty.  Rows that share an id count as one document: of equal windows
the one with the smaller start is first, and at equal starts none is earlier
than the other, so repeated rows get equal results.  A null id sorts before
all others.  Ids are whole numbers; others are refused.  Other columns are passed through unless their name clashes with
one that is added, which replaces them.

Two windows are equal if 96 bits are: a Rabin-Karp hash of 64 bits and 32 bits of another,
to a second base, over keyed hashes of words.  With n windows the expected number of wrong
pairs is n*n/2**97, one in a thousand for the 1e13 windows of 100 TB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.store import Table, by_bucket, extended, integral, shuffle_partitions

WINDOW = 20
#: Windows that a chunk holds before it is sorted and sent; bounds a task's memory.
CHUNK_WINDOWS = 750_000
#: Buckets of hashes: so many for each shuffle partition, and more where one would hold more bytes than this.
BUCKETS_A_PARTITION = 4
BUCKET_BYTES = 64_000_000
#: What a byte of text sends at the most, with words of three letters.
_SENT_A_BYTE = 4

_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.binary()), ("hashes", pa.binary()), ("checks", pa.binary()), ("ids", pa.binary()), ("starts", pa.binary())])
_SENT_DDL = "bucket long, chunk binary, hashes binary, checks binary, ids binary, starts binary"
_SPANS = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("spans", pa.list_(pa.int64()))])
_NULL_ID = -(2**63)


def _ordered(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned ones in the same order."""
    return ids.view(np.uint64) ^ np.uint64(1 << 63)


def _intervals(starts: np.ndarray, window: int) -> np.ndarray:
    """Ascending window starts as maximal [from, to) intervals, flat."""
    cut = np.flatnonzero(np.diff(starts) > window)
    return np.stack([starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]] + window], axis=1).ravel()


def _by_check(h: np.ndarray, check: np.ndarray, order: np.ndarray) -> np.ndarray:
    """An order by hash, stably by check too; only where equal hashes have several checks is anything sorted anew."""
    hs, cs = h[order], check[order]
    if not ((hs[1:] == hs[:-1]) & (cs[1:] != cs[:-1])).any():
        return order
    return order[np.lexsort((cs, hs))]


class _Chunk:
    """Windows of some texts, no two of which share an id."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.digests: list[bytes] = []
        self.seen: set[int] = set()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.windows = 0

    def send(self, buckets: int) -> Iterator[pa.RecordBatch]:
        if not self.windows:
            return
        name = hashlib.md5(b"".join(self.digests) + np.array(self.ids, np.int64).tobytes()).digest()
        h, check, ids, starts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(h, kind="stable") if self._sorted() else np.lexsort((starts, ids, h))
        order = _by_check(h, check, order)
        h, check, ids, starts = h[order], check[order], ids[order], starts[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        again = ~new
        rows: list[tuple] = [(-1, name, _pack_texts(self.ids, self.digests), b"", k.to_planes(ids[again]), k.to_planes(starts[again]))]
        h, check, ids, starts = h[new], check[new], ids[new], starts[new]
        width = np.uint64((1 << 64) // buckets + 1)
        edge = np.searchsorted(h, np.arange(1, buckets, dtype=np.uint64) * width)
        for b, (x, y) in enumerate(zip(np.r_[0, edge], np.r_[edge, len(h)], strict=True)):
            if x < y:
                rows.append((b, name, k.delta_planes(h[x:y]), check[x:y].tobytes(), k.to_planes(ids[x:y]), k.to_planes(starts[x:y])))
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 256], strict=True), _SENT.types, strict=True)], schema=_SENT)

    def _sorted(self) -> bool:
        """Whether the windows came in order of id and start, so that a stable sort by hash is enough."""
        return all(a < b for a, b in zip(self.ids, self.ids[1:], strict=False))


def _pack_texts(ids: list[int], digests: list[bytes]) -> bytes:
    return np.array(ids, "<i8").tobytes() + b"".join(digests)


def _unpack_texts(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    n = len(blob) // 24
    return np.frombuffer(blob, "<i8", count=n), [blob[8 * n + 16 * i : 8 * n + 16 * i + 16] for i in range(n)]


def _hash_windows(buckets: int, window: int, rule: k.WordRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: list[_Chunk] = []  # the n-th takes the n-th row of an id
        for batch in batches:
            for a, b in k.slices(batch.column(2)):
                part = batch.slice(a, b - a)
                w = k.words(part.column(2), rule)
                at, h = k.grams(w, window)
                check = (k.gram_hashes(w.hash, window, second=True)[at] >> np.uint64(32)).astype("<u4")
                text = w.text[at]
                first = np.searchsorted(text, np.arange(len(part) + 1))
                ids, digests = part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_pylist()
                start = (at - w.first[text]).astype(np.uint64)
                named = _ordered(ids.astype(np.int64))[text]
                rows = np.flatnonzero(np.diff(first))
                if len(rows) and not (open_chunks and open_chunks[0].seen.intersection(ids[rows].tolist())) and len(set(ids[rows].tolist())) == len(rows):
                    groups = [(0, rows, slice(0, len(h)))]
                else:
                    groups = []
                    for r in rows:
                        n = next((i for i, c in enumerate(open_chunks) if int(ids[r]) not in c.seen), len(open_chunks))
                        if any(int(ids[r]) in c.seen and digests[r] in c.digests for c in open_chunks[:n]) and any(c.ids[c.digests.index(digests[r])] == int(ids[r]) for c in open_chunks[:n] if digests[r] in c.digests):
                            continue  # the same row again
                        while len(open_chunks) <= n:
                            open_chunks.append(_Chunk())
                        c = open_chunks[n]
                        c.seen.add(int(ids[r]))
                        groups.append((n, np.array([r]), slice(int(first[r]), int(first[r + 1]))))
                for n, rs, span in groups:
                    while len(open_chunks) <= n:
                        open_chunks.append(_Chunk())
                    c = open_chunks[n]
                    c.ids += ids[rs].tolist()
                    c.digests += [digests[r] for r in rs]
                    c.seen.update(ids[rs].tolist())
                    c.parts.append((h[span], check[span], named[span], start[span]))
                    c.windows += span.stop - span.start
                if open_chunks and open_chunks[0].windows >= CHUNK_WINDOWS:
                    for c in open_chunks:
                        yield from c.send(buckets)
                    open_chunks = []
        for c in open_chunks:
            yield from c.send(buckets)

    return run


def _find_first(key: tuple, group: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk, the windows that also start earlier elsewhere."""
    if key[0].as_py() < 0:
        return group.select(["chunk", "hashes", "ids", "starts"])  # texts and repeats of a chunk pass through
    h = [k.from_delta_planes(x.as_py()) for x in group["hashes"]]
    size = np.array([len(x) for x in h])
    h, check = np.concatenate(h), np.frombuffer(b"".join(group["checks"].to_pylist()), "<u4")
    ids, starts = (np.concatenate([k.from_planes(x.as_py()) for x in group[c]]) for c in ("ids", "starts"))
    order = np.argsort(h)
    hs = h[order]
    same = np.zeros(len(hs) + 1, bool)
    same[1:-1] = hs[1:] == hs[:-1]
    order = order[same[1:] | same[:-1]]  # only hashes that occur more than once
    order = order[np.lexsort((starts[order], ids[order], check[order], h[order]))]
    hs, cs, i, s = h[order], check[order], ids[order], starts[order]
    head = np.ones(len(hs), bool)
    head[1:] = (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])
    first = np.maximum.accumulate(np.where(head, np.arange(len(hs)), 0)) if len(hs) else np.empty(0, np.int64)
    later = np.sort(order[(i != i[first]) | (s != s[first])])
    owner = np.searchsorted(np.cumsum(size), later, side="right")
    edge = np.searchsorted(owner, np.arange(len(size) + 1))
    chunks = group["chunk"].to_pylist()
    rows = [(chunks[c], None, k.to_planes(ids[later[a:b]]), k.to_planes(starts[later[a:b]])) for c, (a, b) in enumerate(zip(edge, edge[1:], strict=False)) if a < b]
    names = ["chunk", "hashes", "ids", "starts"]
    return pa.table({n: pa.array([r[x] for r in rows], pa.binary()) for x, n in enumerate(names)})


def _merge(window: int):
    def run(group: pa.Table) -> pa.Table:
        """Of one chunk: the maximal intervals of each of its texts."""
        texts = [x for x in group["hashes"].to_pylist() if x is not None]
        own, digests = _unpack_texts(texts[0])
        ids = np.concatenate([k.from_planes(x.as_py()) for x in group["ids"]])
        starts = np.concatenate([k.from_planes(x.as_py()) for x in group["starts"]]).astype(np.int64)
        order = np.lexsort((starts, ids))
        ids, starts = ids[order], starts[order]
        at = np.argsort(_ordered(own))
        keys = _ordered(own)[at]
        left, right = np.searchsorted(ids, keys, side="left"), np.searchsorted(ids, keys, side="right")
        rows = [(int(own[t]), digests[t], _intervals(np.unique(starts[a:b]), window)) for t, a, b in zip(at, left, right, strict=True) if a < b]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], schema=_SPANS)

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rule: k.WordRule = k.SPACED) -> DataFrame:
    """Maximal intervals of words to remove: ``id``, ``digest`` (MD5 of the text), ``spans`` (from, to, from, to, ...).

    Texts without repeats have no row.  A null id is shown as the smallest long.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    full = -(-size * _SENT_A_BYTE // BUCKET_BYTES)
    buckets = max(BUCKETS_A_PARTITION * shuffle_partitions(docs.sparkSession), full)
    rows = docs.select(_key(docs, id_col).alias("id"), _digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    sent = rows.mapInArrow(_hash_windows(buckets, window, rule if rule.key else k.keyed(rule)), _SENT_DDL)
    # The texts of a chunk pass the first exchange as well; a key of their own each keeps them apart.
    dealt = sent.withColumn("bucket", F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("chunk"), F.lit(buckets))).otherwise(F.col("bucket")))
    answers = by_bucket(dealt, full).groupBy("bucket").applyInArrow(_find_first, "chunk binary, hashes binary, ids binary, starts binary")
    spans = answers.groupBy("chunk").applyInArrow(_merge(window), "id long, digest binary, spans array<long>")
    return spans


def _key(docs: DataFrame, id_col: str) -> Column:
    return F.coalesce(integral(docs, id_col), F.lit(_NULL_ID).cast("long"))


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(c, F.lit("")).cast("binary")))


def _keep(rule: k.WordRule):
    out = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.large_string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(batch.schema.get_field_index("__docloom_text")), batch.column(batch.schema.get_field_index("__docloom_spans"))
            rest = [i for i, n in enumerate(batch.schema.names) if not n.startswith("__docloom_")]
            for a, b in k.slices(texts):
                part, sp = texts.slice(a, b - a), spans.slice(a, b - a)
                data, off = k.text_buffer(part)
                w = k.words(part, rule)
                gone = np.zeros(len(w.start) + 1, np.int64)
                flat = sp.flatten().to_numpy(zero_copy_only=False)
                if len(flat):
                    row = np.repeat(np.arange(b - a), pc.fill_null(pc.list_value_length(sp), 0).to_numpy())
                    edge = flat + w.first[row]
                    np.add.at(gone, edge[0::2], 1)
                    np.add.at(gone, edge[1::2], -1)
                kept = np.cumsum(gone)[:-1] == 0
                n = np.diff(w.first)
                stay = np.diff(np.r_[0, np.cumsum(kept)][w.first])
                # Each kept word with a space after it, but for the last of a text.
                start, end, text = w.start[kept], w.end[kept], w.text[kept]
                last = np.ones(len(text), bool)
                last[:-1] = text[1:] != text[:-1]
                size = end - start + ~last
                to = np.cumsum(size)
                total = int(to[-1]) if len(to) else 0
                source = np.ones(total, np.int64)
                if total:
                    source[0] = start[0]
                    source[to[:-1]] = start[1:] - (start[:-1] + size[:-1]) + 1
                    source = np.cumsum(source)
                    new = data[np.minimum(source, len(data) - 1)]
                    new[to[~last] - 1] = 0x20
                else:
                    new = np.empty(0, np.uint8)
                offsets = np.r_[0, np.cumsum(np.bincount(text, weights=size, minlength=b - a))].astype(np.int64)
                made = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(offsets), pa.py_buffer(new.tobytes()))
                here = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([here.column(i) for i in rest] + [pa.array(n), pa.array(n - stay), made.cast(pa.string())], names=[batch.schema.names[i] for i in rest] + out.names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rule: k.WordRule = k.SPACED) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (the words that stay, joined by one space).

    See the module for nulls, repeated rows and clashing names; the column of texts itself is passed through as it is.
    """
    spans = Table(repeated_spans(docs, id_col, text_col, window, rule).dropDuplicates(["id", "digest"]), "spans")
    added = {"n_words", "n_removed", "kept_text"}
    keep = [c for c in docs.columns if c not in added]
    left = docs.select(*[F.col(f"`{c}`") for c in keep], _key(docs, id_col).alias("__docloom_id"), _digest(F.col(text_col)).alias("__docloom_digest"), F.col(text_col).alias("__docloom_text"))
    right = spans.side().select(F.col("id").alias("__docloom_id"), F.col("digest").alias("__docloom_digest"), F.col("spans").alias("__docloom_spans"))
    joined = left.join(right, ["__docloom_id", "__docloom_digest"], "left").select(*[F.col(f"`{c}`") for c in keep], "__docloom_text", "__docloom_spans")
    schema = extended(docs, keep, n_words=T.LongType(), n_removed=T.LongType(), kept_text=T.StringType())
    return joined.mapInArrow(_keep(rule), schema)
