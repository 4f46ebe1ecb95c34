"""Best-fit packing by patterns and non-negative least squares.

Texts become token ids with an end id; a longer one is cut so that only its first
piece may be shorter than a sequence.  The histogram of piece lengths is all
that the driver sees; its size is the capacity, whatever the input.  Patterns of one
to three lengths that fill a sequence are enumerated, non-negative repeat counts
are fitted to the histogram by least squares and rounded down, and fits are repeated on
what is left.  Where that leaves most of the ids, as when all texts are short, patterns of more lengths that
nearly fill a sequence are fitted too.  The residual lengths are packed best-fit over a histogram of gaps.
The plan is a list of patterns with repeat counts; a piece finds its place from
its rank among the pieces of its length, by binary search.  Ranks are counted in
hash buckets of each length, so a length that a third of all pieces have is
spread over all buckets.

Defined results: a null text is an empty one, whose only id is the end id.
Repeated rows are separate pieces; where they agree in every column the pieces
are interchangeable.  A null id is allowed.  Other columns are not carried along, so
no name clashes.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.store import Table, extended, shuffle_partitions

CAPACITY = 1024
END_ID = 2
#: Word forms whose ids a worker remembers; it starts anew beyond.
MEMO_WORDS = 200_000
FORMS_A_ROW = 200
#: Fits of repeat counts, each to what the one before has left.
ROUNDS = 8
#: How often a near-full pattern repeats its second length, at least, and for how many lengths in all patterns.
REPEATS, REPEATED = 8, 500_000

# --- tokens ---

_SPACE, _LETTER, _NUMBER, _OTHER, _UNSURE = range(5)
_CLASS_TO = 0x250


def _classes() -> np.ndarray:
    """Class of each code point below _CLASS_TO; the library itself encodes texts with others, or with rare controls."""
    out = np.full(_CLASS_TO + 1, _UNSURE, np.uint8)
    for c in range(_CLASS_TO):
        kind = unicodedata.category(chr(c))
        if c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0):
            out[c] = _SPACE
        elif kind[0] == "L":
            out[c] = _LETTER
        elif kind[0] == "N":
            out[c] = _NUMBER
        elif kind[0] != "C":
            out[c] = _OTHER
    return out


class _Numbers(dict):
    """Numbers word forms as they come; ``new``: those that have no ids yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, form: str) -> int:
        self[form] = n = len(self)
        self.new.append(form)
        return n


class Encoder:
    """Ids of a byte-level BPE tokenizer (tokenizers .json).

    The words that such a tokenizer cuts a text into are found by array operations, and the library encodes each
    word form once; a text with special strings or with characters outside the Latin blocks goes to the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        cut = spec["pre_tokenizer"] or {}
        #: Whether this is the form whose words ``_starts`` finds; the library itself encodes all texts of any other.
        self.known = spec["model"].get("type") == "BPE" and spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.classes = _classes()
        # In a byte-level vocabulary each character of an entry stands for one byte.
        self.width = np.zeros(self.library.get_vocab_size(), np.int64)
        for entry, i in self.library.get_vocab().items():
            self.width[i] = len(entry)
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.ids = [np.empty(0, np.uint32)]
        self.size = [np.empty(0, np.int64)]
        self.flat: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins."""
        data, off = k.text_buffer(column)
        n = len(off) - 1
        whole = data.tobytes().decode()
        point = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each code point
        first = np.searchsorted(at, off)
        kind = self.classes[np.minimum(point, _CLASS_TO)]
        odd = np.flatnonzero(kind == _UNSURE)
        alone = np.zeros(n, bool)
        alone[np.searchsorted(first, odd, side="right") - 1] = True
        alone |= not self.known
        for s in self.special:
            if s in whole:
                for i in range(n):
                    alone[i] |= s in whole[first[i] : first[i + 1]]
        starts = self._starts(point, kind, first)
        begin = np.r_[at, len(data)][starts]
        text = np.searchsorted(off, begin, side="right") - 1
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.r_[begin, len(data)].astype(np.int64)), pa.py_buffer(data)) if len(begin) else pa.array([], pa.large_string())
        coded = words.dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(begin) else np.empty(0, np.int64)
        ids, start, size = self._tables()
        keep = ~alone[text]
        if not keep.all():
            number, text = number[keep], text[keep]
        many = size[number]
        total = np.bincount(text, weights=many, minlength=n).astype(np.int64)
        to = np.cumsum(many)
        out = ids[np.repeat(start[number] - (to - many), many) + np.arange(to[-1] if len(to) else 0)]
        if not alone.any():
            return out, np.r_[0, np.cumsum(total)]
        edge = np.r_[0, np.cumsum(total)]
        parts = [out[edge[i] : edge[i + 1]] if not alone[i] else np.array(self.library.encode(whole[first[i] : first[i + 1]], add_special_tokens=False).ids, np.uint32) for i in range(n)]
        return np.concatenate([np.empty(0, np.uint32), *parts]), np.r_[0, np.cumsum([len(p) for p in parts])]

    def _starts(self, point: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Code points at which a word begins."""
        m = len(point)
        if m == 0:
            return np.empty(0, np.int64)
        edge = np.zeros(m + 1, bool)
        edge[first] = True
        edge[0] = edge[m] = True
        run = edge.copy()
        run[1:m] |= kind[1:] != kind[:-1]
        begins = run[:m].copy()
        blank = point == 0x20
        # One space before another kind of run belongs to that run; other white space that is followed keeps its last alone.
        last_white = np.zeros(m, bool)
        last_white[:-1] = (kind[:-1] == _SPACE) & run[1:m] & ~edge[1:m]
        joined = np.zeros(m, bool)
        joined[1:] = begins[1:] & (kind[1:] != _SPACE) & blank[:-1] & ~edge[1:m]
        begins[joined] = False
        begins |= last_white
        # An apostrophe alone, no space before it, takes s, t, m, d, re, ve or ll from the letters after it.
        lone = np.flatnonzero(begins & (point == 0x27) & run[1:])
        lone = lone[(lone + 1 < m) & ~edge[np.minimum(lone + 1, m)]]
        if len(lone):
            a = point[lone + 1]
            b = np.where((lone + 2 < m) & ~edge[np.minimum(lone + 2, m)], point[np.minimum(lone + 2, m - 1)], 0)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for at, size in ((lone[one], 1), (lone[two], 2)):
                begins[at + 1] = False
                rest = at + 1 + size
                rest = rest[rest < m]
                begins[rest] |= (kind[rest] == _LETTER) & ~edge[rest]
        return np.flatnonzero(begins)

    def _numbers(self, forms: list[str]) -> np.ndarray:
        if len(self.number) > MEMO_WORDS:
            self.clear()
        out = np.fromiter(map(self.number.__getitem__, forms), np.int64, len(forms))
        if new := self.number.new:
            # A space before a form that holds no other white space ends the form before it: such forms are encoded
            # in rows, and told apart by the bytes of their ids.
            spaced = [f[0] == " " and len(f) > 1 and not f[1].isspace() for f in new]
            size = np.zeros(len(new), np.int64)
            place, ids = [], []
            for together in (True, False):
                at = [i for i, x in enumerate(spaced) if x is together]
                step = FORMS_A_ROW if together else 1
                rows = ["".join(new[i] for i in at[j : j + step]) for j in range(0, len(at), step)]
                made = [e.ids for e in self.library.encode_batch_fast(rows, add_special_tokens=False)]
                flat = np.fromiter(chain.from_iterable(made), np.int64)
                if together:
                    end = np.cumsum([len(new[i].encode()) for i in at])
                    to = np.searchsorted(np.cumsum(self.width[flat]), end) + 1
                    size[at] = np.diff(np.r_[0, to])
                else:
                    size[at] = np.fromiter(map(len, made), np.int64, len(made))
                place += at
                ids.append(flat)
            order = np.argsort(np.array(place, np.int64))
            flat = np.concatenate(ids)
            many = size[place]
            start = (np.cumsum(many) - many)[order]
            to = np.cumsum(size)
            self.size.append(size)
            self.ids.append(flat[np.repeat(start - (to - size), size) + np.arange(len(flat))].astype(np.uint32))
            self.flat, self.number.new = None, []
        return out

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.flat is None:
            self.ids, self.size = [np.concatenate(self.ids)], [np.concatenate(self.size)]
            self.flat = (self.ids[0], np.cumsum(self.size[0]) - self.size[0], self.size[0])
        return self.flat


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _cut(path: str, capacity: int, end_id: int):
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            for a, b in k.slices(batch.column(1), 3 * k.SLICE_BYTES):
                ids, first = made.encode(batch.column(1).slice(a, b - a))
                with_end = np.insert(ids, first[1:], end_id).astype("<u4")
                first = first + np.arange(len(first))
                size = np.diff(first)
                pieces = -(-size // capacity)
                doc = np.repeat(np.arange(b - a), pieces)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                short = (size - 1) % capacity + 1  # of the first piece
                start = np.where(number == 0, 0, short[doc] + (number - 1) * capacity)
                length = np.where(number == 0, short[doc], capacity)
                # Pieces tile the ids, so their bytes are a view of them.
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(np.r_[0, np.cumsum(length)].astype(np.int64) * 4), pa.py_buffer(with_end)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), blob.cast(pa.binary())], names=names)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all texts: ``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id), f"doc_id {kind}, piece int, start long, length long, ids binary")


# --- the plan ---


def _patterns(present: np.ndarray, capacity: int, depth: int) -> np.ndarray:
    """Patterns of up to ``depth`` present lengths that fill a sequence, or come as near as their last length allows; 0 pads."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    below = np.maximum.accumulate(np.where(have, np.arange(capacity + 1), 0))  # the largest present length up to each
    out = [np.stack([present, np.zeros_like(present), np.zeros_like(present)], 1)]
    if depth >= 2:
        b = below[capacity - present]
        out.append(np.stack([present, b, np.zeros_like(b)], 1)[b > 0])
    if depth >= 3:
        i, j = np.triu_indices(len(present))
        x, y = present[i], present[j]
        ok = x + y < capacity
        x, y = x[ok], y[ok]
        z = below[capacity - x - y]
        ok = (z > 0) & (z <= x)  # each triple once, its smallest last among equals
        out.append(np.stack([x, y, z], 1)[ok])
    made = np.sort(np.concatenate(out), axis=1)[:, ::-1]
    return np.unique(made, axis=0)


def _near_full(present: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns of a present length, another as often as fits, as ``REPEATS`` and ``REPEATED`` allow, and the largest that fit until none does; 0 pads."""
    below = np.zeros(capacity + 1, np.int64)
    below[present] = present
    below = np.maximum.accumulate(below)
    x, y = (v.ravel() for v in np.meshgrid(present, present))
    x, y = x[x + y <= capacity], y[x + y <= capacity]
    made, gap = [x], capacity - x
    for _ in range(min(capacity // int(present.min()), max(REPEATS, REPEATED // max(1, len(x))))):
        made.append(np.where(y <= gap, y, 0))
        gap = gap - made[-1]
    while below[gap].any():
        made.append(below[gap])
        gap = gap - made[-1]
    return np.unique(np.sort(np.stack(made, 1), axis=1)[:, ::-1], axis=0)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative repeat counts whose lengths come closest to the histogram: accelerated projected gradient steps.

    Each residual is weighted by the root of its length, as a long piece left over costs more.
    """
    capacity = len(histogram) - 1
    weight = np.sqrt(np.arange(capacity + 1) / capacity)
    weight[0] = 0
    goal = histogram * weight
    use = weight[patterns]

    def lengths(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns.ravel(), weights=np.repeat(x, patterns.shape[1]), minlength=capacity + 1) * weight

    x = np.zeros(len(patterns))
    bound = 1.0  # the largest eigenvalue, by power iteration
    v = np.ones(len(patterns))
    for _ in range(20):
        v = (lengths(v)[patterns] * use).sum(1)
        bound = float(np.sqrt((v * v).sum()))
        v /= bound
    y, t = x, 1.0
    for _ in range(steps):
        gradient = ((lengths(y) - goal)[patterns] * use).sum(1)
        new = np.maximum(0, y - gradient / (1.05 * bound))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / s * (new - x), new, s
    return x


def _take(patterns: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Repeat counts rounded down, as far as the histogram holds, longest lengths first; what they use is taken from it."""
    plan = []
    whole = np.floor(x + 1e-6).astype(np.int64)
    for i in np.flatnonzero(whole)[::-1]:  # patterns are in order of their longest lengths
        lengths = [int(v) for v in patterns[i] if v]
        need = {v: lengths.count(v) for v in lengths}
        n = min(int(whole[i]), *(int(left[v]) // c for v, c in need.items()))
        if n > 0:
            plan.append((tuple(lengths), n))
            for v, c in need.items():
                left[v] -= n * c
    return plan


def _best_fit(left: np.ndarray, plan: Sequence[tuple[tuple[int, ...], int]] = ()) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing, into the gaps of a plan (if any) first, over groups of equal sequences: its work follows the capacity, not the number of pieces."""
    capacity = len(left) - 1
    groups: list[list[list]] = [[] for _ in range(capacity + 1)]  # by gap: [lengths, how many]
    for planned, many in plan:
        groups[capacity - sum(planned)].append([planned, many])
    for v in range(capacity, 0, -1):
        n = int(left[v])
        gap = v
        while n and gap <= capacity:
            while n and groups[gap]:
                lengths, many = groups[gap].pop()
                fits = gap // v  # several of one length may go into one sequence
                take = min(many, n // fits) if n >= fits else 0
                if take == 0:
                    fits, take = n, 1
                groups[gap - fits * v].append([(*lengths, *[v] * fits), take])
                if many > take:
                    groups[gap].append([lengths, many - take])
                n -= fits * take
                if gap - fits * v == gap:
                    break
            gap += 1
        if n:
            fits = capacity // v
            if n >= fits:
                groups[capacity - fits * v].append([(v,) * fits, n // fits])
            if n % fits:
                groups[capacity - (n % fits) * v].append([(v,) * (n % fits), 1])
    return [(tuple(x), n) for g in groups for x, n in g]


def plan_packing(histogram: np.ndarray, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeat counts that hold exactly the pieces of a histogram (index: length)."""
    left = histogram.astype(np.int64).copy()
    capacity = len(left) - 1
    plan: list[tuple[tuple[int, ...], int]] = []
    total = int(np.arange(capacity + 1) @ left)
    for full in (True, False):
        # Near-full patterns of any depth are fitted where full ones leave most of the ids, as when all pieces are short.
        if not full and 2 * int(np.arange(capacity + 1) @ left) <= total:
            break
        for _ in range(ROUNDS):
            present = np.flatnonzero(left)
            if not len(present):
                break
            if full:
                patterns = _patterns(present, capacity, depth)
                patterns = patterns[patterns.sum(1) == capacity]
            else:
                patterns = _near_full(present, capacity)
            if not len(patterns):
                break
            repeats = fit_repeats(patterns, left.astype(float))
            if not full:
                # Spread over many patterns, each repeat alone rounds down to none: running sums are rounded instead.
                repeats = np.diff(np.floor(np.cumsum(repeats) + 1e-6), prepend=0)
            more = _take(patterns, repeats, left)
            plan += more
            if not more:
                break
    return _best_fit(left, plan)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each place of each pattern: its length, the rank it begins at, the first sequence of the pattern, the offset."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for v in lengths:
            rows.append((v, rank.get(v, 0), sequence, offset))
            rank[v] = rank.get(v, 0) + n
            offset += v
        sequence += n
    rows.sort()
    return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 4


def _place(slots: tuple[np.ndarray, ...], length_at: int, rank_at: int, keep: list[int], names: list[str]):
    length, begin, sequence, offset = slots
    starts = np.searchsorted(length, np.arange((int(length.max()) if len(length) else 0) + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, r = batch.column(length_at).to_numpy(), batch.column(rank_at).to_numpy()
            at = np.empty(len(v), np.int64)
            for x in np.unique(v):
                m, lo, hi = v == x, starts[x], starts[x + 1]
                at[m] = lo + np.searchsorted(begin[lo:hi], r[m], side="right") - 1
            made = [pa.array(sequence[at] + r - begin[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + made, names=names)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: pieces share sequences of at most ``capacity`` ids without gaps."""
    spark = pieces.sparkSession
    stored = Table(pieces, "pieces")
    counted = {r["length"]: r["n"] for r in stored.df.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(capacity + 1, np.int64)
    for v, n in counted.items():
        histogram[v] = n
    slots = _slots(plan_packing(histogram))
    buckets = max(64, 4 * shuffle_partitions(spark))
    order = ["doc_id", "piece", *[c for c in stored.df.columns if c not in ("doc_id", "piece")]]
    dealt = stored.df.withColumn("__docloom_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "__docloom_bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__docloom_bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = Table(sizes.select("length", "__docloom_bucket", F.coalesce(before, F.lit(0)).alias("__docloom_before")), "ranks")
    own = F.row_number().over(Window.partitionBy("length", "__docloom_bucket").orderBy(*order)).cast("long")
    ranked = dealt.withColumn("__docloom_own", own).join(sizes.side(), ["length", "__docloom_bucket"]).withColumn("__docloom_rank", F.col("__docloom_before") + F.col("__docloom_own") - 1)
    ranked = ranked.select(*stored.df.columns, "__docloom_rank")
    names = ranked.columns
    keep = [i for i, c in enumerate(names) if c != "__docloom_rank"]
    schema = extended(stored.df, stored.df.columns, sequence_id=T.LongType(), offset=T.LongType())
    return ranked.mapInArrow(_place(slots, names.index("length"), names.index("__docloom_rank"), keep, [*stored.df.columns, "sequence_id", "offset"]), schema)
