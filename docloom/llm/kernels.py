"""Vectorised text kernels shared by the corpus operators.

Every kernel works on the raw UTF-8 buffer of an Arrow string column: words
are found by a byte class and hashed eight bytes at a time, and n-grams are
Rabin-Karp hashes (polynomials modulo 2**64 over word hashes).  Nothing is done
per row in Python, so a pass over text costs a few nanoseconds a byte.

Words are hashed in a chain of keyed mixing steps, not by a polynomial, so no two
words collide by their form; the key, drawn anew for each call of an operator
(``keyed``), keeps anyone from making up words that do.  Polynomials run over
such hashes only, and over fewer terms than the modulus has structure for (1,024).

Nulls count as empty texts.  Memory follows the slice of text handed in; use
``slices`` to cut a batch into pieces of bounded size (a single longer text
is a piece of its own).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one kernel call works on, unless a single text is longer.
SLICE_BYTES = 1_000_000

_U = np.uint64
_GRAM_BASES = (0xC2B2AE3D27D4EB4D, 0x9E3779B97F4A7C15)
#: Words of more bytes than this are hashed one by one, by BLAKE2.
_CHAIN_BYTES = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n + 1:
        size = max(n + 1, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, dtype=np.uint64)
            row[0] = 1
            out.append(np.cumprod(row, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have


class WordRule(NamedTuple):
    """Which bytes belong to words, what each byte is folded to, and the key of the hashes."""

    is_word: np.ndarray
    fold: np.ndarray
    key: int = 0


def keyed(rule: WordRule) -> WordRule:
    """``rule`` with a key of its own; all passes that compare hashes with each other use one."""
    return rule._replace(key=int.from_bytes(os.urandom(8), "little"))


def word_rule(separators: str, lower: bool) -> WordRule:
    """``separators``: "space" for ASCII white space, "alnum" for every ASCII byte but 0-9, A-Z, a-z."""
    code = np.arange(256)
    if separators == "space":
        is_word = ~((code == 0x20) | ((code >= 0x09) & (code <= 0x0D)))
    elif separators == "alnum":
        is_word = (code >= 0x80) | ((code >= 0x30) & (code <= 0x39)) | ((code >= 0x41) & (code <= 0x5A)) | ((code >= 0x61) & (code <= 0x7A))
    else:
        raise ValueError(separators)
    fold = code.copy()
    if lower:
        fold[0x41:0x5B] += 32
    return WordRule(is_word, fold.astype(np.uint8))


SPACED = word_rule("space", lower=False)
SPACED_LOWER = word_rule("space", lower=True)
ALNUM_LOWER = word_rule("alnum", lower=True)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each begins (one more than there are texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column whose texts hold about ``most`` bytes at the most."""
    n = len(column)
    if n == 0:
        return
    _, off = text_buffer(column)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


class Words(NamedTuple):
    """All words of a slice, in order: the text each is in, its bytes, its hash; ``first``: of each text, and the end.  ``data`` is folded."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    data: np.ndarray


_LOW = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, as one number; zeros follow the end."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int) -> np.ndarray:
    """A keyed hash of each word, eight bytes a step; equal bytes get equal hashes under one key."""
    size = end - start
    at8 = eights(data)
    k1, k2 = mix(np.array([key, key ^ 0xD6E8FEB86659FD93], np.uint64) + _U(0x9E3779B97F4A7C15))
    k2 |= _U(1)
    h = mix((at8[start] & _LOW[np.minimum(size, 8)]) ^ k1)
    live = np.flatnonzero((size > 8) & (size <= _CHAIN_BYTES))
    done = 8
    while len(live):
        rest = size[live] - done
        x = at8[start[live] + done] & _LOW[np.minimum(rest, 8)]
        h[live] = mix((h[live] * k2) ^ mix(x + k1))
        live = live[rest > 8]
        done += 8
    for i in np.flatnonzero(size > _CHAIN_BYTES).tolist():
        raw = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=key.to_bytes(8, "little")).digest()
        h[i] = int.from_bytes(raw, "little")
    return mix(h ^ (size.astype(np.uint64) * k2))


def same_words(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether pairs of words of two folded buffers hold the same bytes."""
    size = a_end - a_start
    same = size == b_end - b_start
    x8, y8 = eights(a), eights(b)
    live, done = np.flatnonzero(same), 0
    while len(live):
        rest = size[live] - done
        low = _LOW[np.minimum(rest, 8)]
        ok = (x8[a_start[live] + done] & low) == (y8[b_start[live] + done] & low)
        same[live[~ok]] = False
        live = live[ok & (rest > 8)]
        done += 8
    return same


def words(column: pa.Array, rule: WordRule) -> Words:
    data, off = text_buffer(column)
    n = len(off) - 1
    if len(data) == 0:
        z = np.empty(0, np.int64)
        return Words(z, z, z, np.empty(0, np.uint64), np.zeros(n + 1, np.int64), data)
    inside = rule.is_word[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[off] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    folded = rule.fold[data]
    hashes = word_hashes(folded, start, end, rule.key)
    text = np.searchsorted(off, start, side="right") - 1
    first = np.searchsorted(text, np.arange(n + 1))
    return Words(text, start, end, hashes, first, folded)


def gram_hashes(hashes: np.ndarray, n: int, second: bool = False) -> np.ndarray:
    """Rabin-Karp hashes of all runs of n hashes, to one base or another; runs across texts are for the caller to leave out."""
    m = len(hashes)
    if m < n:
        return np.empty(0, np.uint64)
    power, inverse = _power_tables(_GRAM_BASES[second], m)
    total = np.zeros(m + 1, np.uint64)
    np.cumsum(hashes * power[:m], out=total[1:])
    return mix((total[n:] - total[: m - n + 1]) * inverse[: m - n + 1] + _U(n))


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of every run of n words that lies in one text."""
    h = gram_hashes(w.hash, n)
    at = np.flatnonzero(w.text[: len(h)] == w.text[n - 1 :]) if len(h) else np.empty(0, np.int64)
    return at, h[at]


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text: text numbers (ascending) and hashes (ascending in a text).

    A text of fewer words, but not none, has its whole sequence as its one shingle.
    """
    at, h = grams(w, n)
    text = w.text[at]
    size = np.diff(w.first)
    for i in np.flatnonzero((size > 0) & (size < n)):
        a, b = w.first[i], w.first[i + 1]
        text = np.append(text, i)
        h = np.append(h, gram_hashes(w.hash[a:b], int(b - a)))
    order = np.argsort(text, kind="stable") if (size[size > 0] < n).any() else slice(None)
    text, h = text[order], h[order]
    edge = np.searchsorted(text, np.arange(len(size) + 1))
    for a, b in zip(edge.tolist(), edge[1:].tolist(), strict=False):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def to_planes(values: np.ndarray) -> bytes:
    """Unsigned values as eight byte planes, lowest bytes first: planes of small values are zeros, which shuffles compress away."""
    v = np.ascontiguousarray(values, dtype="<u8")
    return v.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(raw.T).view("<u8").ravel()


def delta_planes(ascending: np.ndarray) -> bytes:
    """Ascending unsigned values as planes of their differences."""
    v = ascending.astype(np.uint64)
    return to_planes(np.concatenate([v[:1], v[1:] - v[:-1]]))


def from_delta_planes(blob: bytes) -> np.ndarray:
    return np.cumsum(from_planes(blob), dtype=np.uint64)


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64) if values.dtype == np.uint64 else values


def binary_column(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
