"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled
text.  A text is parsed greedily into the longest phrases that occur in the
sample; the language that needs the fewest phrases a symbol wins.

Automata are made on the driver from at most ``SAMPLE_DOCS`` labelled rows of each
language, read whole: those whose ids hash lowest among texts of up to ``SAMPLE_CHARS`` characters, then, where these are too few,
the shortest of the longer ones, as long as the rows before hold less than ``SAMPLE_DOCS * SAMPLE_CHARS`` characters.
Their rows of transitions are laid over each other in one array, so its size follows the sample
and not the alphabet; a missing transition starts a new phrase.  Texts advance in lockstep, one symbol at a time for
all languages of a block (``LANGUAGES``).

A long text is parsed in segments side by side, each as if a phrase began there, and put together exactly: the
parse of one segment goes on into the next until both begin a phrase at one symbol, from where they agree.
A text where that does not happen within a segment is parsed in one piece.

Symbols: ASCII letters in lower case, every byte of other characters, and one
symbol for a run of anything else.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no language was learned (``drop_unknown`` then goes by letters alone).  Ties go to the language that sorts
first.  Repeated rows get equal results.  Columns that clash with ``lang_pred``,
``score`` or ``phrases_a_symbol`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.store import extended, put_back, set_aside

#: Labelled rows of each language that are learned from, and the length up to which a row is taken for its hash alone.
SAMPLE_DOCS = 24
SAMPLE_CHARS = 4_000
#: Symbols that are parsed side by side with others, and languages at a time; neither changes a result.
SEGMENT = 2_048
LANGUAGES = 8

_FOLD = np.zeros(256, np.uint8)
_FOLD[:] = 0x20
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of all texts, runs of white symbols as one, and where each text begins."""
    data, off = k.text_buffer(column)
    s = _FOLD[data]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0x20) | (s[:-1] != 0x20)
    keep[off[:-1][off[:-1] < len(s)]] = True
    return s[keep], np.r_[0, np.cumsum(keep)][off]


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of a text (its suffix automaton)."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return step


class _Transitions:
    """Rows of transitions laid over each other in one array: a state is the place where its row begins, and a cell that it finds
    there is its own if it says so.  The array follows the number of transitions, not that of states by symbols."""

    def __init__(self, rows: list[dict[int, int]], width: int):
        """``rows``: for each state the state that each symbol's code leads to."""
        many = np.array([len(r) for r in rows], np.int64)
        codes = np.fromiter((c for r in rows for c in r), np.int64)
        to = np.fromiter((x for r in rows for x in r.values()), np.int64)
        first = np.cumsum(many) - many
        size = 2 * len(codes) + 4 * width + len(rows)
        owner = np.full(size + width, -1, np.int64)
        who = np.full(size, -1, np.int64)  # the state that begins at a place
        base = np.zeros(len(rows), np.int64)
        rng = np.random.default_rng(0)
        for n in np.unique(many)[::-1]:  # long rows first, while there is room
            todo = np.flatnonzero(many == n)
            mine = codes[first[todo][:, None] + np.arange(n)] if n else np.empty((len(todo), 0), np.int64)
            while len(todo):
                place = rng.integers(0, size, len(todo))
                cells = place[:, None] + mine
                ok = np.flatnonzero((owner[cells] < 0).all(axis=1) & (who[place] < 0))
                owner[cells[ok]] = todo[ok][:, None]
                who[place[ok]] = todo[ok]
                won = (owner[cells[ok]] == todo[ok][:, None]).all(axis=1) & (who[place[ok]] == todo[ok])
                lost = ok[~won]
                gone = cells[lost]
                owner[gone[owner[gone] == todo[lost][:, None]]] = -1
                who[place[lost][who[place[lost]] == todo[lost]]] = -1
                base[todo[ok[won]]] = place[ok[won]]
                rest = np.ones(len(todo), bool)
                rest[ok[won]] = False
                todo, mine = todo[rest], mine[rest]
        self.base = base
        self.begin = size  # a row of its own without a cell
        self.cells = np.full(size + width, -1, np.int64)
        self.cells[np.repeat(base, many) + codes] = (np.repeat(base, many) << 32) | base[to]


class Model:
    """Automata of all languages: transitions from a state by a symbol, and where each symbol leads that begins a phrase."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        joined = {}
        for name in self.languages:
            parts = []
            for raw in samples[name]:
                s, _ = symbols(pa.array([raw.decode("utf-8", "ignore")], pa.large_string()))
                parts.append(s.tobytes())
            joined[name] = b" ".join(parts)
        used = sorted({c for x in joined.values() for c in x})
        self.code = np.zeros(256, np.int64)  # 0: in no sample
        self.code[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        self.moves, self.root = [], []  # of each block of languages
        for first in range(0, len(self.languages), LANGUAGES):
            rows, begins = [], []
            for name in self.languages[first : first + LANGUAGES]:
                step, base = suffix_automaton(joined[name]), len(rows)
                rows += [{int(self.code[c]): to + base for c, to in row.items()} for row in step]
                begins.append(base)
            moves = _Transitions(rows, self.width)
            root = np.full((len(begins), self.width), moves.begin, np.int64)
            for i, base in enumerate(begins):
                for c, to in rows[base].items():
                    root[i, c] = moves.base[to]
            self.moves.append(moves)
            self.root.append(root.ravel())

    def _step(self, block: int, language: np.ndarray, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase began.  ``language``: of the block, times the width."""
        cell = self.moves[block].cells.take(state + code)
        known = (cell >> 32) == state
        return np.where(known, cell & 0xFFFFFFFF, self.root[block].take(language + code)), ~known

    def phrases(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, and for each text and language the phrases that its parse needs."""
        s, off = symbols(column)
        code = self.code[s]
        parts = [self._block(block, code, off) for block in range(len(self.moves))]
        return np.diff(off), np.concatenate(parts, axis=1) if parts else np.zeros((len(off) - 1, 0), np.int64)

    def _parse(self, block: int, code: np.ndarray, start: np.ndarray, length: np.ndarray, begun: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and last states of pieces, each parsed from the beginning; ``begun`` is told at which symbols phrases begin."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        language = (np.arange(len(self.root[block]) // self.width) * self.width)[:, None]
        count = np.zeros((len(language), len(start)), np.int64)
        state = np.full((len(language), len(start)), self.moves[block].begin, np.int64)
        longest = int(length[0]) if len(length) else 0
        still = np.searchsorted(-length, -np.arange(longest))  # pieces that are longer than t
        for t, live in enumerate(still.tolist()):
            at = start[:live] + t
            state[:, :live], new = self._step(block, language, state[:, :live], code.take(at))
            count[:, :live] += new
            if begun is not None:
                begun[:, at] = new
        back = np.argsort(order)
        return count[:, back], state[:, back]

    def _block(self, block: int, code: np.ndarray, off: np.ndarray) -> np.ndarray:
        size = np.diff(off)
        n, langs = len(size), len(self.root[block]) // self.width
        pieces = -(-size // SEGMENT)
        text = np.repeat(np.arange(n), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = off[text] + number * SEGMENT
        length = np.minimum(SEGMENT, off[text + 1] - start)
        begun = np.zeros((langs, len(code)), bool) if (pieces > 1).any() else None
        count, state = self._parse(block, code, start, length, begun)
        out = np.zeros((n, langs), np.int64)
        np.add.at(out, text, count.T)
        if begun is None:
            return out
        # Where a segment's true parse, which comes from the one before, differs from its own until they meet.
        later = np.flatnonzero(number > 0)
        row, piece = (x.ravel() for x in np.meshgrid(np.arange(langs), later, indexing="ij"))
        now = state[row, piece - 1]
        apart = np.zeros(n, bool)
        for t in range(SEGMENT + 1):
            over = t >= length[piece]
            if over.any():  # not met in this segment, which is no matter at a text's end
                apart[text[piece[over & (number[piece] + 1 < pieces[text[piece]])]]] = True
                row, piece, now = row[~over], piece[~over], now[~over]
            if not len(row):
                break
            at = start[piece] + t
            now, new = self._step(block, row * self.width, now, code[at])
            own = begun[row, at]
            go = ~(new & own)
            np.add.at(out, (text[piece[go]], row[go]), new[go].astype(np.int64) - own[go])
            row, piece, now = row[go], piece[go], now[go]
        whole = np.flatnonzero(apart)
        if len(whole):
            out[whole] = self._parse(block, code, off[whole], size[whole])[0].T
        return out


def _predict(shared, text_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for a, b in k.slices(batch.column(text_at), 4 * k.SLICE_BYTES):
                here = batch.slice(a, b - a)
                texts = here.column(text_at)
                lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
                if model.languages:
                    size, phrases = model.phrases(texts)
                    rate = phrases / np.maximum(size, 1)[:, None]
                    best = rate.argmin(axis=1)
                    least = rate[np.arange(len(rate)), best]
                    rate[np.arange(len(rate)), best] = np.inf
                    second = rate.min(axis=1) if len(model.languages) > 1 else np.maximum(least, 1)
                    score = np.clip(np.where(second > 0, 1 - least / np.where(second > 0, second, 1), 0), 0, 1)
                    lang = np.array(model.languages, object)[best]
                else:
                    lettered = np.zeros(b - a, bool)
                    lang, score, least = np.full(b - a, "und", object), np.zeros(b - a), np.zeros(b - a)
                lang = np.where(lettered, lang, "und")
                made = [pa.array(lang, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(np.where(lettered, least, 1.0))]
                yield pa.RecordBatch.from_arrays([here.column(i) for i in keep] + made, names=names)

    return run


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs: int = SAMPLE_DOCS, size: int = SAMPLE_CHARS) -> Model:
    """A model of a bounded sample of whole rows: of each language ``docs`` texts, chosen by hash among those of up to ``size`` characters, then by length."""
    n = F.char_length("text")
    rows = labelled.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{id_col}`")).alias("h")).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy(F.when(n <= size, 0).otherwise(n), "h", "text")
    chosen = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= docs)
    before = F.sum(F.char_length("text")).over(Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    sample = chosen.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < docs * size).collect()
    samples: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r.lang, r.n)):
        samples.setdefault(r.lang, []).append(r.text.encode())
    return Model(samples)


ADDED = ("lang_pred", "score", "phrases_a_symbol")


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1: by how much the best language beats the next) and ``phrases_a_symbol``."""
    keep = [i for i, c in enumerate(docs.columns) if c not in ADDED]
    names = [docs.columns[i] for i in keep]
    schema = extended(docs, names, lang_pred=T.StringType(), score=T.DoubleType(), phrases_a_symbol=T.DoubleType())
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared, docs.columns.index(text_col), keep, [*names, *ADDED]), schema)


def fold_of(id_col: Column, folds: int = 4) -> Column:
    """crc32 of an id as text, modulo the number of folds; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def drop_unknown(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_out: int = 2) -> DataFrame:
    """``docs`` with the predicted language where theirs is null, and without texts that have none: those that ``identify`` calls ``und`` for
    want of a letter, nulls and empty ones too.

    Nothing else goes: without any labelled row, texts with a letter all stay, and null languages stay null.
    """
    fold = fold_of(F.col(f"`{id_col}`"), folds)
    model = learn(docs.filter(F.coalesce(fold, F.lit(0)) != held_out), id_col, text_col, lang_col)
    lettered = docs.filter(F.col(f"`{text_col}`").rlike(r"\p{L}"))
    if not model.languages:
        return lettered
    found = identify(set_aside(lettered, ADDED), model, text_col).filter(F.col("lang_pred") != "und")
    own = f"__docloom_kept_{lang_col}" if lang_col in ADDED else lang_col
    filled = F.coalesce(F.col(f"`{own}`"), F.col("lang_pred").cast(docs.schema[lang_col].dataType))
    return put_back(found.withColumn(own, filled), docs.columns, ADDED)
