"""Chat formatting in budgeted windows.

Conversations become windows of whole turns.  Prefix sums of the tokens of formatted turns (marks, role and escaped text) choose
each window's span: the longest run of new turns that fits the budget beside the
system turn, which every window repeats, and a limited history, the last turns before the span
that fit ``history`` tokens.  Assistant turns of the span are under the loss mask;
those of the repeated head are not, so each target counts once.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and roles a backslash is doubled and ``<|``
becomes ``<\\|`` (a role's line feed becomes ``\\n``), so no text holds a control string and reading back is exact.

Rows are dealt by conversation and sorted by turn; a task streams through them and keeps
one window at a time, so a conversation of any length needs bounded memory.

Defined results: null texts and roles are empty.  Equal turn numbers are ordered by role, then text, and
repeated rows are turns each; null numbers come first; a null conversation id is a conversation.
A turn that does not fit beside the system turn has a window without it; only one longer than the budget itself has a window
over the budget.  Ids and turn numbers are whole numbers; others are refused.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import kernels as k
from docloom.llm.packing import encoder
from docloom.llm.store import integral, shuffle_partitions

BUDGET = 1024
HISTORY = 256
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out, at = [], 0
    while (i := text.find("\\", at)) >= 0:
        c = text[i + 1 : i + 2]
        out += [text[at:i], "\n" if c == "n" else c]
        at = i + 2
    return "".join([*out, text[at:]])


def _head(role: str) -> str:
    return f"{START}{escape(role).replace(chr(10), chr(92) + 'n')}\n"


def _formatted(role: str, text: str) -> str:
    return f"{_head(role)}{escape(text)}{END}\n"


class _Windows:
    """The windows of one conversation, made as its turns come."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: list[tuple[str, str, int]] = []
        self.head: list[tuple[str, str, int]] = []  # the system turn, if the open window repeats it
        self.past: list[tuple[str, str, int]] = []  # turns that the next window may repeat
        self.span: list[tuple[str, str, int]] = []
        self.prefix = 0  # tokens of the open window
        self.number = self.seen = 0

    def add(self, role: str, text: str, tokens: int) -> list[tuple]:
        turn = (role, text, tokens)
        out = []
        if self.span and self.prefix + tokens > self.budget:
            out = self.close()
        if not self.span:
            self._open(tokens)
        self.span.append(turn)
        self.prefix += tokens
        return out

    def _open(self, tokens: int) -> None:
        base = sum(t[2] for t in self.system)
        self.head = self.system if base + tokens <= self.budget else []
        base = base if self.head else 0
        room = min(self.history, self.budget - base - tokens)
        sums = np.cumsum([t[2] for t in reversed(self.past)])
        n = int(np.searchsorted(sums, room, side="right")) if room > 0 else 0
        self.past = self.past[len(self.past) - n :] if n else []
        self.prefix = base + (int(sums[n - 1]) if n else 0)

    def close(self) -> list[tuple]:
        if not self.span:
            return []
        repeated = self.head + self.past
        parts, spans, at = [], [], 0
        for i, (role, text, _) in enumerate(repeated + self.span):
            head, body = _head(role), escape(text)
            at += len(head)
            if role == "assistant" and i >= len(repeated):
                spans += [at, at + len(body)]
            parts.append(f"{head}{body}{END}\n")
            at += len(body) + len(END) + 1
        row = (self.conv_id, self.number, "".join(parts), spans, len(repeated), len(self.span), self.prefix)
        if self.number == 0 and self.span[0][0] == "system":
            self.system = self.span[:1]
            rest = self.span[1:]
        else:
            rest = self.span
        # Only as much of the past is kept as the next window may repeat.
        self.past = self.past + rest
        total = 0
        for i in range(len(self.past), 0, -1):
            total += self.past[i - 1][2]
            if total > self.history:
                self.past = self.past[i:]
                break
        self.number += 1
        self.span, self.prefix = [], 0
        return [row]


def _format(tokenizer_path: str, budget: int, history: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Windows | None = None
        for batch in batches:
            for a, b in k.slices(batch.column(3)):
                here = batch.slice(a, b - a)
                roles, texts = here.column(2).to_pylist(), here.column(3).to_pylist()
                # A turn ends in a line feed and the next begins with a mark, between which this tokenizer always cuts, so tokens of turns add up.
                _, first = encoder(tokenizer_path).encode(pa.array(map(_formatted, roles, texts), pa.large_string()))
                rows = []
                for conv, role, text, n in zip(here.column(0).to_pylist(), roles, texts, np.diff(first).tolist(), strict=True):
                    if open_ is None or open_.conv_id != conv:
                        rows += open_.close() if open_ else []
                        open_ = _Windows(conv, budget, history)
                    rows += open_.add(role, text, n)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
        if open_ and (rows := open_.close()):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def format_windows(turns: DataFrame, tokenizer_path: str, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``window``, ``formatted``, ``loss_spans`` (code points, flat), ``n_repeated``, ``n_turns`` (new ones), ``n_tokens``.

    The windows of a conversation are in one partition, in order.
    """
    rows = turns.select(integral(turns, conv_col).alias("conv_id"), integral(turns, turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = rows.repartition(shuffle_partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.int64())), ("n_repeated", pa.int32()), ("n_turns", pa.int32()), ("n_tokens", pa.int64())])
    return dealt.mapInArrow(_format(tokenizer_path, budget, history, schema), "conv_id long, window int, formatted string, loss_spans array<long>, n_repeated int, n_turns int, n_tokens long")


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        out.append((unescape(role), unescape(rest[: rest.rindex(END)])))
    return out


class _Summary:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, spans: list[int], repeated: int) -> None:
        for role, text in parse(formatted)[repeated:]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for a, b in zip(spans[0::2], spans[1::2], strict=True):
            text = unescape(formatted[a:b])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    now: _Summary | None = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    for batch in batches:
        done = []
        for conv, formatted, spans, repeated in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if now is None or now.conv_id != conv:
                done += [now.row()] if now else []
                now = _Summary(conv)
            now.add(formatted, spans, repeated)
        if done:
            yield batch_of(done)
    if now:
        yield batch_of([now.row()])


def read_back(windows: DataFrame) -> DataFrame:
    """One row a conversation, read from its windows in their order, wherever they lie."""
    dealt = windows.repartition(shuffle_partitions(windows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.select("conv_id", "formatted", "loss_spans", "n_repeated").mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
