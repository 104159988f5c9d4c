"""Conversations as formatted windows within a budget of tokens, each target trained on once.

A window holds whole turns. Prefix sums of the turns' tokens say how far it reaches: leading
system turns and history, both limited, are repeated in front, and the rest of the budget takes new
turns. The loss mask covers texts of new assistant turns only, so a repeated turn is context.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a backslash
is doubled and ``<|`` gets a backslash between, so marks can only come from the template; a new
line in a role becomes ``\\n``. :func:`read_back` undoes this.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.byte_bpe import byte_bpe
from clickloom.llm.common import map_rows, slices

BUDGET, HISTORY_TOKENS, HISTORY_TURNS = 1024, 256, 4
START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
OUTPUT = (
    "window int, repeated int, turns int, tokens long, text string, "
    "loss array<struct<start: long, end: long>>"
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda found: "\n" if found[1] == "n" else found[1], role)


def written(role: str, text: str) -> tuple[str, str]:
    """A turn up to its text, and the rest of it, as they stand in a window."""
    return f"{START}{escape_role(role)}\n", f"{escape(text)}{END}\n"


@dataclass
class _Turn:
    role: str
    text: str
    tokens: int


def _last_fitting(turns: list[_Turn], tokens: int) -> list[_Turn]:
    """As many of the last turns as have so many tokens at most."""
    start = len(turns)
    while start and turns[start - 1].tokens <= tokens:
        start -= 1
        tokens -= turns[start].tokens
    return turns[start:]


@dataclass
class _Conversation:
    """Turns as they come; holds one window's turns, the retained system turns and the history.

    Leading system turns are retained as long as they fit their share of the budget together; the
    others are turns like any. A turn is new in one window, and repeated in later ones only."""

    budget: int
    system_tokens: int
    history_tokens: int
    history_turns: int
    system: list[_Turn] = field(default_factory=list)
    history: list[_Turn] = field(default_factory=list)
    front: list[_Turn] = field(default_factory=list)
    span: list[_Turn] = field(default_factory=list)
    sums: list[int] = field(default_factory=lambda: [0])
    windows: int = 0
    opening: bool = True
    retained: int = 0  # turns at the start of the span that later windows repeat as system turns
    retained_tokens: int = 0

    def add(self, turn: _Turn) -> tuple | None:
        """A finished window, if this turn doesn't fit into it any more."""
        done = None
        room = self.budget - sum(t.tokens for t in self.front)
        if self.span and self.sums[-1] + turn.tokens > room:
            done = self.finish()
        if not self.span:
            self._open(turn.tokens)
        self.opening &= (
            turn.role == "system" and self.retained_tokens + turn.tokens <= self.system_tokens
        )
        if self.opening:
            self.retained += 1
            self.retained_tokens += turn.tokens
        self.span.append(turn)
        self.sums.append(self.sums[-1] + turn.tokens)
        return done

    def _open(self, tokens: int) -> None:
        """What the window repeats: first of all system turns, then history, as the budget allows
        beside its first new turn."""
        room = self.budget - tokens
        system = self.system if sum(t.tokens for t in self.system) <= room else []
        room -= sum(t.tokens for t in system)
        self.front = system + _last_fitting(self.history, room)

    def finish(self) -> tuple | None:
        if not self.span:
            return None
        front = self.front
        parts, loss, at = [], [], 0
        for number, turn in enumerate(front + self.span):
            head, rest = written(turn.role, turn.text)
            if number >= len(front) and turn.role == "assistant":
                end = at + len(head) + len(rest) - len(END) - 1
                loss.append({"start": at + len(head), "end": end})
            parts.append(head + rest)
            at += len(parts[-1])
        row = (
            self.windows, len(front), len(front) + len(self.span),
            sum(t.tokens for t in front) + self.sums[-1], "".join(parts), loss,
        )
        # The last turns that fit both limits; retained system turns are repeated anyway.
        self.system += self.span[: self.retained]
        past = self.history + self.span[self.retained :]
        past = past[max(len(past) - self.history_turns, 0) :]
        self.history = _last_fitting(past, self.history_tokens)
        self.windows += 1
        self.span, self.sums, self.front, self.retained = [], [0], [], 0
        return row


def format_windows(
    conversations: DataFrame,
    path: str,
    budget: int = BUDGET,
    system_tokens: int | None = None,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
) -> DataFrame:
    """``conv_id`` and the columns of OUTPUT: the window's number, how many turns at its front are
    repeated, turns, tokens, the formatted text, and spans of code points under the loss mask.

    Turns of a conversation come in the order of ``turn``, equal numbers by role and text, null
    numbers first; repeated rows are turns of their own. A null text or role is empty, rows
    without ``conv_id`` are one conversation. ``tokens`` is how many the formatted text has, with
    marks, roles and escapes, in the tokenizer given.

    Leading system turns of up to ``system_tokens`` together (half of the budget, if not given) are
    repeated in all later windows; what they are more, or longer, is history like other turns.
    Nothing is repeated that does not fit the budget beside the window's first new turn, so only a
    turn that is longer than the budget itself, alone in its window, exceeds it. A task streams
    through a conversation and holds one window of it. Other columns are ignored; no rows give no
    windows.
    """
    system_tokens = budget // 2 if system_tokens is None else system_tokens
    kind = conversations.schema["conv_id"].dataType.simpleString()
    ordered = (
        conversations.select(
            "conv_id",
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    names = ["conv_id", "window", "repeated", "turns", "tokens", "text", "loss"]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        current, state = None, None
        key = None
        for batch in slices(batches, 2):
            key = batch.schema.field(0).type
            rows = []
            for conv, role, text in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if state is None or conv != current:
                    if state is not None and (last := state.finish()):
                        rows.append((current, *last))
                    current = conv
                    state = _Conversation(budget, system_tokens, history_tokens, history_turns)
                turn = _Turn(role, text, len(bpe.encode("".join(written(role, text)))[0]))
                if done := state.add(turn):
                    rows.append((conv, *done))
            yield _batch(rows, names, key, span)
        if state is not None and (last := state.finish()):
            yield _batch([(current, *last)], names, key, span)

    return map_rows(ordered, f"conv_id {kind}, {OUTPUT}", work)


def _batch(rows: list[tuple], names: list[str], key: pa.DataType, span: pa.DataType):
    kinds = [key, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), span]
    columns = [*zip(*rows, strict=True)] if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names
    )


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window, as they were."""
    found = _TURN.findall(text)
    if sum(len(role) + len(body) + len(START) + len(END) + 2 for role, body in found) != len(text):
        raise ValueError("text outside of turns")
    return [(unescape_role(role), unescape(body)) for role, body in found]


def read_back(windows: DataFrame) -> DataFrame:
    """Each conversation from its windows: ``conv_id, n_turns, turns_sha256`` (of role, new line,
    text, new line for each turn), ``loss_chars, loss_sha256`` (all text under the loss mask,
    unescaped) and ``formatted_chars``. Digests are taken window by window."""
    kind = windows.schema["conv_id"].dataType.simpleString()
    ordered = (
        windows.select("conv_id", "window", "repeated", "text", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
    )
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, key = None, None, None

        def row() -> tuple:
            return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(),
                    state[4])

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [*zip(*rows, strict=True)] if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names
            )

        for batch in slices(batches, 3):
            key = batch.schema.field(0).type
            rows = []
            for conv, _, repeated, text, loss in zip(
                *(column.to_pylist() for column in batch.columns), strict=True
            ):
                if state is None or conv != current:
                    if state is not None:
                        rows.append(row())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                new = read_turns(text)[repeated:]
                state[0] += len(new)
                for role, body in new:
                    state[1].update(f"{role}\n{body}\n".encode())
                for part in loss:
                    target = unescape(text[part["start"] : part["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(text)
            yield out(rows)
        if state is not None:
            yield out([row()])

    return map_rows(
        ordered,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
        work,
    )
