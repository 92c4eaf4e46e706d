"""Chat formatting in budgeted windows.

The turns of a conversation are cut into spans of whole turns by prefix sums of their tokens: a
window takes turns while the system turns, the repeated history and the new turns fit the budget;
a turn that alone exceeds it still gets a window, whole. Every window opens with the system turns
that open the conversation, then repeats up to ``history`` earlier turns as far as
``history_tokens`` allow, then brings new turns. Only assistant texts among the new turns are
under the loss mask, so each is learned once; what is repeated is masked.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings inside roles and
texts are broken by a backslash after their first character, backslashes are doubled, and line
breaks in roles become ``\\n``; removing the backslashes restores the text.

Turns are ordered by turn (null first), then role, then text; null roles and texts are empty; a
null conversation id is a conversation. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 2
HISTORY_TOKENS = 256
#: Tokens that the template adds to a turn.
OVERHEAD = 4
START, END = "<|im_start|>", "<|im_end|>"
#: Strings with a meaning in this or other chat templates.
CONTROLS = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)
WINDOW = "conv_id {kind}, window long, text string, repeated int, spans array<array<long>>"


def escape(text: str) -> str:
    doubled = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\x1f")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "\x1f" else m[1], role, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn and where its text starts and ends in it."""
    head, body = f"{START}{_escape_role(role)}\n", escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and start and end of the escaped text, of every turn."""
    found, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        found.append((_unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return found


class _Conversation:
    """Turns come in one by one, windows go out; only the turns of one window are held."""

    def __init__(self, conv_id, budget: int, history: int, history_tokens: int):
        self.id, self.budget, self.history, self.history_tokens = conv_id, budget, history, history_tokens
        self.system: list[tuple[str, str, int]] = []
        self.old: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.number, self.opening = 0, True

    def _repeated(self) -> list[tuple[str, str, int]]:
        """The latest earlier turns that fit, by sums from the end."""
        sums = np.cumsum([n for *_, n in reversed(self.old)])
        k = int(np.searchsorted(sums, self.history_tokens, side="right"))
        return self.old[len(self.old) - k :] if k else []

    def add(self, role: str, text: str) -> Iterator[tuple]:
        turn = (role, text, OVERHEAD + len(text.split()))
        if self.opening and role == "system":
            self.system.append(turn)
            return
        self.opening = False
        self.new.append(turn)
        used = sum(n for *_, n in (*self.system, *self._repeated()))
        sums = used + np.cumsum([n for *_, n in self.new])
        if sums[-1] > self.budget and len(self.new) > 1:
            yield self._window(self.new[:-1])
            self.new = self.new[-1:]

    def finish(self) -> Iterator[tuple]:
        if self.new or not self.number:
            yield self._window(self.new)

    def _window(self, new: list[tuple[str, str, int]]) -> tuple:
        # the first window brings the system turns, later ones repeat them
        repeated = [*(self.system if self.number else []), *self._repeated()]
        fresh = [*([] if self.number else self.system), *new]
        parts, spans, at = [], [], 0
        for k, (role, text, _) in enumerate((*repeated, *fresh)):
            formatted, start, end = render(role, text)
            if k >= len(repeated) and role == "assistant":
                spans.append([at + start, at + end])
            parts.append(formatted)
            at += len(formatted)
        row = (self.id, self.number, "".join(parts), len(repeated), spans)
        self.old = [*self.old, *new][-self.history :] if self.history else []
        self.number += 1
        return row


def _runs(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[object, bool, object]]:
    """``(conv_id, whether it is a new conversation, row)`` of sorted rows."""
    last: object = object()
    for part in parts:
        for row in part.itertuples(index=False):
            key = None if pd.isna(row[0]) else row[0]
            yield key, key != last, row
            last = key


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """Windows of (conv_id, turn, role, text): number, text, repeated turns and loss spans."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, rows, size = None, [], 0
        names = ["conv_id", "window", "text", "repeated", "spans"]

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            # a null id must not turn the others into floats
            out["conv_id"] = out["conv_id"].astype(object)
            return out

        for key, fresh, row in _runs(parts):
            if fresh:
                if current:
                    rows.extend(current.finish())
                current = _Conversation(key, budget, history, history_tokens)
            rows.extend(current.add(row[1], row[2]))
            size += len(row[2])
            if size > 4_000_000:
                yield frame()
                rows, size = [], 0
        if current:
            rows.extend(current.finish())
        if rows:
            yield frame()

    ordered = conversations.select(
        F.col("conv_id").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        ordered.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
        .select("conv_id", "role", "text")
        .mapInPandas(run, WINDOW.format(kind=kind))
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, from its formatted windows alone."""
    kind = windows.schema["conv_id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        state: list | None = None

        def done() -> None:
            key, turns, sha, chars, loss, formatted = state
            rows.append((key, turns, sha.hexdigest(), chars, loss.hexdigest(), formatted))

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            out["conv_id"] = out["conv_id"].astype(object)
            return out

        for key, fresh, row in _runs(parts):
            if fresh:
                if state:
                    done()
                state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text, repeated, spans = row[2], row[3], row[4]
            state[5] += len(text)
            for role, body, _, _ in parse(text)[repeated:]:
                state[1] += 1
                state[2].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
            for start, end in spans:
                learned = unescape(text[start:end])
                state[3] += len(learned)
                state[4].update(learned.encode("utf-8", "surrogatepass"))
            if len(rows) >= 5000:
                yield frame()
                rows.clear()
        if state:
            done()
        if rows:
            yield frame()

    columns = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long"
    )
    return (
        windows.repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "window")
        .select("conv_id", "window", "text", "repeated", "spans")
        .mapInPandas(run, columns)
    )
