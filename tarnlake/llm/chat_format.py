"""Chat formatting: conversations to text segments with a loss flag each, and back.

A template declares the markers of every role and the allowed turn order as the transitions of a
finite-state machine. ``format_chats`` sorts the rows of each conversation by turn and runs the
machine over them as a stream, so memory holds two turns, not one conversation. Each marker and each
text becomes a segment; the segments of a conversation, in order, are its formatted text.

Control strings of the template inside a text are escaped: the first character of each is followed
by ``\\.`` and every backslash is doubled. ``read_chats`` finds the turns again from the formatted
text alone. Templates whose markers could combine with text into another marker are refused.

Rows and edge cases: null text and null roles are empty; rows with a null conversation id are one
conversation; equal turns are ordered by role, then text; repeated rows are turns of their own.
Roles unknown to the template get the generic markers. A conversation that breaks the turn order is
formatted all the same; its segments carry the first broken rule in ``fault``, and so does the last
turn of one that ends in a state that is not final. An empty table
gives no segments. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEGMENTS = (
    "conv_id long, seg long, turn_no long, kind string, role string, text string, loss boolean, "
    "fault string"
)
_TURNS = "conv_id long, turn_no long, role string, text string"
_SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, fault string"
)


@dataclass(frozen=True)
class Role:
    """Markers before and after a text, and whether the text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers by role and the machine over roles; states are names, ``start`` is the first."""

    roles: dict[str, Role]
    opening: str
    #: Before a role the template does not know, between its name and its text, and after it.
    other: tuple[str, str, str]
    order: dict[str, dict[str, str]]
    final: frozenset[str]
    start: str = "start"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = {m for r in self.roles.values() for m in (r.before, r.after) if m}
        marks |= {self.opening, *self.other} - {""}
        object.__setattr__(self, "controls", tuple(sorted(marks, key=lambda m: (-len(m), m))))
        for mark in self.controls:
            if "\\" in mark:
                raise ValueError(f"a marker must not hold a backslash: {mark!r}")
            for at in range(1, len(mark)):
                head, tail = mark[:at], mark[at:]
                for other in self.controls:
                    if other.startswith(tail) or tail.startswith(other) or other.endswith(head):
                        raise ValueError(f"marker {mark!r} can arise at the edge of {other!r}")
        closings = [r.after for r in self.roles.values()] + [self.other[2]]
        if "" in closings or len(set(closings)) < len(closings):
            raise ValueError("every role needs a closing marker of its own")

    def escape(self, text: str) -> str:
        return self._found.sub(r"\1\\.", text.replace("\\", "\\\\"))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\|\.)", lambda m: "\\" if m[1] == "\\" else "", text)

    @property
    def _found(self) -> re.Pattern[str]:
        return re.compile(f"(?=(?:{'|'.join(map(re.escape, self.controls))}))(.)", re.DOTALL)

    @property
    def splitter(self) -> re.Pattern[str]:
        return re.compile("|".join(map(re.escape, self.controls)))


#: Turn markers of a widely used instruction format; tools and other roles have markers of the same
#: kind. A system turn may open; then user and assistant take turns; tools answer the assistant.
INSTRUCTION = Template(
    roles={
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST]", "[/INST]"),
        "assistant": Role("", "</s>", loss=True),
        "tool": Role("[TOOL]", "[/TOOL]"),
    },
    opening="<s>",
    other=("[ROLE]", "[/ROLE]", "[/TURN]"),
    order={
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked", "tool": "asked"},
    },
    final=frozenset({"answered"}),
)


def _in_order(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of a conversation in one partition, in the order of the keys."""
    return df.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", *keys)


def _same(a, b) -> bool:
    return a == b or (pd.isna(a) and pd.isna(b))


def format_chats(
    conversations: DataFrame,
    template: Template = INSTRUCTION,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``conv_id, seg, turn_no, kind, role, text, loss, fault``: one row per segment.

    ``kind`` is ``open``, ``marker`` or ``text``. ``fault`` is null while the turn order holds, and
    on the last turn also tells if the conversation ends in a state that is not final.
    """
    rows = conversations.select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = template._found
        opened, here, state, fault, turn_no, seg = False, None, None, None, 0, 0
        # The segments of the turn before wait until it is known whether it was the last one.
        waiting: list[tuple] = []

        def put(kind: str, role: str | None, text: str, loss: bool = False) -> None:
            nonlocal seg
            waiting.append((here, seg, turn_no, kind, role, text, loss, fault))
            seg += 1

        def ended() -> list[tuple]:
            if fault is not None or state in template.final:
                return waiting
            wrong = f"turn {turn_no - 1}: the conversation ends in {state}"
            return [w if w[3] == "open" else (*w[:-1], wrong) for w in waiting]

        def frame_of(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=[c.split()[0] for c in _SEGMENTS.split(", ")]).astype(
                {"conv_id": "Int64"}
            )

        for frame in frames:
            out: list[tuple] = []
            for conv, role, text in zip(frame["conv_id"], frame["role"], frame["text"], strict=True):
                if not opened or not _same(conv, here):
                    out += ended() if opened else []
                    waiting = []
                    opened, here, state, fault, turn_no, seg = True, conv, template.start, None, 0, 0
                    put("open", None, template.opening)
                else:
                    out += waiting
                    waiting = []
                if fault is None:
                    after = template.order.get(state, {}).get(role)
                    if after is None:
                        fault = f"turn {turn_no}: {role or 'no role'} after {state}"
                    state = after
                text = found.sub(r"\1\\.", text.replace("\\", "\\\\"))
                known = template.roles.get(role)
                if known is None:
                    name = found.sub(r"\1\\.", role.replace("\\", "\\\\"))
                    put("marker", role, template.other[0] + name + template.other[1])
                    put("text", role, text)
                    put("marker", role, template.other[2])
                else:
                    put("marker", role, known.before)
                    put("text", role, text, known.loss)
                    put("marker", role, known.after)
                turn_no += 1
            yield frame_of(out)
        if opened:
            yield frame_of(ended())

    return _in_order(rows, "turn", "role", "text").mapInPandas(run, _SEGMENTS)


class _Reader:
    """Turns of one conversation from its formatted text, fed in any pieces."""

    def __init__(self, template: Template) -> None:
        self.template, self.rest, self.opened = template, "", False
        self.role: str | None = None
        self.named: str | None = None
        self.by_before = {r.before: n for n, r in template.roles.items() if r.before}
        self.by_after = {r.after: n for n, r in template.roles.items()}
        self.splitter = template.splitter

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        t = self.template
        at = 0
        for mark in self.splitter.finditer(self.rest):
            body, found = self.rest[at : mark.start()], mark[0]
            at = mark.end()
            if found == t.opening and not self.opened:
                self.opened = True
            elif found in self.by_before:
                self.role = self.by_before[found]
            elif found in self.by_after:
                role = self.by_after[found]
                if t.roles[role].before and self.role != role:
                    raise ValueError(f"{found!r} closes no turn")
                self.role = None
                yield role, t.unescape(body)
            elif found == t.other[1]:
                self.named = t.unescape(body)
            elif found == t.other[2]:
                yield self.named or "", t.unescape(body)
                self.named = None
        self.rest = self.rest[at:]


def _by_conversation(frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
    """(conversation, segments, is new) runs of a sorted stream of segments."""
    first, here = True, None
    for frame in frames:
        for values in zip(*(frame[c] for c in ("conv_id", "text", "loss", "fault")), strict=True):
            new = first or not _same(values[0], here)
            first, here = False, values[0]
            yield new, *values


def read_chats(segments: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """``conv_id, turn_no, role, text``: the turns, read from the formatted text."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, n, out = _Reader(template), 0, []
        for new, conv, text, _, _ in _by_conversation(frames):
            if new:
                reader, n = _Reader(template), 0
            for role, body in reader.feed(text):
                out.append((conv, n, role, body))
                n += 1
            if len(out) >= 1000:
                yield _frame(out, _TURNS)
                out = []
        yield _frame(out, _TURNS)

    return _in_order(segments, "seg").mapInPandas(run, _TURNS)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype(
        {"conv_id": "Int64"}
    )


def chat_digests(segments: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Counts and digests per conversation, from its formatted text and loss mask.

    ``turns_sha256`` is over role, newline, text and newline of every turn read back,
    ``loss_sha256`` over the unescaped text under the mask.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        reader = turns = learned = conv = fault = None
        n = chars = total = 0

        def close() -> None:
            out.append((conv, n, turns.hexdigest(), chars, learned.hexdigest(), total, fault))

        for new, at, text, loss, wrong in _by_conversation(frames):
            if new:
                if reader is not None:
                    close()
                reader, turns, learned = _Reader(template), hashlib.sha256(), hashlib.sha256()
                conv, fault, n, chars, total = at, None, 0, 0, 0
                if len(out) >= 1000:
                    yield _frame(out, _SUMMARY)
                    out.clear()
            fault = wrong if isinstance(wrong, str) else fault
            total += len(text)
            for role, body in reader.feed(text):
                turns.update(f"{role}\n{body}\n".encode())
                n += 1
            if loss:
                body = template.unescape(text)
                learned.update(body.encode())
                chars += len(body)
        if reader is not None:
            close()
        yield _frame(out, _SUMMARY)

    return _in_order(segments, "seg").mapInPandas(run, _SUMMARY)
