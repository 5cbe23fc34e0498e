"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a
declarative template.

A template names, for each role, the segments of a turn: literal marks and the places of the
text and the role name, each with a loss flag; and which roles may follow which state. A turn
is formatted whether or not it is in order; ``in_order`` tells if the machine accepted it and
everything before it.

Control strings inside a text are escaped reversibly: where a text holds the first character
of a control string, any number of backslashes and the rest of the control string, one more
backslash is put after the first character. What is left alone reads as it was. Reading back
takes the one backslash out again.

Turns are dealt out by conversation and sorted; one pass formats them, holding no more than
the machine's state, so the length of a conversation doesn't matter to memory. (A digest of a
whole conversation is a chain over its bytes, so one task must see them in order; it too holds
only a running hash.)

Defined cases: null texts and roles are empty. A role that the template doesn't name gets the
marks of ``other``, which carry its name. Turns with equal numbers go by role, then text; a
null turn number comes first. A null conversation id is a conversation of its own. Repeated
rows are repeated turns. An empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Segment:
    mark: str = ""
    slot: str = ""  # "text", "role" or "" for a mark
    loss: bool = False


def turn(before: str, after: str, loss: bool = False) -> tuple[Segment, ...]:
    return Segment(before), Segment(slot="text", loss=loss), Segment(after)


@dataclass(frozen=True)
class Template:
    turns: Mapping[str, tuple[Segment, ...]]
    other: tuple[Segment, ...]
    #: state -> role -> next state; the machine begins in "start". Other roles are "other".
    moves: Mapping[str, Mapping[str, str]]
    control: tuple[str, ...] = field(default=())

    def __post_init__(self):
        firsts = {c[0] for c in self.control}
        if any(len(c) < 2 or set(c[1:]) & (firsts | {"\\"}) for c in self.control):
            raise ValueError("a control string must not hold a backslash, nor the first character of one past its own")
        for segments in (*self.turns.values(), self.other):
            if not any(s.mark.lstrip().startswith(self.control) for s in segments[:1]) or not segments[-1].mark.endswith(self.control):
                raise ValueError("a turn must begin and end with control strings")


#: Instruction marks. Loss falls on assistant texts only.
INSTRUCT = Template(
    turns={
        "system": turn("<s>[SYS]", "[/SYS]</s>"),
        "user": turn("<s>[INST] ", " [/INST]</s>"),
        "assistant": turn("<s>[ANS] ", "</s>", loss=True),
    },
    other=(Segment("<s>[ROLE]"), Segment(slot="role"), Segment("[/ROLE]"), Segment(slot="text"), Segment("</s>")),
    moves={
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    },
    control=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ANS]", "[ROLE]", "[/ROLE]"),
)


class Formatter:
    def __init__(self, template: Template):
        self.template = template
        first = "|".join(f"{re.escape(c[0])}(\\\\*)(?={re.escape(c[1:])})" for c in template.control)
        self.inside = re.compile(first)
        less = "|".join(f"{re.escape(c[0])}\\\\(?=\\\\*{re.escape(c[1:])})" for c in template.control)
        self.escaped = re.compile(less)
        self.stop = re.compile("|".join(map(re.escape, template.control)))
        self.shapes = [*template.turns.items(), (None, template.other)]

    def _turn(self, formatted: str, at: int, segments: tuple[Segment, ...]) -> tuple[dict[str, str], int] | None:
        """The slots of a turn of this shape at ``at`` and where it ends; None if there is none.
        A slot ends before the mark after it, which has the next control string in it, so a
        text is found by one search and sliced once."""
        slots, open_slot = {}, None
        for s in segments:
            if s.slot:
                open_slot = s.slot
                continue
            start = at
            if open_slot:
                stop, inside = self.stop.search(formatted, at), self.stop.search(s.mark)
                end = stop.start() if stop else len(formatted)
                start = end - inside.start() if inside else formatted.rfind(s.mark, at, end)
                if start < at:
                    return None
            if not formatted.startswith(s.mark, start):
                return None
            if open_slot:
                slots[open_slot], open_slot = formatted[at:start], None
            at = start + len(s.mark)
        return slots, at

    def escape(self, text: str) -> str:
        return self.inside.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][:-1], text)

    def format(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn: (output text, loss)."""
        fill = {"text": text, "role": role}
        return [(self.escape(fill[s.slot]) if s.slot else s.mark, s.loss) for s in self.template.turns.get(role, self.template.other)]

    def next_state(self, state: str | None, role: str) -> str | None:
        """The machine's move; None (for good) once a role is out of order."""
        known = role if role in self.template.turns else "other"
        return self.template.moves.get(state, {}).get(known) if state else None

    def read(self, formatted: str) -> list[tuple[str, str, int]]:
        """Turns (role, text, start) read back from formatted text."""
        out, at = [], 0
        while at < len(formatted):
            for role, segments in self.shapes:
                if found := self._turn(formatted, at, segments):
                    break
            else:
                raise ValueError(f"not in the template's form at {at}")
            slots, end = found
            out.append((self.unescape(slots["role"]) if role is None else role, self.unescape(slots["text"]), at))
            at = end
        return out


def format_turns(
    turns: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, n, in_order, formatted, loss): one row per turn, the n-th of its conversation.
    ``loss`` is a list of (start, end) offsets in ``formatted`` that are under the loss. The
    rows of a conversation are consecutive and in order."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = Formatter(template)
        now, n, state = object(), 0, None
        for b in batches:
            out = []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != now:
                    now, n, state = conv, 0, "start"
                state = form.next_state(state, role)
                pieces, at, spans = form.format(role, text), 0, []
                for piece, loss in pieces:
                    if loss:
                        spans.append({"start": at, "end": at + len(piece)})
                    at += len(piece)
                out.append((conv, n, state is not None, "".join(p for p, _ in pieces), spans))
                n += 1
            cols = list(zip(*out)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["conv", "n", "in_order", "formatted", "loss"])

    return rows.mapInArrow(run, "conv long, n long, in_order boolean, formatted string, loss array<struct<start int, end int>>")


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, in_order) of each
    conversation, from the formatted text and loss spans alone. The rows must be as
    ``format_turns`` gives them: a conversation's turns consecutive and in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = Formatter(template)
        now = None

        def row(s) -> tuple:
            return s["conv"], s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["in_order"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_order"])

        for b in batches:
            done = []
            for conv, n, in_order, text, spans in zip(*(b.column(i).to_pylist() for i in range(5))):
                if n == 0:
                    if now:
                        done.append(row(now))
                    now = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "in_order": True}
                for role, said, _ in form.read(text):
                    now["turns"].update(f"{role}\n{said}\n".encode())
                    now["n"] += 1
                for s in spans:
                    under = form.unescape(text[s["start"] : s["end"]])
                    now["loss"].update(under.encode())
                    now["loss_chars"] += len(under)
                now["chars"] += len(text)
                now["in_order"] &= in_order
            yield batch(done)
        if now:
            yield batch([row(now)])

    schema = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"
    return formatted.mapInArrow(run, schema)
