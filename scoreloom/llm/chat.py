"""Chat formatting by a finite-state machine over roles and a declarative template.

The machine reads the turns of a conversation in order and says whether the order is
valid so far; every turn becomes segments of text, each with a flag that says whether
the loss counts it.  The template marks turns and escapes its control strings inside
texts, so what was formatted can be read back whatever the texts hold.

Turns are sorted within a conversation and streamed: neither a long conversation nor its
formatted text is ever held as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.llm.common import column_of, slices

START = "start"


@dataclass(frozen=True)
class Template:
    """Control strings, names of roles, the roles that count, and the order of turns.

    ``order`` maps the last role (``START`` before any) to the roles that may follow;
    ``final`` are the roles a conversation may end with.  A role without a name is written
    after ``other``.
    """

    opening: str = "### "
    after_role: str = ": "
    closing: str = "</turn>\n"
    escape: str = "\\"
    escaped: tuple[str, ...] = ("\\", "###", "</turn>")
    other: str = "="
    names: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    loss: frozenset[str] = frozenset({"assistant"})
    order: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            START: frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def hide(self, text: str, *more: str) -> str:
        pattern = "|".join(map(re.escape, (*self.escaped, *more)))
        return re.sub(pattern, lambda m: self.escape + m.group(), text)

    def show(self, text: str, *more: str) -> str:
        pattern = "|".join(map(re.escape, (*self.escaped, *more)))
        return re.sub(f"{re.escape(self.escape)}({pattern})", lambda m: m.group(1), text)

    def header(self, role: str) -> str:
        name = self.names.get(role)
        if name is None:
            name = self.other + self.hide(role, self.after_role[0])
        return self.opening + name + self.after_role

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of a turn, with their loss flags."""
        body = self.hide(text)
        return [(self.header(role), False), (body, role in self.loss), (self.closing, False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a formatted text."""
        roles = {name: role for role, name in self.names.items()}
        hidden = "|".join(map(re.escape, (*self.escaped, self.after_role[0])))
        body = rf"(?:{re.escape(self.escape)}(?:{hidden})|[^{re.escape(self.escape)}])*?"
        pattern = re.compile(
            f"{re.escape(self.opening)}({body}){re.escape(self.after_role)}"
            f"({body}){re.escape(self.closing)}",
            re.S,
        )
        turns, at = [], 0
        while at < len(formatted):
            match = pattern.match(formatted, at)
            if not match:
                raise ValueError(f"no turn at character {at}")
            name, text = match.groups()
            if name.startswith(self.other):
                role = self.show(name[len(self.other) :], self.after_role[0])
            else:
                role = roles[name]
            turns.append((role, self.show(text)))
            at = match.end()
        return turns


SEGMENTS = (
    "position long, role string, valid boolean, segments array<struct<text:string,loss:boolean>>"
)


def in_order(conversations: DataFrame) -> DataFrame:
    """The turns of a conversation after each other: by turn, then role and text; nulls first."""
    turn, role, text = (F.col(c).asc_nulls_first() for c in ("turn", "role", "text"))
    return conversations.repartition("conv_id").sortWithinPartitions("conv_id", turn, role, text)


def format_chat(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Rows (conv_id, position, role, valid, segments), a row for each turn, in order.

    ``valid`` says whether the machine accepts the turns up to this one.  A null text or role
    is empty; an empty or unknown role is written as it is and makes the order invalid.  Equal
    turn numbers and repeated rows all stay.  Rows with a null conv_id form one conversation.
    Other columns are left out.
    """
    rules = template or Template()
    wanted = in_order(conversations.select("conv_id", "turn", "role", "text"))
    ids = conversations.select("conv_id").schema.fields
    schema = StructType([*ids, *StructType.fromDDL(SEGMENTS).fields])
    segment = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run  # no conversation yet
        state, valid, position = START, True, 0
        for part in slices(batches, "text"):
            positions, roles, valids, segments = [], [], [], []
            for conv, role, text in zip(
                *(column_of(part, c).to_pylist() for c in ("conv_id", "role", "text")),
                strict=True,
            ):
                if conv != current:
                    current, state, valid, position = conv, START, True, 0
                role = role or ""
                valid = valid and role in rules.order.get(state, ())
                state = role
                positions.append(position)
                roles.append(role)
                valids.append(valid)
                pieces = rules.turn(role, text or "")
                segments.append([{"text": t, "loss": flag} for t, flag in pieces])
                position += 1
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(part, "conv_id"),
                    pa.array(positions, pa.int64()),
                    pa.array(roles, pa.string()),
                    pa.array(valids, pa.bool_()),
                    pa.array(segments, segment),
                ],
                schema.names,
            )

    return wanted.mapInArrow(run, schema)


READ = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """A row for each conversation, from the segments alone; they come in order.

    turns_sha256 is over role, line end, text, line end of each turn; loss_sha256 over the
    texts under the loss, unescaped; valid says whether the machine ends in a final state.
    """
    rules = template or Template()
    ids = formatted.select("conv_id").schema.fields
    schema = StructType([*ids, *StructType.fromDDL(READ).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: object = run
        row: list = []
        done: list[list] = []

        def close() -> None:
            conv, turns, told, chars, lost, size, valid, role = row
            valid = valid and role in rules.final
            done.append([conv, turns, told.hexdigest(), chars, lost.hexdigest(), size, valid])

        def table() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = [id_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.bool_()], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            id_kind = column_of(batch, "conv_id").type
            for conv, valid, segments in zip(
                *(column_of(batch, c).to_pylist() for c in ("conv_id", "valid", "segments")),
                strict=True,
            ):
                if conv != current:
                    if row:
                        close()
                    current = conv
                    row = [conv, 0, sha256(), 0, sha256(), 0, True, ""]
                whole = "".join(s["text"] for s in segments)
                for role, text in rules.read(whole):
                    row[1] += 1
                    row[2].update(f"{role}\n{text}\n".encode())
                    row[7] = role
                lost = rules.show("".join(s["text"] for s in segments if s["loss"]))
                row[3] += len(lost)
                row[4].update(lost.encode())
                row[5] += len(whole)
                row[6] = valid
            if done:
                yield table()
                done.clear()
        if row:
            close()
            yield table()

    wanted = formatted.select("conv_id", "valid", "segments")
    return wanted.mapInArrow(run, schema)
