"""Conversations as formatted text segments with loss flags.

A template is plain data: the strings around a turn and the roles whose text counts
in the loss. A finite-state machine over roles checks the order of turns. Control
strings inside a text are escaped, so that the formatted text can be read back.
"""

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Strings around a turn; ``before`` holds ``{role}`` once, between control strings."""

    before: str = "### {role}: "
    after: str = " </turn>\n"
    #: Strings that must not appear unescaped inside a text.
    controls: tuple[str, ...] = ("###", "</turn>")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: State -> role -> next state. A role without an entry is out of order.
    order: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "asked", "user": "user"},
            "asked": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    #: States in which a conversation may end.
    final: tuple[str, ...] = ("user", "assistant")

    def escape(self, text: str) -> str:
        """Put the escape character before itself and before each control string."""
        marks = "|".join(map(re.escape, (ESCAPE, *self.controls)))
        return re.sub(f"({marks})", lambda found: ESCAPE + found[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def name(self, role: str) -> str:
        """A role as it stands in the text: one that could break the frame is escaped."""
        return self.escape(role).replace(":", ESCAPE + ":")


SEGMENT_SCHEMA = (
    "conv_id long, turn_no long, role string, segment string, text string, loss boolean, "
    "in_order boolean"
)
_TYPES = (
    pa.int64(),
    pa.int64(),
    pa.string(),
    pa.string(),
    pa.string(),
    pa.bool_(),
    pa.bool_(),
)
_NAMES = [part.split()[0] for part in SEGMENT_SCHEMA.split(", ")]


class TurnOrder:
    """The state machine; once a turn is out of order, the rest of its conversation is."""

    def __init__(self, template: Template):
        self.template, self.state = template, "start"

    def step(self, role: str) -> bool:
        self.state = self.template.order.get(self.state, {}).get(role, "broken")
        return self.state != "broken"


def format_conversations(
    rows: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Three segments per turn: ``open``, ``body`` and ``close``.

    Joined in order they are the conversation's formatted text. ``loss`` marks
    segments that count in the loss; ``in_order`` is false from the first turn that
    the state machine does not admit, and such turns are still formatted. Null text
    and null role are empty; a null turn comes first; a null ``conv_id`` is one
    conversation. Turns of one number are ordered by role and text, and repeated
    rows are turns of their own. Segments of a conversation are successive rows of
    one partition. Turns are streamed: a conversation of any length needs the
    memory of one batch.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, turn_no, order = object(), 0, None
        for batch in batches:
            out, size = [], 0
            for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if conv != current:
                    current, turn_no, order = conv, 0, TurnOrder(template)
                good = order.step(role)
                loss = role in template.loss_roles
                before, _, rest = template.before.partition("{role}")
                opening = before + template.name(role) + rest
                body = template.escape(text)
                out += [
                    (conv, turn_no, role, "open", opening, False, good),
                    (conv, turn_no, role, "body", body, loss, good),
                    (conv, turn_no, role, "close", template.after, False, good),
                ]
                turn_no += 1
                size += len(body)
                if size > 1 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    ordered = (
        rows.select(
            F.col(conv_col).cast("long").alias("conv"),
            F.coalesce(role_col, F.lit("")).alias("role"),
            F.coalesce(text_col, F.lit("")).alias("text"),
            F.col(turn_col).alias("turn"),
        )
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select("conv", "role", "text")
    )
    return ordered.mapInArrow(segments, SEGMENT_SCHEMA)


def _batch(rows) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), _TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


class Reader:
    """Reads a formatted text back in pieces of any cut, turn by turn."""

    def __init__(self, template: Template):
        self.template = template
        before, _, rest = template.before.partition("{role}")
        # Inside a role or text every escape character is followed by what it guards.
        inside = r"(?:\\.|[^\\])*?"
        self.turn = re.compile(
            f"{re.escape(before)}({inside}){re.escape(rest)}({inside}){re.escape(template.after)}",
            re.DOTALL,
        )
        self.left = ""

    def feed(self, text: str) -> Iterable[tuple[str, str]]:
        self.left += text
        if not self.left.endswith(self.template.after):
            return
        at = 0
        while found := self.turn.match(self.left, at):
            yield self.template.unescape(found[1]), self.template.unescape(found[2])
            at = found.end()
        self.left = self.left[at:]


class _Digest:
    """What one conversation's formatted text says when it is read back."""

    def __init__(self, template: Template):
        self.template, self.reader = template, Reader(template)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.in_order, self.last_state = True, TurnOrder(template)

    def add(self, text: str, loss: bool) -> None:
        self.formatted_chars += len(text)
        if loss:
            plain = self.template.unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        for role, said in self.reader.feed(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
            self.in_order &= self.last_state.step(role)

    def row(self, conv):
        if self.reader.left:
            raise ValueError(f"conversation {conv} can't be read back")
        return (
            conv,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.formatted_chars,
            self.in_order and self.last_state.state in self.template.final,
        )


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, parsed from the segments of :func:`format_conversations`.

    Takes them in the order and partitioning they were made in and keeps a turn at
    most in memory. ``valid`` is the verdict of the state machine on the roles read.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        for batch in batches:
            done = []
            for conv, text, loss in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if state is None or conv != current:
                    if state is not None:
                        done.append(state.row(current))
                    current, state = conv, _Digest(template)
                state.add(text, loss)
            if done:
                yield _digests(done)
        if state is not None:
            yield _digests([state.row(current)])

    return segments.select("conv_id", "text", "loss").mapInArrow(digest, DIGEST_SCHEMA)


def _digests(rows) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [part.split() for part in DIGEST_SCHEMA.split(", ")]
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])
