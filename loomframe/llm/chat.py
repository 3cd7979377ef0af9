"""Chat formatting: a finite-state machine over roles checks the turn order and emits text segments with loss flags.

The template is declarative: what stands before and after a role's text, whether its text counts for the loss, and which
role may follow which. Control strings inside texts are escaped reversibly, so that the formatted text can be read back.

A conversation passes through one task as a stream sorted by turn: the machine keeps its state and nothing else, so a
conversation with a third of all rows needs no more memory than a short one.

Nulls and edge cases: a null text or role is empty; rows of null conv_id form one conversation; null turns come first;
turns with equal numbers (repeated rows) are all kept, ordered by role and text; roles that the template does not name
get its general form and are out of order. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import col


@dataclass(frozen=True)
class RoleForm:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Roles and their forms, the general form of other roles (its `{role}` is the role), and the allowed order.

    `order` maps a state (a role, or "" at the start) to the roles that may come next.
    """

    start: str
    roles: dict[str, RoleForm]
    other: RoleForm
    order: dict[str, tuple[str, ...]]
    controls: tuple[str, ...]
    _pattern: re.Pattern = field(init=False, repr=False, compare=False, default=None)

    def __post_init__(self):
        if any("\\" in c or len(c) < 2 for c in self.controls):
            raise ValueError("control strings need two characters and no backslash")
        found = "|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True))
        object.__setattr__(self, "_pattern", re.compile(rf"\\|.(?<=(?=(?:{found})).)", re.DOTALL))

    def escape(self, text: str) -> str:
        """A backslash is doubled, and `\\.` cuts each control string after its first character."""
        return self._pattern.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\.", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\\" if m[1] == "\\" else "", text, flags=re.DOTALL)

    def next_state(self, state: str, role: str) -> tuple[str, bool]:
        """The machine's step: the new state, and whether the role may follow."""
        return role, role in self.order.get(state, ())

    def segments(self, role: str, text: str, first: bool) -> list[tuple[str, bool]]:
        """(text, counts for the loss) of one turn, in order."""
        form = self.roles.get(role)
        if form is None:
            form = RoleForm(self.other.before.replace("{role}", self.escape(role)), self.other.after, self.other.loss)
        return [((self.start if first else "") + form.before, False), (self.escape(text), form.loss), (form.after, False)]

    def read(self, text: str) -> tuple[list[tuple[str, str, bool]], str]:
        """The turns (role, text, loss) that the formatted text holds, and what is left of it after the last whole turn."""
        turns, at = [], 0
        head, tail = self.other.before.split("{role}")
        while at < len(text):
            here = at + len(self.start) if self.start and text.startswith(self.start, at) else at
            for role, form in self.roles.items():
                if text.startswith(form.before, here):
                    begin = here + len(form.before)
                    break
            else:
                if not text.startswith(head, here):
                    raise ValueError(f"no turn begins at {text[here:here + 40]!r}")
                close = text.find(tail, here + len(head))
                role, form, begin = self.unescape(text[here + len(head):close]), self.other, close + len(tail)
                if close < 0:
                    break
            end = text.find(form.after, begin)
            if end < 0:
                break
            turns.append((role, self.unescape(text[begin:end]), form.loss))
            at = end + len(form.after)
        return turns, text[at:]


INSTRUCT = ChatTemplate(
    start="<s>",
    roles={"system": RoleForm("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": RoleForm("[INST] ", " [/INST]"),
           "assistant": RoleForm(" ", " </s>", loss=True)},
    other=RoleForm("<|role|>{role}<|text|>\n", "\n<|end|>\n"),
    order={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>"),
)

FORMATTED = "conv_id long, position long, role string, in_order boolean, segments array<struct<text string, loss boolean>>"
SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_chats(turns: DataFrame, template: ChatTemplate = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per turn: conv_id, position (from 0), role, in_order (the role may follow the one before) and its segments.

    The formatted text of a conversation is all its segments' texts, one after the other.
    """
    def run(batches):
        conv, state, position = None, None, 0
        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            places, ordered, segments = [], [], []
            for c, role, text in zip(ids, roles, texts):
                if state is None or c != conv:
                    conv, state, position = c, "", 0
                parts = template.segments(role, text, position == 0)
                state, fine = template.next_state(state, role)
                places.append(position)
                ordered.append(fine)
                segments.append([{"text": t, "loss": loss} for t, loss in parts])
                position += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(roles, pa.string()), pa.array(ordered, pa.bool_()),
                 pa.array(segments, SEGMENTS)], names=["conv_id", "position", "role", "in_order", "segments"])

    rows = turns.select(col(conv_col).cast("long").alias("conv_id"), col(turn_col).alias("turn"),
                        F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, FORMATTED))


def read_chats(formatted: DataFrame, template: ChatTemplate = INSTRUCT) -> DataFrame:
    """What the formatted texts hold, read back by the template: a row per conversation.

    n_turns, turns_sha256 (role, newline, text, newline of each turn), loss_chars and loss_sha256 (all unescaped texts that
    count for the loss), formatted_chars, and in_order (all turns in the allowed order).
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
              "in_order boolean")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches):
        state = None  # of the conversation being read: id, turns, digests, counts, text not read yet
        done = []

        def close():
            if state["left"]:
                raise ValueError("a formatted conversation ends within a turn")
            done.append((state["id"], state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                         state["size"], state["fine"]))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for c, fine, text in zip(*(x.to_pylist() for x in batch.columns)):
                if state is None or state["id"] != c:
                    if state is not None:
                        close()
                    state = {"id": c, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0,
                             "fine": True, "left": ""}
                found, state["left"] = template.read(state["left"] + text)
                for role, said, loss in found:
                    state["turns"].update(f"{role}\n{said}\n".encode())
                    if loss:
                        state["loss"].update(said.encode())
                        state["chars"] += len(said)
                state["n"] += len(found)
                state["size"] += len(text)
                state["fine"] &= fine
            if done:
                yield batch_of(done)
                done = []
        if state is not None:
            close()
            yield batch_of(done)

    text = F.array_join(F.col("segments.text"), "").alias("text")
    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .select("conv_id", "in_order", text).mapInArrow(run, schema))
