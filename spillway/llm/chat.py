r"""Chat formatting by a finite-state machine over roles and a declarative template.

A Template states, per role, the strings before and after a turn and whether its text counts for the loss. Control
strings inside texts are escaped reversibly: a backslash is doubled, and one is put after the first character of every
occurrence of a control string, so that no control string of the template remains inside a text.

format_segments emits each conversation as ordered text segments (a prefix, the escaped text, a suffix per turn) with
a loss flag; their concatenation is the formatted conversation. read_back parses such segments' text again.

Defined cases: a null text is empty; a null role is the empty role; roles without an entry in the template use its
fallback, which names the role; turns are ordered by (turn, role, text), nulls first, so ties and repeated rows have
one order; conversations whose turn order the machine refuses are formatted all the same and carry valid = false;
conv_id null is a conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spillway.llm.common import only


@dataclass(frozen=True)
class Template:
    """Per role (prefix, suffix, loss); moves: the machine's allowed next roles by role, start under ""; ends: roles that may come last."""

    turns: dict[str, tuple[str, str, bool]]
    fallback: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    moves: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ends: tuple[str, ...] = ()

    def controls(self) -> list[str]:
        parts = {p.strip() for pre, post, _ in self.turns.values() for p in (pre, post)} | set(self.fallback)
        return sorted(p for p in parts if p)


#: Marks of a common instruction format.
INSTRUCT = Template(
    turns={"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)},
    moves={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("user", "assistant"),
)


class Format:
    """A template's escaping, writing and reading."""

    def __init__(self, template: Template):
        self.t = template
        self.hide = re.compile("|".join([r"\\", *(re.escape(c[0]) + (f"(?={re.escape(c[1:])})" if c[1:] else "") for c in template.controls())]))
        openers = {pre.strip(): role for role, (pre, _, _) in template.turns.items()}
        self.openers = openers | {template.fallback[0]: None}
        self.opener = re.compile("|".join(sorted(map(re.escape, self.openers), key=len, reverse=True)))

    def escape(self, text: str) -> str:
        return self.hide.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        """Undoes escape: of two backslashes one stays, a single one goes."""
        return re.sub(r"\\(\\?)", r"\1", text)

    def parts(self, role: str, text: str) -> list[tuple[str, bool]]:
        if role in self.t.turns:
            pre, post, loss = self.t.turns[role]
            return [(pre, False), (self.escape(text), loss), (post, False)]
        pre, post = self.t.fallback
        return [(pre + self.escape(role) + post, False), (self.escape(text), False), (post, False)]

    def parse(self, formatted: str) -> Iterator[tuple[str, str, bool]]:
        """(role, text, loss) of each turn of a formatted conversation."""
        at = 0
        while at < len(formatted):
            m = self.opener.match(formatted, at)
            if not m:
                raise ValueError(f"no turn starts at {at}")
            role = self.openers[m[0]]
            if role is None:
                end = formatted.index(self.t.fallback[1], m.end())
                role, begin, close, loss = self.unescape(formatted[m.end() : end]), end + len(self.t.fallback[1]), self.t.fallback[1], False
            else:
                begin, close, loss = m.end(), self.t.turns[role][1], self.t.turns[role][2]
            end = formatted.index(close, begin)
            yield role, self.unescape(formatted[begin:end]), loss
            at = end + len(close)

    def valid(self, state: str | None, role: str) -> str | None:
        """The machine's next state; None once it has refused."""
        return role if state is not None and role in self.t.moves.get(state, ()) else None


_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("turn_no", pa.int64()), ("text", pa.string()), ("loss", pa.bool_()), ("state", pa.string())])


def format_segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, segment, turn_no, text, loss, state): state is the machine's state after that turn, null once refused.

    Rows are dealt by conversation and sorted; each task streams through its conversations turn by turn, so a long one
    needs no more memory than a short one.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fmt, last, state, seg, turn_no = Format(template), (), "", 0, 0
        for b in batches:
            rows = []
            for cid, role, text in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True):
                if (cid,) != last:
                    last, state, seg, turn_no = (cid,), "", 0, 0
                state = fmt.valid(state, role)
                for part, loss in fmt.parts(role, text):
                    rows.append((cid, seg, turn_no, part, loss, state))
                    seg += 1
                turn_no += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEGMENTS, strict=True)] if rows else [pa.array([], f.type) for f in _SEGMENTS], schema=_SEGMENTS)

    turns = only(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(emit, "conv_id long, segment long, turn_no long, text string, loss boolean, state string")


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def digest(segments: DataFrame, template: Template = INSTRUCT, in_order: bool = False) -> DataFrame:
    """Per conversation, what can be read back from its segments' text; the loss columns come from the loss flags.

    in_order: segments come straight from format_segments, so each conversation lies in one task, in order; a table that
    was read anew is dealt and sorted first."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fmt = Format(template)
        now: dict = {}

        def closed() -> list:
            return [now["id"], now["turns"], now["sha"].hexdigest(), now["loss"], now["loss_sha"].hexdigest(), now["chars"], now["state"] in fmt.t.ends]

        for b in batches:
            done = []
            for cid, turn, text, loss, state in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn_no", "text", "loss", "state")), strict=True):
                if not now or now["id"] != cid:
                    if now:
                        done.append(closed())
                    now = {"id": cid, "turn": -1, "turns": 0, "sha": hashlib.sha256(), "loss": 0, "loss_sha": hashlib.sha256(), "chars": 0, "open": []}
                if turn != now["turn"]:
                    now["turn"], now["open"] = turn, []
                now["open"].append(text)
                now["chars"] += len(text)
                now["state"] = state
                if loss:
                    plain = fmt.unescape(text)
                    now["loss"] += len(plain)
                    now["loss_sha"].update(plain.encode())
                if len(now["open"]) == 3:
                    for role, plain, _ in fmt.parse("".join(now["open"])):
                        now["turns"] += 1
                        now["sha"].update(f"{role}\n{plain}\n".encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), _DIGEST, strict=True)] if done else [pa.array([], f.type) for f in _DIGEST], schema=_DIGEST)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(closed(), _DIGEST, strict=True)], schema=_DIGEST)

    ordered = only(segments, "conv_id", "segment", "turn_no", "text", "loss", "state")
    if not in_order:
        ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
