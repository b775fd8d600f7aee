"""Chat formatting with a grammar round trip.

A turn is rendered as ``[INST] role line-end text [/INST]</s> line-end``. The deterministic parser reads that text
back. Where it fails, or a role or text does not come back as it was, the conflicting content is escaped (a backslash
more behind the first character of control strings, which the parser takes away again) and the turn is rendered anew,
until the parsed turn is identical to the source. Texts without conflicts stay as they are.

One row per turn is produced, in the order of the turns, so that a conversation of any length needs one turn's
memory. The segments of a conversation, end to end, are its text; parsing them one by one or as a whole gives the
same turns, as a segment always ends at its own end mark.

Order is by turn, then role and text where turns repeat; null turns come first. A null role or text is empty. Rows
with a null conversation id form one conversation. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, BREAK, END = "[INST] ", "\n", " [/INST]</s>\n"
# Control strings that texts may hold by accident.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED_ROLE = "assistant"


@dataclass(frozen=True)
class Turn:
    role: str
    text: str
    start: int  # of the escaped text within its segment, in code points
    stop: int


def _pattern(control: str) -> str:
    return re.escape(control[0]) + r"(\\*)" + re.escape(control[1:])


_ANY = re.compile("|".join(_pattern(c) for c in CONTROL))
_RAW = re.compile("|".join(map(re.escape, CONTROL)))


def escape(text: str) -> str:
    """One backslash more behind the first character of each control string."""
    return _ANY.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: m[0][0] + m[0][2:], text)


_ROLE_FORMS = {"\\": "\\\\", "\n": "\\n", "<": "\\l", "[": "\\b"}
_ROLE_CHARS = {form: char for char, form in _ROLE_FORMS.items()}


def escape_role(role: str) -> str:
    """Whatever could end a role or start a control string, in a form with a backslash."""
    return "".join(_ROLE_FORMS.get(c, c) for c in role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\[\\nlb]", lambda m: _ROLE_CHARS[m[0]], role)


def parse(text: str) -> list[Turn]:
    """The turns of a formatted text. Raises ValueError where the text does not follow the grammar, which has no
    control string inside a role or text."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        broken = text.find(BREAK, at + len(START))
        end = text.find(END, broken + 1) if broken >= 0 else -1
        if end < 0:
            raise ValueError(f"the turn at {at} does not end")
        role, said = text[at + len(START):broken], text[broken + 1:end]
        if _RAW.search(role) or _RAW.search(said):
            raise ValueError(f"a control string inside the turn at {at}")
        turns.append(Turn(unescape_role(role), unescape(said), broken + 1, end))
        at = end + len(END)
    return turns


def render(role: str, text: str) -> tuple[str, Turn]:
    """The segment of a turn, and the turn as the parser reads it back."""
    for role_form, text_form in ((role, text), (role, escape(text)), (escape_role(role), text), (escape_role(role), escape(text))):
        segment = START + role_form + BREAK + text_form + END
        try:
            turns = parse(segment)
        except ValueError:
            continue
        if len(turns) == 1 and turns[0].role == role and turns[0].text == text:
            return segment, turns[0]
    raise ValueError("a turn does not come back from its escaped form")


def format_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn_no, segment, loss_start, loss_stop``: the rendered turns, numbered from 0, with the span of
    the segment that is trained on (code points; null for turns of other roles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number = object(), 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                number = number + 1 if conv == current else 0
                current = conv
                segment, turn = render(role, text)
                trained = role == TRAINED_ROLE
                out.append((conv, number, segment, turn.start if trained else None, turn.stop if trained else None))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                    ["conv_id", "turn_no", "segment", "loss_start", "loss_stop"])

    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, turn_no long, segment string, loss_start long, loss_stop long")


def read_conversations(segments: DataFrame) -> DataFrame:
    """Parse formatted turns back. One row per conversation: ``conv_id, n_turns, turns_sha256`` (role, line end,
    text, line end per turn), ``loss_chars, loss_sha256`` (the unescaped text under the loss mask), and
    ``formatted_chars``. Works through one segment at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, open_ = None, False

        def row():
            return conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            out = []
            for c, segment, start, stop in zip(*(batch[n].to_pylist() for n in ("conv_id", "segment", "loss_start", "loss_stop"))):
                if not open_ or c != conv:
                    if open_:
                        out.append(row())
                    conv, open_, n_turns, loss_chars, chars = c, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for turn in parse(segment):
                    n_turns += 1
                    turns.update(f"{turn.role}\n{turn.text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    text = unescape(segment[start:stop])
                    loss_chars += len(text)
                    loss.update(text.encode("utf-8", "surrogatepass"))
                chars += len(segment)
            if out:
                yield table(out)
        if open_:
            yield table([row()])

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(run, schema)
