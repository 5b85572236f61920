"""Conversations as one training text each, checked by parsing them back.

    user        [INST] text [/INST]
    assistant   <s> text </s>
    system      <<SYS>> text <</SYS>>
    any other   <<ROLE>> name <<TEXT>> text <</ROLE>>

A text may itself hold such marks.  A turn is rendered as it is, parsed, and compared with
its source; where that differs, marks in it are escaped with a backslash, and where it still
differs, backslashes are too.  The parser always undoes escapes, so nothing else need be kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import text as T

TEMPLATE = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"),
            "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
CONTROL = [m for pair in TEMPLATE.values() for m in pair] + list(OTHER)

_MARK = re.compile("|".join(map(re.escape, CONTROL)))
_SPECIAL = re.compile(r"\\[\\<\[]|" + _MARK.pattern)
_MARK_OR_ESCAPE = re.compile(_MARK.pattern + r"|\\")
_ESCAPED = re.compile(r"\\([\\<\[])")
_ROLES = {pair[0]: role for role, pair in TEMPLATE.items()}


def unescape(body: str) -> str:
    return _ESCAPED.sub(r"\1", body)


def _escape(text: str, level: int) -> str:
    """As it is; with marks escaped; with marks and backslashes escaped."""
    if level == 0:
        return text
    return (_MARK if level == 1 else _MARK_OR_ESCAPE).sub(lambda m: "\\" + m[0], text)


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text and the bounds of the escaped text of each turn; raises where a mark is out of place."""
    marks = (m for m in _SPECIAL.finditer(rendered) if m[0][0] != "\\")
    at = 0

    def body(start: int, close: str) -> tuple[int, int, int]:
        """Bounds of what stands between single spaces up to ``close``, and where that ends."""
        mark = next(marks, None)
        if mark is None or mark[0] != close:
            raise ValueError(f"{close} expected")
        if rendered[start:start + 1] != " " or mark.start() < start + 2 or rendered[mark.start() - 1] != " ":
            raise ValueError("space expected")
        return start + 1, mark.start() - 1, mark.end()

    for mark in marks:
        if mark.start() != at:
            raise ValueError("text between turns")
        if mark[0] in _ROLES:
            role = _ROLES[mark[0]]
            start, end, at = body(mark.end(), TEMPLATE[role][1])
        elif mark[0] == OTHER[0]:
            start, end, at = body(mark.end(), OTHER[1])
            role = unescape(rendered[start:end])
            start, end, at = body(at, OTHER[2])
        else:
            raise ValueError("a turn must open")
        yield role, unescape(rendered[start:end]), start, end
    if at != len(rendered):
        raise ValueError("text after the last turn")


def _render(role: str, text: str, level: int) -> str:
    body = _escape(text, level)
    if role in TEMPLATE:
        opening, closing = TEMPLATE[role]
        return f"{opening} {body} {closing}"
    return f"{OTHER[0]} {_escape(role, level)} {OTHER[1]} {body} {OTHER[2]}"


def render(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn's rendered text that parses back to it, and the bounds of its body."""
    role, text = role or "", text or ""
    for level in range(3):
        rendered = _render(role, text, level)
        try:
            turns = list(parse(rendered))
        except ValueError:
            continue
        if len(turns) == 1 and turns[0][:2] == (role, text):
            return rendered, *turns[0][2:]
    raise AssertionError("a turn with all marks escaped parses back")


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rendered text of each turn, as ``conv_id, turn, role, formatted, loss_start, loss_end``.

    A conversation is the concatenation of its turns' ``formatted`` in the order of
    ``turn``; every prefix of it parses alone, so no conversation is held whole.  The loss
    counts between ``loss_start`` and ``loss_end``, which are null unless the assistant
    speaks.  A null role or text is an empty one; a null conversation is one of its own.
    Repeated rows are repeated turns.
    """
    def run(batches):
        for batch in batches:
            role, text = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            made = [render(r, t) for r, t in zip(role, text)]
            learn = [r == "assistant" for r in role]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([m[0] for m in made], pa.string()),
                 pa.array([m[1] if k else None for m, k in zip(made, learn)], pa.int64()),
                 pa.array([m[2] if k else None for m, k in zip(made, learn)], pa.int64())],
                names=["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"])

    T.prepare_workers(turns.sparkSession)
    chosen = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                          F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    schema = (chosen.drop("text").schema.add("formatted", "string")
              .add("loss_start", "long").add("loss_end", "long"))
    return chosen.mapInArrow(run, schema)


class _Digest:
    """What a conversation's formatted text holds, gathered turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, masked: list[tuple[int, int]]) -> None:
        for role, text, _, _ in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for start, end in masked:
            text = unescape(formatted[start:end])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.formatted_chars += len(formatted)

    def row(self, conv) -> tuple:
        return (conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from parsing what ``format_turns`` made.

    Rows are streamed in the order of conversation and turn, so a task holds one batch and
    two running hashes, however long a conversation is.  Turns that share a number go by
    role and rendered text.
    """
    def run(batches):
        digest, current, done = None, None, []
        for batch in batches:
            convs, pieces = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            at = 0
            while at < len(convs):
                end = at
                while end < len(convs) and convs[end] == convs[at]:
                    end += 1
                if digest is None or convs[at] != current:
                    if digest is not None:
                        done.append(digest.row(current))
                    digest, current = _Digest(), convs[at]
                masked, place = [], 0
                for piece, start, stop in zip(pieces[at:end], starts[at:end], ends[at:end]):
                    if start is not None:
                        masked.append((place + start, place + stop))
                    place += len(piece)
                digest.add("".join(pieces[at:end]), masked)
                at = end
            if len(done) > 1000:
                yield from _rows(done)
                done = []
        if digest is not None:
            done.append(digest.row(current))
        yield from _rows(done)

    def _rows(done):
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)],
                                             names=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = formatted.schema["conv_id"].dataType
    types = [pa.string() if kind.simpleString() == "string" else pa.int64(), pa.int64(), pa.string(),
             pa.int64(), pa.string(), pa.int64()]
    T.prepare_workers(formatted.sparkSession)
    ordered = (formatted.repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "formatted")
               .select("conv_id", "formatted", "loss_start", "loss_end"))
    out = "string" if kind.simpleString() == "string" else "long"
    return ordered.mapInArrow(run, f"conv_id {out}, n_turns long, turns_sha256 string, "
                                   "loss_chars long, loss_sha256 string, formatted_chars long")
