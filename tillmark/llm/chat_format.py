r"""Chat formatting with a grammar that is checked by reading back.

A conversation is written as its turns, one after the other:

    turn    = header text "\n</turn>\n"
    header  = "### " name ": "
    name    = the role with a capital letter where it is [a-z][a-z0-9_]*, else "=" and the role percent-encoded

Headers and ``</turn>`` are control strings. One that follows a backslash is text, and reading takes one backslash away
from it. Each turn is rendered as it stands and read by the parser; where that gives another turn, as the text holds
control strings itself, these get a backslash each and the turn is rendered and read again, until it comes back as it
was. As every turn begins with a header and ends with a closing string of its own, what holds for each turn holds for
their concatenation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points that one piece of a conversation holds at most; a longer turn makes a piece alone.
PIECE_CHARS = 1 << 20

#: Whose text is under the loss mask.
LEARNED_ROLE = "assistant"

# The template.
_HEADER = r"### (?P<name>[A-Z][a-z0-9_]*|=[A-Za-z0-9_.~%-]*): "
CLOSING = "</turn>"
_CONTROL = re.compile(f"{_HEADER}|{CLOSING}")
_UNESCAPED_CONTROL = re.compile(rf"(?<!\\)(?:{_HEADER}|{CLOSING})")
_ESCAPED_CONTROL = re.compile(rf"\\(?=(?:{_HEADER}|{CLOSING}))")
_PLAIN_ROLE = re.compile(r"[a-z][a-z0-9_]*")

TURNS = "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long"
PIECES = "conv_id long, piece long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class FormatError(ValueError):
    """Text that the grammar doesn't produce."""


class Turn(NamedTuple):
    role: str
    text: str


def header(role: str) -> str:
    name = role.capitalize() if _PLAIN_ROLE.fullmatch(role) else "=" + quote(role, safe="")
    return f"### {name}: "


def _role(name: str) -> str:
    return unquote(name[1:]) if name.startswith("=") else name[0].lower() + name[1:]


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda found: "\\" + found[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED_CONTROL.sub("", text)


def parsed(formatted: str) -> Iterator[tuple[Turn, int, int]]:
    """The turns of formatted text, each with start and end of its (escaped) text in ``formatted``."""
    at = 0
    while at < len(formatted):
        opening = _CONTROL.match(formatted, at)
        if not opening or opening["name"] is None:
            raise FormatError(f"no header at {at}")
        begin = opening.end()
        closing = _UNESCAPED_CONTROL.search(formatted, begin)
        if closing is None or closing["name"] is not None:
            raise FormatError(f"the turn at {at} isn't closed")
        end = closing.start() - 1
        if end < begin or formatted[end] != "\n" or formatted[closing.end() : closing.end() + 1] != "\n":
            raise FormatError(f"the turn at {at} is closed within a line")
        yield Turn(_role(opening["name"]), unescaped(formatted[begin:end])), begin, end
        at = closing.end() + 1


def rendered(turn: Turn) -> str:
    """One turn in the template, escaped if it must be so that the parser gives it back as it is."""
    text = turn.text
    # As it stands, then with its control strings escaped; an escaped text always comes back.
    for _ in range(2):
        formatted = f"{header(turn.role)}{text}\n{CLOSING}\n"
        try:
            if [read for read, _, _ in parsed(formatted)] == [turn]:
                return formatted
        except FormatError:
            pass
        text = escaped(text)
    raise FormatError(f"a turn of {turn.role!r} doesn't come back")


def format_turns(conversations: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """conv_id, turn, role, formatted, loss_start, loss_end: one row per row of ``conversations``.

    ``conversations`` has conv_id, turn, role and text; other columns are ignored. NULL roles and texts count as empty,
    ids and turn numbers may be NULL. ``formatted`` is the turn in the template. The loss mask covers ``loss_start`` to
    ``loss_end`` (code points within ``formatted``): the escaped text of a turn of ``learned_role``, else NULL. Each row
    by itself, repeated rows as often as they are there: nothing is moved, and a conversation of any length is
    formatted by many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(name).fill_null("").to_pylist() for name in ("role", "text"))
            formatted = [rendered(Turn(*pair)) for pair in zip(roles, texts, strict=True)]
            masks = [
                (len(header(role)), len(text) - len(CLOSING) - 2) if role == learned_role else (None, None)
                for role, text in zip(roles, formatted, strict=True)
            ]
            columns = [batch.column("conv_id"), batch.column("turn"), pa.array(roles, pa.string())]
            columns += [pa.array(formatted, pa.string())]
            columns += [pa.array([mask[k] for mask in masks], pa.int64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in TURNS.split(", ")])

    kinds = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    return conversations.select(*[F.col(name).cast(kind) for name, kind in kinds.items()]).mapInArrow(run, TURNS)


def assemble(turns: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """conv_id, piece, n_turns, formatted, loss_starts, loss_ends: conversations out of formatted turns.

    Turns follow each other by turn number (NULL first), those of one number by role and text. A conversation is one
    row, or if it is longer than ``piece_chars`` several, cut between turns; ``piece`` counts from 0. The loss mask is
    the stretches from ``loss_starts`` to ``loss_ends``, code points within the piece. Rows without an id are one
    conversation; an empty table has none. The rows of a partition lie in order of id and piece.

    Turns are shuffled by conversation and streamed in order, so a task holds one piece at a time, however long the
    conversation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PIECES.split(", ")]
        piece = None
        for batch in batches:
            done = []
            for row in batch.select(["conv_id", "formatted", "loss_start", "loss_end"]).to_pylist():
                size = len(row["formatted"])
                if piece is None or piece.conv_id != row["conv_id"]:
                    done += [piece] if piece else []
                    piece = _Piece(row["conv_id"], 0)
                elif piece.size + size > piece_chars:
                    done.append(piece)
                    piece = _Piece(piece.conv_id, piece.number + 1)
                piece.add(row)
            if done:
                yield pa.RecordBatch.from_pylist([one.row(names) for one in done], _PIECE_SCHEMA)
        if piece:
            yield pa.RecordBatch.from_pylist([piece.row(names)], _PIECE_SCHEMA)

    order = ["conv_id", "turn", "role", "formatted"]
    return turns.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, PIECES)


_PIECE_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
        ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())),
    ]
)


class _Piece:
    def __init__(self, conv_id: int | None, number: int) -> None:
        self.conv_id, self.number = conv_id, number
        self.size, self.turns, self.masks = 0, [], []

    def add(self, row: dict) -> None:
        if row["loss_start"] is not None:
            self.masks.append((self.size + row["loss_start"], self.size + row["loss_end"]))
        self.turns.append(row["formatted"])
        self.size += len(row["formatted"])

    def row(self, names: list[str]) -> dict:
        starts, ends = ([mask[k] for mask in self.masks] for k in range(2))
        values = (self.conv_id, self.number, len(self.turns), "".join(self.turns), starts, ends)
        return dict(zip(names, values, strict=True))


def read_back(pieces: DataFrame, in_order: bool = False) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: what the parser reads in ``pieces``.

    ``turns_sha256`` is over role, line feed, text and line feed of each turn, ``loss_sha256`` over all text under the
    loss mask, unescaped; ``loss_chars`` and ``formatted_chars`` count code points. Text that the grammar doesn't
    produce raises ``FormatError``. Say ``in_order`` for the frame that ``assemble`` returned; rows read from
    elsewhere are brought into order first. The digest of a conversation is one chain, so its pieces pass through one
    task, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if digest is None or digest.conv_id != row["conv_id"]:
                    done += [digest] if digest else []
                    digest = _Digest(row["conv_id"])
                digest.add(row)
            if done:
                yield _digests(done)
        if digest:
            yield _digests([digest])

    if not in_order:
        pieces = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return pieces.mapInArrow(run, DIGESTS)


class _Digest:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, row: dict) -> None:
        formatted = row["formatted"]
        self.formatted_chars += len(formatted)
        for turn, _, _ in parsed(formatted):
            self.n_turns += 1
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
        for start, end in zip(row["loss_starts"], row["loss_ends"], strict=True):
            text = unescaped(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        digests = (self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest())
        return (self.conv_id, self.n_turns, *digests, self.formatted_chars)


def _digests(done: list[_Digest]) -> pa.RecordBatch:
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    rows = [dict(zip(names, one.row(), strict=True)) for one in done]
    whole, text = pa.int64(), pa.string()
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, (whole, whole, text, whole, text, whole)))))
