"""Chat formatting at token level.

A turn becomes ``TURN role SEP content END``: role and content are encoded separately as plain text, the
three markers are reserved ids beyond the vocabulary and are spliced in between, so no content can ever
produce a marker.  In the rendered form, and before encoding, control strings inside texts (and the escape
character itself) get a backslash in front, which is taken off again when a sequence is read back.

The loss mask of a turn is a prefix sum: +1 where an assistant's content begins, -1 behind its last id.
Positions of turns in their conversation are prefix sums of turn lengths.

NULL roles and texts count as empty; rows with a NULL conversation id form one conversation; a NULL turn
comes first; rows with the same turn number are ordered by role and text, and repeated rows all stay.
Turns are encoded before they are brought together, and a conversation is then passed through as a sorted
stream, so that a very long one costs its task no memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import encode_text, encoding
from ledgerlake.llm.common import partitions

OPEN, CLOSE, HEADING = "<turn>", "</turn>", "### "
LEARNED_ROLE = "assistant"

_ESCAPED = re.compile(r"\\|</?turn>|### ")
_UNESCAPED = re.compile(r"\\(\\|</?turn>|### )")

_KEYS = "conv_id long, turn long, role string, text string"
SEQUENCE = "conv_id long, seq long, start long, ids array<int>, mask array<int>"
REPORT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(lambda m: m[1], text)


def markers(ranks_path: str) -> tuple[int, int, int]:
    """The reserved ids for the start of a turn, the end of its role and the end of the turn."""
    free = encoding(ranks_path).n_vocab
    return free, free + 1, free + 2


def turn_tokens(role: str, text: str, ranks_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of one turn."""
    turn, sep, end = markers(ranks_path)
    segments = [
        np.array([turn]), encode_text(escape(role), ranks_path), np.array([sep]),
        encode_text(escape(text), ranks_path), np.array([end]),
    ]
    ids = np.concatenate(segments).astype(np.int32)
    ends = np.cumsum([len(s) for s in segments])
    step = np.zeros(len(ids) + 1, dtype=np.int32)
    if role == LEARNED_ROLE:
        step[ends[2]] += 1
        step[ends[3]] -= 1
    mask = np.cumsum(step)[:-1].astype(np.int32)
    return ids, mask


def _tokenized(ranks_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            rows = [turn_tokens(r, t, ranks_path) for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("conv_id", "turn", "role", "text")],
                    pa.array([r[0] for r in rows], type=pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], type=pa.list_(pa.int32())),
                ],
                names=["conv_id", "turn", "role", "text", "ids", "mask"],
            )

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the turns of each conversation and add up where they start."""
    started, current, seq, start = False, None, 0, 0
    for batch in batches:
        seqs, starts = [], []
        lengths = batch.column("ids").value_lengths().to_pylist()
        for conv, length in zip(batch.column("conv_id").to_pylist(), lengths):
            if not started or conv != current:
                started, current, seq, start = True, conv, 0, 0
            seqs.append(seq)
            starts.append(start)
            seq, start = seq + 1, start + length
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"), pa.array(seqs, pa.int64()), pa.array(starts, pa.int64()),
                *[batch.column(c) for c in ("ids", "mask")],
            ],
            names=["conv_id", "seq", "start", "ids", "mask"],
        )


def assemble(conversations: DataFrame, ranks_path: str) -> DataFrame:
    """One row per turn: its number in the conversation, where it starts in tokens, ids, mask."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tokens = rows.mapInArrow(_tokenized(ranks_path), f"{_KEYS}, ids array<int>, mask array<int>")
    return (
        tokens.repartition(partitions(rows.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_placed, SEQUENCE)
    )


class _Reading:
    """What has been read of one conversation so far."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, ranks_path: str) -> None:
        turn, sep, end = markers(ranks_path)
        at = int(np.flatnonzero(ids == sep)[0])
        if ids[0] != turn or ids[-1] != end:
            raise ValueError("a turn without its markers")
        decode = encoding(ranks_path).decode_bytes
        shown_role, shown = decode(ids[1:at].tolist()).decode(), decode(ids[at + 1 : -1].tolist()).decode()
        role, text = unescape(shown_role), unescape(shown)
        learned = unescape(decode(ids[mask == 1].tolist()).decode())
        self.turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.chars += len(OPEN) + len(shown_role) + 1 + len(shown) + len(CLOSE) + 1

    def row(self) -> tuple:
        return (
            self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        )


def _read(ranks_path: str):
    names = [x.split()[0] for x in REPORT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading: _Reading | None = None
        for batch in batches:
            found = []
            ids, masks = batch.column("ids"), batch.column("mask")
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if reading is None or conv != reading.conv:
                    if reading is not None:
                        found.append(reading.row())
                    reading = _Reading(conv)
                reading.add(ids[i].values.to_numpy(), masks[i].values.to_numpy(), ranks_path)
            yield rows(found)
        if reading is not None:
            yield rows([reading.row()])

    return run


def read_back(sequences: DataFrame, ranks_path: str) -> DataFrame:
    """Per conversation what the assembled ids say: turns, the text under the loss mask, sizes."""
    ordered = sequences.repartition(partitions(sequences.sparkSession), "conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(_read(ranks_path), REPORT)
