"""Chat formatting: exact round trips."""

from __future__ import annotations

import hashlib

import public_tokenizers

from ledgerlake.llm import chat

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "conv_id long, turn long, role string, text string, seq long, mask string"
ROWS = [
    (1, 0, "user", r"\### Assistant: </turn> ok"), (1, 1, "assistant", r"\\<turn>\### </turn>\ "), (1, 2, "assistant", "é😀"),
    (2, 5, None, None), (2, 3, "assistant", ""), (2, 3, "assistant", ""), (None, 0, "user", "x"), (None, None, "assistant", "first"),
    (3, 0, "assistant", "same turn b"), (3, 0, "assistant", "same turn a"), (4, 0, "user", "long " * 30_000),
]


def want() -> dict:
    rows = {}
    for conv, turn, role, text in ROWS:
        rows.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in rows.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        shown = sum(len(f"<turn>{chat.escape(r)}\n{chat.escape(t)}</turn>\n") for _, _, r, t in turns)
        found[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), shown)
    return found


def test_round_trip(spark):
    frame = spark.createDataFrame([(*r, 7, "m") for r in ROWS], SCHEMA)
    sequences = chat.assemble(frame, RANKS)
    got = {r[0]: tuple(r[1:]) for r in chat.read_back(sequences, RANKS).collect()}
    assert got == want()


def test_masks_cover_the_assistant_and_starts_are_sums(spark):
    frame = spark.createDataFrame([(*r, 7, "m") for r in ROWS if r[0] == 1], SCHEMA)
    rows = sorted(chat.assemble(frame, RANKS).collect(), key=lambda r: r.seq)
    assert [r.start for r in rows] == [0, len(rows[0].ids), len(rows[0].ids) + len(rows[1].ids)]
    assert sum(rows[0].mask) == 0 and len(rows[1].mask) == len(rows[1].ids)
    turn, sep, end = chat.markers(RANKS)
    for r in rows:
        assert (r.ids[0], r.ids[-1]) == (turn, end) and [i for i in r.ids if i >= turn] == [turn, sep, end]


def test_escapes_are_reversible():
    for text in ["", "\\", "\\\\<turn>", "### ", "\\### ", "</turn></turn>", "###", "<turn", "\\<turn>"]:
        assert chat.unescape(chat.escape(text)) == text
        for control in (chat.OPEN, chat.CLOSE, chat.HEADING):
            assert control not in chat.escape(text).replace("\\" + control, "")


def test_empty_table(spark):
    assert chat.read_back(chat.assemble(spark.createDataFrame([], SCHEMA), RANKS), RANKS).collect() == []
