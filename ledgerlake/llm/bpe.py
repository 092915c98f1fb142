"""Byte-level BPE: whole texts to token ids by a local rank file, and ids back to raw bytes.

``tiktoken`` does the merges.  Texts longer than ``SEGMENT`` characters are cut in front of a space or
line break that follows a visible character: no match of the split pattern runs over such a place, and a
run of white space stays whole inside one segment, so the ids are those of the uncut text.  A long text
without such a place is encoded in one piece.  A run of more than ``RUN`` white space characters is beyond what the
library's look-ahead can walk back over; it is cut out and encoded as the one match it is: all of it at the end of the
text, else all but its last character, which goes with what follows.  Special tokens are unknown: their strings are
plain text.

NULL and empty texts have no ids.  Rows are independent of each other: repeated rows, NULL document ids
and extra columns change nothing.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents

SEGMENT = 1 << 15
RUN = 1 << 13

# White space as the split pattern has it (fixed value); Python's own has four control characters more.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)

# The split pattern of the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=8)
def encoding(ranks_path: str, pattern: str = PATTERN):
    """The encoder of a rank file, built once per Python worker."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """The text in pieces of about ``size`` characters whose ids are the ids of the text."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not (text[at] in " \n" and "!" <= text[at - 1] and not text[at - 1].isspace()):
            at += 1
        yield text[start:at]
        start = at
    if start < len(text) or not text:
        yield text[start:]


# All of a text as one match, without look-ahead.
_ONE_MATCH = "(?s:.+)"


def stretches(text: str) -> Iterator[tuple[str, bool]]:
    """The text in pieces whose ids are the ids of the text, and whether a piece is one match of white space."""
    start = 0
    for run in _BLANKS.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > start:
            yield text[start : run.start()], False
        yield text[run.start() : end], True
        start = end
    if start < len(text) or not text:
        yield text[start:], False


def encode_text(text: str, ranks_path: str, size: int = SEGMENT) -> np.ndarray:
    split, whole = encoding(ranks_path).encode_ordinary, encoding(ranks_path, _ONE_MATCH).encode_ordinary
    parts = []
    for piece, blank in stretches(text):
        parts += [np.array(whole(piece), dtype=np.int32)] if blank else [np.array(split(s), dtype=np.int32) for s in segments(piece, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode_ids(ids: np.ndarray, ranks_path: str) -> bytes:
    """The raw bytes of the ids; they need not be valid text where a sequence was cut."""
    return encoding(ranks_path).decode_bytes(ids.tolist())


def encoder(ranks_path: str):
    """A column function: text to token ids."""

    @F.pandas_udf("array<int>")
    def token_ids(texts: pd.Series) -> pd.Series:
        return pd.Series([encode_text(t or "", ranks_path) for t in texts], dtype=object)

    return token_ids


def decoder(ranks_path: str):
    """A column function: token ids to raw bytes."""

    @F.pandas_udf("binary")
    def raw_bytes(ids: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(np.asarray(i, dtype=np.int32), ranks_path) for i in ids], dtype=object)

    return raw_bytes


def digests(ranks_path: str):
    """A column function: token ids to their count, their digest and the digest of what they decode to."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def token_digests(ids: pd.Series) -> pd.DataFrame:
        rows = []
        for row in ids:
            own = np.asarray(row, dtype="<u4")
            decoded = decode_ids(own, ranks_path)
            rows.append((len(own), hashlib.sha256(own.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return token_digests


def encode(docs: DataFrame, ranks_path: str, text: Column | None = None) -> DataFrame:
    """Document ids with ``ids``, the token ids of the whole text."""
    own = documents(docs) if text is None else docs.select("doc_id", text.alias("text"))
    return own.select("doc_id", encoder(ranks_path)("text").alias("ids"))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Document ids with ``content``, the bytes that ``ids`` stand for."""
    return encoded.select("doc_id", decoder(ranks_path)("ids").alias("content"))


def token_report(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Per document: number of ids, their digest, and the digest of the decoded bytes."""
    return encoded.select("doc_id", digests(ranks_path)("ids").alias("d")).select("doc_id", "d.*")
